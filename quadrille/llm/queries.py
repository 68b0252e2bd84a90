"""The operators as queries over whole tables; SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import (
    bpe_numpy,
    decontaminate,
    filter_audit,
    language_id,
    line_dedup,
    order_minhash,
    prefix_trie,
    quotations,
    sharding,
    simhash,
    substring_dedup,
    token_counts,
    token_files,
)
from quadrille.llm.common import staged, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"
TOKEN_LIMIT = 4096


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _docs(spark, d):
    return table(spark, d, "documents")


@query
def op1_line_dedup(spark, d):
    """Each document without its repeated lines, as counts and a digest."""
    kept = line_dedup.dedup_lines(_docs(spark, d).select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))


@query
def op2_token_counts(spark, d):
    counted = token_counts.count_tokens(
        _docs(spark, d).select("doc_id", "text"), public_tokenizers.path(PIECES)
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


@query
def op5_simhash_dedup(spark, d):
    found = simhash.near_duplicates(_docs(spark, d))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query
def op6_decontamination(spark, d):
    found = decontaminate.contamination(_docs(spark, d), table(spark, d, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op7_bpe_codec(spark, d):
    return bpe_numpy.token_digests(
        _docs(spark, d).select("doc_id", "text"), public_tokenizers.path(BYTES)
    )


@query
def op9_language_id(spark, d):
    docs = _docs(spark, d)
    fold = language_id.remainder()
    model = language_id.fit(docs.filter(fold != 0))
    marked = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text")
    return language_id.identify(marked, model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op4_jump_shards(spark, d):
    placed = sharding.assign(sharding.sized(_docs(spark, d).select("doc_id", "text")))
    rows = placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "grown_shard")
    return sharding.numbered(rows, order=("doc_id", "text_crc32"))


@query
def op8_substring_dedup(spark, d):
    kept = substring_dedup.dedup_substrings(_docs(spark, d).select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@query
def op10_order_minhash(spark, d):
    found = order_minhash.compared(_docs(spark, d))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query
def op11_token_files(spark, d):
    """Token files of all documents, written and read back."""
    folder = token_files.write_tokens(_docs(spark, d), public_tokenizers.path(BYTES), end_id=0)
    return token_files.read_checksums(spark, folder).withColumnRenamed("key", "doc_id")


@query
def op12_prefix_trie(spark, d):
    """The prefix trie of conversations that share first turns with others, as nodes with their totals."""
    said = staged(prefix_trie.turns(table(spark, d, "conversations")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-said.count() // prefix_trie.TASK_STEPS))
    nodes = prefix_trie.trie(prefix_trie.rebuilt(said, tasks), said.select("conv"), ["part", "turn"])
    return nodes.withColumnRenamed("saved", "saved_tokens")


@query
def op13_filter_audit(spark, d):
    """What five filters remove from documents, by language, in all 120 orders."""
    return filter_audit.audit(filter_audit.failures(_docs(spark, d), table(spark, d, "labels")))


def _linked(messages):
    linked = quotations.link_quotations(messages)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("clean_sha256")
    return quotations.in_reply_order(linked).select(
        "conv_id", "turn", "role", digest, "n_quotes", "n_linked", "reply_to", "thread", "depth"
    )


@query
def op3_quotation_linking(spark, d):
    return _linked(table(spark, d, "conversations"))


@query
def op3_quotation_replies(spark, d):
    """The same over replies that quote lines of the turns before them, at two levels."""
    return _linked(quotations.quoting_replies(table(spark, d, "conversations")))


# --- SQL, where SQL can express an operator ----------------------------------------

_LOWERED = f"translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}')"
_RUNS = f"regexp_extract_all({_LOWERED}, '[^{decontaminate.BETWEEN[1:]}')"
_PLAIN = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op6_decontamination"] = f"""
    WITH docs AS (SELECT doc_id, {_RUNS} AS words FROM documents),
    items AS (SELECT item_id, {_RUNS} AS words FROM benchmark),
    cut AS (SELECT item_id, words, least(len(words), 13) AS n FROM items WHERE len(words) > 0),
    grams AS (
        SELECT DISTINCT item_id, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS gram
        FROM (SELECT item_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM cut)),
    lengths AS (SELECT DISTINCT n FROM grams),
    windows AS (
        SELECT doc_id, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS gram
        FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
              FROM docs, lengths WHERE len(words) >= n)),
    hits AS (SELECT w.doc_id, w.n, w.i, g.item_id
             FROM windows w JOIN grams g ON w.n = g.n AND w.gram = g.gram),
    covered AS (
        SELECT doc_id, count(*) AS n_hit FROM (
            SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS place FROM hits)
        GROUP BY doc_id),
    found AS (
        SELECT doc_id, count(*) AS n_items,
               sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS digest
        FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id"""

ORACLE["op8_substring_dedup"] = f"""
    WITH docs AS (SELECT doc_id, {_PLAIN} AS words FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(list_slice(words, i, i + 12), ' ') AS gram
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS i
              FROM docs WHERE len(words) >= 13)),
    firsts AS (SELECT gram, min(doc_id) AS least FROM windows GROUP BY gram),
    gone AS (
        SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS place
        FROM windows w JOIN firsts f ON f.gram = w.gram WHERE f.least < w.doc_id),
    placed AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM docs),
    kept AS (
        SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS left_over, count(*) AS n
        FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place
        WHERE g.place IS NULL GROUP BY p.doc_id)
    SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(left_over, '')) AS kept_sha256
    FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id"""

# The CRC table as a list, for the checksum of an id's decimal digits.
_CRC_STEP = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"

ORACLE["op12_prefix_trie"] = f"""
    WITH RECURSIVE crc(i, v, k) AS (
        SELECT CAST(i AS BIGINT), CAST(i AS BIGINT), 0 FROM generate_series(0, 255) AS g(i)
        UNION ALL SELECT i, {_CRC_STEP.format("v")}, k + 1 FROM crc WHERE k < 8),
    crcs AS (SELECT list(v ORDER BY i) AS lut FROM crc WHERE k = 8),
    convs AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
    digits(conv_id, left_over, state) AS (
        SELECT conv_id, CAST(conv_id AS VARCHAR), CAST(4294967295 AS BIGINT) FROM convs
        UNION ALL
        SELECT conv_id, substr(left_over, 2),
               xor(state >> 8, lut[CAST(xor(state & 255, CAST(ascii(left_over) AS BIGINT)) AS INT) + 1])
        FROM digits, crcs WHERE left_over <> ''),
    heads AS (SELECT conv_id, xor(state, 4294967295) % 9 AS h FROM digits WHERE left_over = ''),
    turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
        FROM conversations WHERE conv_id IS NOT NULL),
    steps AS (
        SELECT h.conv_id, 0 AS part, i, role, text
        FROM heads h JOIN turns t ON t.conv_id = h.conv_id - h.conv_id % 5 AND t.i <= h.h
        UNION ALL
        SELECT h.conv_id, 1, i, role, text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.i > h.h),
    paths AS (
        SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY part, i) AS path FROM steps GROUP BY conv_id),
    whole AS (SELECT c.conv_id, coalesce(path, []) AS path FROM convs c LEFT JOIN paths p ON p.conv_id = c.conv_id),
    places AS (SELECT conv_id, path, unnest(generate_series(0, len(path))) AS depth FROM whole),
    prefixes AS (SELECT conv_id, depth, len(path) = depth AS ends, list_slice(path, 1, depth) AS prefix FROM places),
    nodes AS (
        SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), ''))
                   AS ends_sha256,
               (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE strlen(prefix[-1].text) END AS own
        FROM prefixes GROUP BY prefix, depth),
    up AS (SELECT n.*, p.conv_id AS parent_conv_id, p.prefix AS parent FROM nodes n
           LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)),
    born AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM up WHERE depth > 0 GROUP BY parent, depth),
    known AS (SELECT u.*, coalesce(b.n, 0) AS n_children FROM up u
              LEFT JOIN born b ON b.parent = u.prefix AND b.depth = u.depth),
    spread AS (
        SELECT list_slice(prefix, 1, d) AS prefix, d AS depth, own, n_children
        FROM (SELECT prefix, own, n_children, unnest(generate_series(0, depth)) AS d FROM known)),
    totals AS (
        SELECT prefix, depth, sum(own) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
        FROM spread GROUP BY prefix, depth)
    SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, parent_conv_id, n_convs,
           CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
    FROM known k JOIN totals t ON t.prefix = k.prefix AND t.depth = k.depth"""

ORACLE["op13_filter_audit"] = f"""
    WITH said AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
                  FROM labels GROUP BY doc_id),
    docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_PLAIN} AS words,
                    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
    judged AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               CAST(len(words) < 100 AS INT)
               + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT)
               + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INT)
               + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
               + 16 * CAST(coalesce(d.doc_id > least, false) AS INT) AS failed
        FROM docs d LEFT JOIN said s ON s.doc_id = d.doc_id),
    counted AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
                FROM judged GROUP BY part, failed),
    letters(c, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders AS (
        SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
          AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
    steps AS (
        SELECT filter_order, step, l.c AS letter, l.bit AS own,
               coalesce((SELECT sum(p.bit) FROM letters p WHERE strpos(filter_order, p.c) < step), 0) AS before
        FROM orders, generate_series(1, 5) AS s(step), letters l WHERE l.c = substr(filter_order, step, 1)),
    settled AS (
        SELECT part, filter_order, step, letter,
               sum(CASE WHEN failed & own = 0 AND failed & before = 0 THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN failed & own <> 0 AND failed & before <> 0 THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM counted, (SELECT filter_order, step, letter, own, CAST(before AS INT) AS before FROM steps)
        GROUP BY part, filter_order, step, letter)
    SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
           CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM settled"""
