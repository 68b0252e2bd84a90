"""Parameter rows out of files, model cards and recorded answers.

Every layer yields (param_name, param_value) with a source and a confidence. Layers
over JSON and prose are native expressions; YAML and Python sources are parsed in
Arrow batches, and the naming rules are the same expressions for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.functions.parsers import parse_leaves
from quadrille.functions.text import double_text, file_category, folded, let, spaced_json, strip
from quadrille.operators.params import params_table
from quadrille.operators.skew import hot_keys, skew_join
from quadrille.session import cut_lineage

_SPELLED = {word: name for name, words in vocab.SPELLINGS.items() for word in words}
# One SQL literal keeps the plans small.
_SPELLING_MAP = "map({})".format(", ".join(f"'{w}', '{n}'" for w, n in _SPELLED.items()))


# --- shared naming rules -----------------------------------------------------------


def canonical(name: Column) -> Column:
    """Parameter a spelling stands for, NULL when it is none."""
    return F.try_element_at(F.expr(_SPELLING_MAP), folded(name))


def deepest_canonical(path: Column) -> Column:
    """The last segment of a dotted path that names a parameter."""
    named = F.transform(F.split(path, r"\."), canonical)
    return F.try_element_at(F.filter(named, lambda n: n.isNotNull()), F.lit(-1))


def is_filler(kind: Column, head: Column, items: Column) -> Column:
    """A text, or a list of one text, that only repeats a parameter name or says 'auto'."""
    word = folded(head).isin(*_SPELLED, *vocab.FILLER_WORDS)
    textual = (kind == "text") | ((kind == "list") & (items == 1))
    return F.coalesce(textual & word, F.lit(False))


def name_token(text: Column) -> Column:
    """The first token before a blank, '(' or ',', lower-cased; NULL when empty or long."""
    token = F.regexp_extract(strip(text), r"^([^\s(,]*)", 1)
    return F.when((token != "") & (F.length(token) <= vocab.NAME_CHARS), F.lower(token))


def leaf_value(param: Column, kind: Column, text: Column, head: Column) -> Column:
    """Text to store for a leaf; optimizer and scheduler are cut to their name."""
    named = F.when(kind == "scalar", text).otherwise(name_token(head))
    return F.when(param.isin("optimizer", "scheduler"), named).otherwise(text)


def leaf_params(leaves: Column) -> Column:
    """Array of (ord, param_name, leaf) to the (ord, param_name, param_value) that count."""

    def carries(e: Column) -> Column:
        leaf = e["leaf"]
        return (leaf["kind"] != "null") & ~is_filler(leaf["kind"], leaf["head"], leaf["items"])

    def row(e: Column) -> Column:
        leaf = e["leaf"]
        value = leaf_value(e["param_name"], leaf["kind"], leaf["text"], leaf["head"])
        return F.struct(
            e["ord"].alias("ord"), e["param_name"].alias("param_name"), value.alias("param_value")
        )

    named = F.filter(leaves, lambda e: e["param_name"].isNotNull())
    valued = F.transform(F.filter(named, carries), row)
    return F.filter(valued, lambda e: e["param_value"].isNotNull())


def once_per_param(rows: Column, last: bool = False) -> Column:
    """The first (or last) row of every parameter in an array of rows."""

    def kept(rows: Column) -> Column:
        names = F.transform(rows, lambda r: r["param_name"])
        if last:
            at = lambda r: F.size(names) - F.array_position(F.reverse(names), r["param_name"])
        else:
            at = lambda r: F.array_position(names, r["param_name"]) - 1
        return F.filter(rows, lambda r, i: i == at(r))

    return let(rows, kept)


def _confidence(source: Column) -> Column:
    value = F.lit(None).cast("double")
    for name, confidence in vocab.SOURCE_CONFIDENCE.items():
        value = F.when(source == name, confidence).otherwise(value)
    return value


# --- JSON layer --------------------------------------------------------------------


def _is_real(raw: Column, shape: Column) -> Column:
    real = shape.startswith("DOUBLE") | shape.startswith("DECIMAL") | shape.startswith("FLOAT")
    return real & ~raw.rlike(r"^-?\d+$")


def _json_leaf(raw: Column, value: Column, shape: Column, shown: Column | None = None) -> Column:
    """(kind, text, head, items) of one JSON value: raw text, variant, its type and, if at hand, a real number's text."""
    listed = F.try_variant_get(value, "$", "array<variant>")
    first = F.try_element_at(listed, F.lit(1))
    is_list, is_object = shape.startswith("ARRAY"), shape.startswith("OBJECT")
    # An absent, null or empty type falls back to the name.
    member = lambda key: F.try_variant_get(value, f"$.{key}", "variant")
    empty = F.coalesce(F.to_json(member("type")), F.lit("null")).isin(
        "null", '""', "0", "false", "[]", "{}"
    )
    named = F.when(empty, member("name")).otherwise(member("type"))
    if_text = lambda v: F.when(F.schema_of_variant(v) == "STRING", v.try_cast("string"))
    shown = let(value.try_cast("double"), double_text) if shown is None else shown
    items_text = F.concat(
        F.lit("["),
        F.array_join(F.transform(listed, lambda v: spaced_json(F.to_json(v))), ", "),
        F.lit("]"),
    )
    return F.struct(
        F.when(shape == "VOID", "null")
        .when(shape == "STRING", "text")
        .when(is_list, "list")
        .when(is_object, "object")
        .otherwise("scalar")
        .alias("kind"),
        F.when(shape == "VOID", F.lit(None).cast("string"))
        .when(shape == "STRING", value.try_cast("string"))
        .when(is_list, items_text)
        .when(_is_real(raw, shape), shown)
        .when(is_object, spaced_json(F.to_json(value)))
        .otherwise(F.to_json(value))
        .alias("text"),
        F.when(shape == "STRING", value.try_cast("string"))
        .when(is_list, if_text(first))
        .when(is_object, let(named, if_text))
        .alias("head"),
        F.when(is_list, F.size(listed)).alias("items"),
    )


_JSON_ROWS = "array<struct<ord:int,param_name:string,param_value:string>>"


def json_params(content: Column, own_names: bool = False) -> Column:
    """Top-level entries of a JSON object as an array of (ord, param_name, param_value).

    Entries keep the order of the text. Anything but an object gives an empty array.
    The text is parsed once, and each entry that names a parameter is read once.
    ``own_names`` also accepts the parameters' own names, as recorded answers use them.
    """

    def param(key: Column) -> Column:
        if not own_names:
            return canonical(key)
        return F.when(key.isin(*vocab.PARAMS), key).otherwise(canonical(key))

    def described(entry: Column) -> Column:
        return let(
            F.struct(
                entry["value"].alias("value"), F.schema_of_variant(entry["value"]).alias("shape")
            ),
            lambda v: F.struct(
                entry["ord"].alias("ord"),
                entry["param_name"].alias("param_name"),
                _json_leaf(entry["raw"], v["value"], v["shape"]).alias("leaf"),
            ),
        )

    def rows(by_name: Column) -> Column:
        entries = F.map_entries(
            F.from_json(F.when(by_name.isNotNull(), content), "map<string,string>")
        )
        named = F.filter(
            F.transform(
                entries,
                lambda e, i: F.struct(
                    i.alias("ord"),
                    param(e["key"]).alias("param_name"),
                    e["value"].alias("raw"),
                    F.try_element_at(by_name, e["key"]).alias("value"),
                ),
            ),
            lambda e: e["param_name"].isNotNull(),
        )
        return leaf_params(F.transform(named, described))

    parsed = F.try_variant_get(F.try_parse_json(content), "$", "map<string,variant>")
    return F.coalesce(let(parsed, rows), F.array().cast(_JSON_ROWS))


def json_layer(df: DataFrame, keys: Sequence[str], content: str = "content") -> DataFrame:
    """Rows of the JSON layer of a table of texts, as :func:`json_params` gives them.

    Each entry is a row, so that it is read by compiled expressions instead of lambdas. What a step uses
    more than once is a column of the step before, and a generator drops the last rows: Spark would
    repeat the whole reading in a filter.
    """
    keys, name, value, shape, raw = list(keys), F.col("_name"), F.col("_value"), F.col("_shape"), F.col("_raw")
    parsed = df.select(
        *keys, F.col(content).alias("_content"),
        F.try_variant_get(F.try_parse_json(F.col(content)), "$", "map<string,variant>").alias("_by_name"),
    )
    told = F.when(F.col("_by_name").isNotNull(), F.col("_content"))
    entries = parsed.select(*keys, "_by_name", F.posexplode(F.from_json(told, "map<string,string>")).alias("_ord", "_key", "_raw"))
    named = entries.filter(folded(F.col("_key")).isin(*_SPELLED)).select(
        *keys, "_ord", canonical(F.col("_key")).alias("_name"), "_raw",
        F.try_element_at("_by_name", F.col("_key")).alias("_value"),
    )
    shaped = named.select("*", F.schema_of_variant(value).alias("_shape"))
    numbered = shaped.select("*", F.when(_is_real(raw, shape), value.try_cast("double")).alias("_number"))
    leaf = _json_leaf(raw, value, shape, double_text(F.col("_number")))
    parts = ("kind", "text", "head", "items")
    read = numbered.select(*keys, "_ord", "_name", *[leaf[part].alias(f"_{part}") for part in parts])
    kind, text, head, items = (F.col(f"_{part}") for part in parts)
    counts = (kind != "null") & ~is_filler(kind, head, items)
    valued = read.select(*keys, "_ord", "_name", F.when(counts, leaf_value(name, kind, text, head)).alias("_text"))
    some = F.when(F.col("_text").isNotNull(), F.array("_text"))
    return valued.select(
        *keys, F.lit("json").alias("source"), F.col("_ord").alias("ord"), name.alias("param_name"),
        F.explode(some).alias("param_value"),
    )


# --- prose layer -------------------------------------------------------------------


def prose_params(content: Column) -> Column:
    """First match of each prose pattern as an array of (ord, param_name, param_value)."""
    found = F.array(*[
        F.struct(
            F.lit(i).alias("ord"),
            F.lit(name).alias("param_name"),
            F.regexp_extract(content, f"(?U){pattern}", 1).alias("param_value"),
        )
        for i, (name, pattern) in enumerate(vocab.PROSE_PATTERNS.items())
    ])
    return F.filter(found, lambda e: e["param_value"] != "")


def prose_layer(df: DataFrame, keys: Sequence[str], content: str = "content") -> DataFrame:
    return (
        df.select(*keys, F.explode(prose_params(F.col(content))).alias("e"))
        .select(*keys, F.lit("regex").alias("source"), "e.ord", "e.param_name", "e.param_value")
    )


# --- parsed layers -----------------------------------------------------------------


def parsed_params(
    df: DataFrame, keys: Sequence[str], calls: Sequence[str] = vocab.CONFIG_CALLS
) -> DataFrame:
    """(keys, source, rows) of the YAML and Python layers; ``df`` has layer and content.

    A nested config contributes the first leaf per parameter, a source all of its calls.
    """
    leaves = parse_leaves(df, keys, calls)
    nested = F.col("layer") == "yaml"
    named = F.transform(
        "leaves",
        lambda e: F.struct(
            e["ord"].alias("ord"),
            F.when(nested, deepest_canonical(e["name"])).otherwise(canonical(e["name"])).alias(
                "param_name"
            ),
            e.alias("leaf"),
        ),
    )
    rows = let(
        leaf_params(named), lambda r: F.when(nested, once_per_param(r)).otherwise(r)
    )
    return leaves.select(*keys, F.col("layer").alias("source"), rows.alias("rows"))


def layered_params(texts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, source, rows) of texts routed by ``layer``: ast, yaml, json, adapter, prose.

    Prose and JSON are read by expressions, the rest by the batch parsers, as is JSON
    without top-level parameters (but not an adapter config). Everything is narrow: one
    scan, one row per text, no shuffle; texts that are read already do not enter the parsers.
    """
    keys, layer, content = list(keys), F.col("layer"), F.col("content")
    read = texts.select(
        *keys,
        "layer",
        "content",
        F.when(layer == "prose", prose_params(content))
        .when(layer.isin("json", "adapter"), json_params(content))
        .alias("found"),
    )
    unread = layer.isin("ast", "yaml") | ((layer == "json") & (F.size("found") == 0))
    parser = F.when(layer == "ast", "ast").when(unread, "yaml")
    routed = read.select(
        *keys,
        F.when(layer == "prose", "regex").otherwise("json").alias("reader"),
        F.when(~unread, F.col("found")).alias("found"),
        parser.alias("layer"),
        F.when(unread, content).alias("content"),
    )
    told = parsed_params(routed, [*keys, "reader", "found"])
    return told.select(
        *keys, F.coalesce("source", "reader").alias("source"), F.coalesce("found", "rows").alias("rows")
    )


def exploded(found: DataFrame, keys: Sequence[str], rows: Column) -> DataFrame:
    """One row per parameter row, with the confidence of its source."""
    return found.select(*keys, "source", F.explode(rows).alias("e")).select(
        *keys, "source", "e.ord", "e.param_name", "e.param_value",
        _confidence(F.col("source")).alias("confidence"),
    )


# --- files -------------------------------------------------------------------------


def routed_files(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Files with the layer that reads them; dependencies and empty files are left out."""
    path, category = F.lower("file_path"), F.col("file_category")
    config = category == "config"
    layer = (
        F.when(category == "adapter_config", "adapter")
        .when((category == "training_script") & path.endswith(".py"), "ast")
        .when(config & path.rlike(r"\.ya?ml$"), "yaml")
        .when(config & path.endswith(".json"), "json")
        .when(category == "dependencies", F.lit(None).cast("string"))
        .otherwise("prose")
    )
    present = files.filter("content IS NOT NULL AND content <> ''")
    return present.select(*keys, layer.alias("layer"), "content").filter("layer IS NOT NULL")


def read_once(routed: DataFrame, once: bool = False, nothing: bool = False) -> DataFrame:
    """(_layer, _text, source, rows) of each different routed text (layer, content), written.

    Configs and cards are copied from each other, so each different text is read once; ``_text`` is its
    SHA-256. ``once`` keeps the last row of every parameter, ``nothing`` the texts without any row.
    """
    texts = routed.select("layer", "content").distinct()
    named = texts.select(F.col("layer").alias("_layer"), _digest(), "layer", "content")
    rows = once_per_param(F.col("rows"), last=True) if once else F.col("rows")
    read = layered_params(named, ["_layer", "_text"]).select("_layer", "_text", "source", rows.alias("rows"))
    # Spark knows the size of what is written, and leaves the files where they are if it is small.
    return cut_lineage(read if nothing else read.filter(F.size("rows") > 0))


def _digest() -> Column:
    return F.unhex(F.sha2("content", 256)).alias("_text")


def told(routed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of routed texts with what names the text."""
    return routed.select(*keys, F.col("layer").alias("_layer"), _digest())


def found_once(routed: DataFrame, keys: Sequence[str], nothing: bool = False) -> DataFrame:
    """(keys, source, rows) of every routed text (keys, layer, content) in which something is found.

    ``nothing`` keeps the others, too.
    """
    keys = list(keys)
    found = read_once(routed, nothing=nothing)
    return told(routed, keys).join(found, ["_layer", "_text"]).select(*keys, "source", "rows")


def found_in_files(files: DataFrame, keys: Sequence[str], nothing: bool = False) -> DataFrame:
    """(keys, source, rows) of every file in which something is found; ``nothing`` keeps the others that are read."""
    return found_once(routed_files(files, keys), keys, nothing)


def extract_files(files: DataFrame, keys: Sequence[str] = ("repo_full_name", "file_id")) -> DataFrame:
    """Rows of all layers over a table of files (file_path, file_category, content)."""
    return exploded(found_in_files(files, keys), keys, F.col("rows"))


def raw_config_rows(files: DataFrame, repos: DataFrame) -> DataFrame:
    """Rows of the files of usable repositories; per file and parameter the last stays."""
    usable = repos.filter("enrichment_status = 'ok'").select(
        F.col("repo_name").alias("repo_full_name")
    )
    keys = ["repo_full_name", "file_id"]
    routed = routed_files(files, keys)
    found = read_once(routed, once=True)
    # Hashes of the texts meet the repositories, not the texts. Without a hot repository the rows stay
    # dealt by theirs, and a merge by repository moves them no more.
    names = told(routed, keys)
    if hot_keys(files, ["repo_full_name"]).isEmpty():
        kept = names.join(usable, "repo_full_name", "left_semi")
    else:
        kept = skew_join(names, usable, ["repo_full_name"], "left_semi", salt_by=["file_id"], counted=files)
    return exploded(kept.join(found, ["_layer", "_text"]), keys, F.col("rows")).drop("ord")


def repo_params(raw: DataFrame) -> DataFrame:
    """Raw rows to the repositories' parameter table; ties go to the lowest file."""
    return params_table(raw, "repo_full_name", [F.col("file_id"), F.col("source")])


# --- model cards -------------------------------------------------------------------


def card_parts(cards: DataFrame, key: str, content: str = "card_content") -> DataFrame:
    """Front matter, fenced blocks and remaining prose: (key, part, layer, content)."""
    c = F.col(content)
    fence = f"(?sU){vocab.FENCED_BLOCK}"
    matter = F.regexp_extract(c, f"(?sU){vocab.FRONT_MATTER}", 1)
    language = F.lower(F.col("b.language"))
    blocks = F.arrays_zip(
        F.regexp_extract_all(c, F.lit(fence), 2).alias("language"),
        F.regexp_extract_all(c, F.lit(fence), 3).alias("content"),
    )
    marker = F.concat(F.lit("---\n"), matter, F.lit("\n---"))
    bare = F.regexp_replace(c, fence, "\n")
    at = F.when(matter != "", F.instr(bare, marker)).otherwise(0)
    prose = F.when(
        at > 0,
        F.concat(
            F.substring(bare, F.lit(1), at - 1),
            F.substring(bare, at + F.length(marker), F.length(bare)),
        ),
    ).otherwise(bare)
    parts = cards.filter(c.isNotNull() & (c != "")).select(
        key,
        F.posexplode(
            F.concat(
                F.array(F.struct(F.lit("yaml").alias("language"), matter.alias("content"))),
                blocks,
                F.array(F.struct(F.lit("prose").alias("language"), prose.alias("content"))),
            )
        ).alias("part", "b"),
    )
    layer = (
        F.when(language.isin("python", "py", ""), "ast")
        .when(language.isin("yaml", "yml"), "yaml")
        .when(language.isin("json", "prose"), language)
    )
    return parts.select(key, "part", layer.alias("layer"), F.col("b.content").alias("content")).filter(
        F.col("layer").isNotNull() & (strip(F.col("content")) != "")
    )


def extract_cards(cards: DataFrame, key: str = "model_id", content: str = "card_content") -> DataFrame:
    """Rows of all layers over model cards, in card order (part, ord)."""
    keys = [key, "part"]
    found = found_once(card_parts(cards, key, content), keys)
    return exploded(found, keys, F.col("rows"))


def model_params(
    models: DataFrame, adapters: DataFrame | None = None, done: DataFrame | None = None
) -> DataFrame:
    """Parameter table of the models whose card or adapter config was not read yet.

    ``adapters`` (model_id, config_json) counts for relevant models only; its rows come
    before those of the card.
    """
    relevant = F.coalesce(F.col("is_lora_relevant"), F.lit(False))
    todo = models.filter((F.length("card_content") > 200) | relevant)
    if done is not None:
        todo = todo.join(done.select("model_id"), "model_id", "left_anti")
    rows = extract_cards(todo)
    if adapters is not None:
        wanted = adapters.join(todo.filter(relevant).select("model_id"), "model_id", "left_semi")
        configured = json_layer(wanted, ["model_id"], "config_json").withColumns(
            {"part": F.lit(-1), "confidence": F.lit(vocab.SOURCE_CONFIDENCE["json"])}
        )
        rows = rows.unionByName(configured)
    return params_table(rows, "model_id", [F.col("part"), F.col("ord")])


# --- recorded answers --------------------------------------------------------------


def answer_rows(answers: DataFrame, first_files: DataFrame) -> DataFrame:
    """Rows of recorded answers (repo_full_name, answer_json), keyed to the first file.

    Each different answer is read once.
    """
    rows = F.filter(
        json_params(F.col("answer_json"), own_names=True), lambda r: r["param_value"] != ""
    )
    texts = answers.select("answer_json").distinct()
    read = texts.select(
        F.sha2("answer_json", 256).alias("_text"), once_per_param(rows).alias("rows")
    ).filter(F.size("rows") > 0)
    told = answers.select("repo_full_name", F.sha2("answer_json", 256).alias("_text"))
    found = told.join(read, "_text").select("repo_full_name", F.lit("llm").alias("source"), "rows")
    return exploded(found, ["repo_full_name"], F.col("rows")).join(
        first_files, "repo_full_name"
    ).select("repo_full_name", "file_id", "source", "param_name", "param_value", "confidence")


def _category_rank(category: Column) -> Column:
    rank = F.lit(0)
    for i, name in enumerate(vocab.CATEGORY_ORDER, start=1):
        rank = F.when(category == name, i).otherwise(rank)
    return rank


def first_files(files: DataFrame) -> DataFrame:
    """The file an answer is keyed to: first by category, then by id."""
    present = files.filter("content IS NOT NULL")
    return present.groupBy("repo_full_name").agg(
        F.min_by("file_id", F.struct(_category_rank(F.col("file_category")), "file_id")).alias(
            "file_id"
        )
    )


def fallback_inputs(
    files: DataFrame, files_per_repo: int = 6, file_chars: int = 8000, total_chars: int = 24000
) -> DataFrame:
    """One text per repository: its first files, each and all of them capped.

    The first file that overruns the total is cut, later ones are left out. At most
    ``files_per_repo`` rows per repository pass the first window, and the limit is
    applied in the map tasks already.
    """
    by_rank = Window.partitionBy("repo_full_name").orderBy(
        _category_rank(F.col("file_category")), "file_id"
    )
    fence = "```"
    chunk = F.concat(
        F.lit("File: "), "file_path", F.lit(" ("), "file_category", F.lit(f")\n{fence}\n"),
        F.substring("content", 1, file_chars), F.lit(f"\n{fence}\n"),
    )
    chosen = (
        files.filter("content IS NOT NULL")
        .withColumn("_rank", F.row_number().over(by_rank))
        .filter(F.col("_rank") <= files_per_repo)
        .filter(strip(F.col("content")) != "")
        .select("repo_full_name", "_rank", chunk.alias("_chunk"))
    )
    earlier = (
        Window.partitionBy("repo_full_name")
        .orderBy("_rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    left = total_chars - F.coalesce(F.sum(F.length("_chunk")).over(earlier), F.lit(0))
    cut = chosen.withColumn("_left", left).filter("_left > 0").select(
        "repo_full_name", "_rank", F.expr("left(_chunk, int(_left))").alias("_piece")
    )
    ordered = F.sort_array(F.collect_list(F.struct("_rank", "_piece")))
    return cut.groupBy("repo_full_name").agg(
        F.array_join(F.transform(ordered, lambda p: p["_piece"]), "").alias("message")
    )


# --- path trees --------------------------------------------------------------------


def tree_facts(tree: DataFrame, repo: str = "repo", path: str = "path") -> DataFrame:
    """Per repository: has tests, has CI, and the preferred dependency file at the root."""
    lower = F.lower(path)
    base = F.substring_index(lower, "/", -1)
    tests = (
        lower.rlike(r"(?:^|/)tests?(?:/|$)")
        | base.startswith("test_")
        | base.endswith("_test.py")
        | base.endswith(".test.js")
        | base.endswith(".spec.js")
    )
    ci = (
        lower.startswith(".github/workflows/")
        | lower.startswith(".circleci/")
        | base.isin(".travis.yml", ".gitlab-ci.yml", "jenkinsfile")
    )
    listed = F.array(*[F.lit(f) for f in vocab.DEPENDENCY_FILES])
    place = F.array_position(listed, base)
    at_root = ~F.col(path).contains("/") & (place > 0)
    return tree.groupBy(repo).agg(
        F.bool_or(tests).alias("has_tests"),
        F.bool_or(ci).alias("has_ci"),
        F.min_by(base, F.when(at_root, place)).alias("dependency_file"),
    )


def collect_tree_files(tree: DataFrame, per_repo: int = 25) -> DataFrame:
    """The first files per repository, in tree order, that fall into a category."""
    ranked = Window.partitionBy("repo").orderBy("ord")
    return (
        tree.filter("type = 'blob'")
        .withColumn("file_category", file_category(F.col("path")))
        .filter("file_category IS NOT NULL")
        .withColumn("_n", F.row_number().over(ranked))
        .filter(F.col("_n") <= per_repo)
        .drop("_n")
    )
