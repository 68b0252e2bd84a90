import hashlib

import corpus_pipeline
import numpy as np
from conftest import SF_DIR, pairs
from pyspark.sql import functions as F
from test_decontaminate import slow as slow_hits
from test_line_dedup import slow as slow_lines
from test_near_copies import slow_kept
from test_tokens import ids_of

from quadrille.llm.common import text_key


def brute_force(spark, docs, items):
    """The rows of the pipeline by comparing everything with everything."""
    keys = {(r.doc_id, r.text): r.k for r in docs.select("doc_id", "text", text_key().alias("k")).collect()}
    rows = [(d, t) for d, t in pairs(docs) if any(c.isalpha() for c in t or "")]
    kept = []
    for (doc, text), gone in slow_lines(rows, keys).items():
        left = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)
        if not gone or left.strip(" "):
            kept.append((doc, left))
    alone = set(slow_kept(kept))
    kept = [row for row in kept if row[0] in alone]
    kept = [row for row in kept if not slow_hits([row], items)[0][4]]
    return sorted(
        (doc, len(ids_of(text)), hashlib.sha256(np.array(ids_of(text), "<u4").tobytes()).hexdigest(),
         hashlib.sha256(text.encode()).hexdigest()) for doc, text in kept)


def test_pipeline_against_brute_force(spark, corpus):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect())) == brute_force(spark, corpus, items)


def test_stages_keep_the_columns_of_documents(spark, docs, corpus):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_dedup", "decontamination", "bpe_codec"]
    for start in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, start, SF_DIR).columns == docs.columns


def test_documents_stay_when_no_language_can_be_learned(spark, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.known_language(spark, unlabelled, SF_DIR)
    want = [row for row in pairs(docs) if any(c.isalpha() for c in row[1] or "")]
    assert pairs(kept) == want and want
