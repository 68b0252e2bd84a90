"""From documents to checked tokens: language ID, line dedup, near-dedup, decontamination, BPE.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import bpe_numpy, decontaminate, language_id, line_dedup, simhash
from quadrille.llm.common import staged, table
from quadrille.llm.queries import BYTES

# SQL can express neither the language stage nor the tokens.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, no letter) go; only those, if no language was learned."""
    model = language_id.fit(docs.filter(language_id.remainder() != 0))
    if not model.languages:
        model = language_id.letters_only()
    found = language_id.identify(docs, model, into="__lang", score="__score")
    return found.filter(F.col("__lang") != language_id.UNDETERMINED).select(*docs.columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and so do documents of which nothing is left."""
    kept = line_dedup.dedup_lines(docs, n_lines="__lines", n_removed="__removed")
    some = (F.col("__removed") == 0) | (F.trim("text") != "")
    sized = {"n_chars": F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars"))}
    return kept.filter(some).withColumns(sized if "n_chars" in docs.columns else {}).select(*docs.columns)


def one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints (two bits, as in op5) stays."""
    return simhash.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of what they decode to."""
    return bpe_numpy.token_digests(docs.select("doc_id", "text"), public_tokenizers.path(BYTES))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", fresh_lines),
    ("simhash_dedup", one_of_a_kind),
    ("decontamination", uncontaminated),
    ("bpe_codec", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
