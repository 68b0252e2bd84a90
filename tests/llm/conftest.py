import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(__file__))

SF_DIR = "/root/testdata/sf0.001"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(12_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven small cats watch from a warm stone wall"
NEAR = PROSE.replace("seven", "eight")
# Nulls, empty and blank texts, no letters, a very long one, copies, near copies, ties, odd spaces.
TEXTS = [
    None, "", " \n\t ", "123 !!! 456", LONG, PROSE, PROSE, NEAR, f"{PROSE}\n{NEAR}\n\nshort line\nshort line",
    f"Intro one two\n{PROSE.upper()}\nlast", "a", "a b", "ÀÉ ß É é　x 日本語 текст",
    PROSE.replace("quick ", ""), PROSE.replace("lazy", "very lazy"), "x\x0by\x0cz\x1cq\x85r s t u v w",
    "<|endoftext|> it's <s>I'd</s> ▁▁ 'LL", "a b c d e f g h i j k l m n o p q r s t u v w x y z",
]


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents; doc_id 5 comes twice with one text and once with another, NULL thrice."""
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 else "s", None) for i, t in enumerate(TEXTS)]
    rows += [(5, PROSE, "en", "s", 1), (5, "another text under the same id as before", None, None, 2)]
    rows += [(None, PROSE, None, None, None), (None, None, "de", None, None), (None, PROSE, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def corpus(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def run(spark):
    """A registered query over the smallest tables, as a list of rows."""
    from quadrille.llm.queries import QUERIES

    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return lambda name: QUERIES[name](spark, SF_DIR).collect()


def pairs(df):
    """(doc_id, text) of all rows, in a fixed order."""
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
