import pytest

from quadrille.plans import queries
from quadrille.streaming import arrivals


@pytest.mark.parametrize("parts", [1, 3])
def test_a_stream_reads_a_table_that_is_a_folder_and_one_that_is_a_file(spark, tmp_path, rows, parts):
    events = spark.createDataFrame([(i, f"t{i % 2}") for i in range(10)], "id int, kind string")
    folder = tmp_path / "in"
    events.repartition(parts).write.parquet(str(folder / "events.parquet"))
    if parts == 1:
        (part,) = (folder / "events.parquet").glob("part-*.parquet")
        folder = tmp_path / "single"
        folder.mkdir()
        (folder / "events.parquet").write_bytes(part.read_bytes())
    events.limit(1).write.parquet(str(folder / "other.parquet"))
    stream = arrivals.arriving(spark, str(folder), events.schema, names="events.parquet")
    arrivals.append_stream(stream, str(tmp_path / "table"), str(tmp_path / "progress")).awaitTermination()
    assert rows(arrivals.stored_batches(spark, str(tmp_path / "table")).drop("batch")) == rows(events)


def test_stream_relevance_over_documents_in_a_folder(spark, tmp_path, rows):
    docs = [(1, "the thing", "en", "src1"), (2, "de that", "fr", "src2"), (3, "nothing", "es", "src0")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(2).write.parquet(
        str(tmp_path / "documents.parquet"))
    assert rows(queries.stream_relevance(spark, str(tmp_path))) == rows(queries.relevance_filter(spark, str(tmp_path)))
