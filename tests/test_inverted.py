import numpy as np
import pytest

from quadrille.operators import inverted, vectors


def cloud(spark, n, groups=20, width=16, seed=1, common=0):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(groups, width))
    rows = [(i, (heads[i % groups] + 0.4 * rng.normal(size=width)).tolist()) for i in range(n)]
    rows += [(n + i, [1.0] * width) for i in range(common)]
    return rows, spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)


def slow(rows, asked, k):
    matrix = vectors._unit(np.array([v for _, v in rows]))
    found = {}
    for q, vector in asked:
        scores = np.round(matrix @ vectors._unit(np.array([vector]))[0], vectors.SCORE_DIGITS)
        found[q] = [i for _, i in sorted((-s, i) for s, (i, _) in zip(scores, rows))[:k]]
    return found


def by_question(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.question, r.rank)):
        found.setdefault(r.question, []).append(r.id)
    return found


@pytest.mark.parametrize("how", [{}, {"question_block": 3, "matrix_bytes": 2000}])
def test_exact_search_keeps_questions_in_tables(spark, how):
    rows, points = cloud(spark, 400, common=200)
    asked = [r for r in rows if r[0] % 50 == 0]
    questions = points.filter("id % 50 = 0").withColumnRenamed("id", "question")
    centre = np.zeros((1, 1))
    index = inverted.file_points(points, centre, block=90)
    assert index.agg({"part": "max"}).first()[0] == 6
    found = inverted.search_index(index, centre, questions, 5, probes=1, **how)
    assert by_question(found) == slow(rows, asked, 5)


def test_index_files_every_point_and_finds_nine_tenths(spark):
    rows, points = cloud(spark, 2000, common=1000)
    centres = inverted.fit_cells(points, 32)
    index = inverted.file_points(points, centres, block=200)
    assert index.count() == 3000
    # A cell with a third of the points is many blocks.
    assert max(r["count"] for r in index.groupBy("cell", "part").count().collect()) < 320
    questions = points.filter("id % 50 = 0").withColumnRenamed("id", "question")
    exact = inverted.search_exact(points, questions, 10)
    told = inverted.recall(inverted.search_index(index, centres, questions, 10, probes=6), exact).first()
    assert told.questions == 60 and told.recall >= 0.9
    every = inverted.search_index(index, centres, questions, 10, probes=32)
    assert by_question(every) == by_question(exact)


def test_odd_vectors_and_empty_tables(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [1.0, 0.0]), (5, [-1.0, 0.0])]
    points = spark.createDataFrame(rows, "id long, vector array<double>")
    questions = spark.createDataFrame([("q", [2.0, 0.0]), ("none", None)], "question string, vector array<double>")
    centres = inverted.fit_cells(points, 2)
    found = inverted.search_index(inverted.file_points(points, centres), centres, questions, 2, probes=2)
    assert by_question(found) == {"q": [2, 4]}
    none = points.limit(0)
    assert inverted.search_exact(none, questions, 2).collect() == []
    assert inverted.search_exact(points, questions.limit(0), 2).collect() == []
    assert len(inverted.fit_cells(none, 4)) == 1


def test_blocks_ask_for_every_vector(spark, tmp_path):
    """More questions than travel with the tasks: every vector of the table is one, ties included."""
    from quadrille.plans.queries import QUERIES

    rows, points = cloud(spark, 320, common=20)
    points.selectExpr("id AS vec_id", "vector AS embedding", "id % 10 AS label").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert by_question(QUERIES["vector_topk_blocks"](spark, str(tmp_path))) == slow(rows, rows, 3)


@pytest.mark.parametrize("tile", [30, 1000])
def test_tiles_of_questions_keep_ties_and_repeated_questions(spark, tile):
    rows, points = cloud(spark, 150, width=4, common=100)
    asked = [(i, v) for i, v in rows if i % 3 == 0]
    questions = spark.createDataFrame([*asked, *asked], "question long, vector array<double>")
    named = points.selectExpr("concat('p', lpad(id, 4, '0')) AS id", "vector")
    centre = np.zeros((1, 1))
    index = inverted.file_points(named, centre, block=40)
    found = inverted.search_index(index, centre, questions, 4, 1, question_block=7, matrix_bytes=600, tile=tile)
    twice = {q: [f"p{i:04d}" for i in ids[:2] for _ in range(2)] for q, ids in slow(rows, asked, 2).items()}
    assert by_question(found) == twice


def test_vectors_of_floats_travel_as_such(spark):
    points = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, None)], "id long, vector array<float>")
    index = inverted.file_points(points, np.zeros((1, 1)))
    assert index.schema["vector"].dataType.simpleString() == "array<float>"
    found = inverted.search_exact(points, points.withColumnRenamed("id", "question"), 1)
    assert sorted((r.question, r.id, r.score) for r in found.collect()) == [(1, 1, 1.0), (2, 2, 1.0)]
