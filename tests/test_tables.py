"""Joins, keyed writes, streams, quality, incremental sets and the warehouse build."""

import glob
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.operators import incremental, quality, reports, skew
from quadrille.plans import warehouse
from quadrille.schemas import ACTIVITY_EVENT, bronze_schema
from quadrille.sources import bronze, sinks
from quadrille.streaming import arrivals


# --- skew --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sides(spark):
    random.seed(8)
    key = lambda: random.choice([None, "hot", "hot", "hot", *"abcdefgh"])
    left = [(i, key()) for i in range(300)]
    right = [(key(), i) for i in range(60)]
    return (
        spark.createDataFrame(left, "l INT, k STRING"),
        spark.createDataFrame(right, "k STRING, r INT"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_is_a_plain_join(sides, rows, how):
    left, right = sides
    want = rows(left.join(right, ["k"], how))
    for task_rows in (skew.TASK_ROWS, 40, 1):
        assert rows(skew.skew_join(left, right, ["k"], how, task_rows=task_rows)) == want


def test_a_key_is_split_by_its_own_count(spark):
    """One key with a third and one with a hundredth of the rows: no join task gets many of either."""
    keys = [("third" if i % 3 == 0 else "hundredth" if i % 100 == 1 else f"k{i}") for i in range(30_000)]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "l INT, k STRING").repartition(8)
    hot = {r["k"]: r["_salts"] for r in skew.hot_keys(left, ["k"], 100).collect()}
    assert hot == {"third": 100, "hundredth": 2}
    right = spark.createDataFrame([(k, 1) for k in sorted(set(keys))], "k STRING, r INT")
    joined = skew.skew_join(left, right, ["k"], "left", task_rows=100, unique_right=True)
    assert joined.count() == 30_000 and joined.filter("r IS NULL").count() == 0
    salted = left.filter("k = 'third'").withColumn("s", skew.salt_of("l", "k", salts=F.lit(100)))
    assert salted.groupBy("s").count().agg(F.max("count")).first()[0] < 200
    copies = left.select(F.lit("same").alias("k")).withColumn("s", skew.salt_of("k", salts=100))
    assert copies.select("s").distinct().count() > 4


def test_skew_join_with_condition(sides, rows):
    left, right = sides
    got = skew.skew_join(left, right, ["k"], condition=F.col("l") < F.col("r"))
    want = left.join(right, "k").filter("l < r")
    assert rows(got.select("k", "l", "r")) == rows(want.select("k", "l", "r"))


def test_lookup_join_in_both_forms(sides, rows, monkeypatch):
    left, _ = sides
    groups = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.max("l").alias("top"))
    want = rows(left.join(groups.drop("rows"), "k", "left").select("l", "k", "top"))
    assert rows(skew.lookup_join(left, groups, "k").select("l", "k", "top")) == want
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 2)
    assert rows(skew.lookup_join(left, groups, "k").select("l", "k", "top")) == want


def test_pick_per_key(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 5, "z")], "k STRING, o INT, v STRING")
    assert rows(skew.pick_per_key(df, ["k"], [F.col("o")])) == [("a", 1, None), ("b", 5, "z")]
    assert rows(skew.pick_per_key(df, ["k"], [F.col("o")], last=True)) == [("a", 2, "x"), ("b", 5, "z")]


# --- keyed writes ------------------------------------------------------------------


def test_upsert_updates_inserts_and_is_idempotent(spark, rows):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "id INT, v STRING, w STRING")
    batch = spark.createDataFrame(
        [(2, "old", "n", 1), (2, "new", "n", 2), (3, None, "n", 1)], "id INT, v STRING, w STRING, o INT"
    )
    once = sinks.upsert(target, batch, ["id"], ["v"], [F.col("o")])
    want = [(1, "a", "keep"), (2, "new", "keep"), (3, None, "n")]
    assert rows(once) == want
    assert rows(sinks.upsert(once, batch, ["id"], ["v"], [F.col("o")])) == want


def test_insert_ignore_and_mark_done(spark, rows):
    target = spark.createDataFrame([(1, False), (2, False)], "id INT, done BOOLEAN")
    batch = spark.createDataFrame([(2, 1), (3, 2), (3, 1)], "id INT, o INT")
    assert rows(sinks.insert_ignore(target, batch, ["id"], [F.col("o")])) == [(3, 1)]
    assert rows(sinks.mark_done(target, batch, "id", "done")) == [(1, False), (2, True)]


def test_versions_are_seen_when_complete(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, path)
    assert sinks.write_version(spark.range(2), path) == 1
    assert sinks.write_version(spark.range(3), path) == 2
    (tmp_path / "t" / "version=3").mkdir()
    assert sinks.read_version(spark, path).count() == 3
    assert sinks.read_version(spark, path, 1).count() == 2


# --- streams -----------------------------------------------------------------------


def test_stream_equals_batch_and_survives_a_second_run(spark, rows, tmp_path):
    random.seed(9)
    schema = "id INT, v INT, first INT, o INT"
    events = [(random.randint(0, 20), random.randint(0, 9), i, i) for i in range(200)]
    source = str(tmp_path / "in")
    for part in range(4):
        frame = spark.createDataFrame(events[part * 50 : part * 50 + 50], schema)
        frame.coalesce(1).write.mode("append").parquet(source)
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def run():
        stream = arrivals.arriving(spark, source, frame.schema, files_per_batch=1)
        arrivals.upsert_stream(
            stream, table, progress, ["id"], ["v", "o"], [F.col("o")]
        ).awaitTermination()
        return rows(arrivals.current(spark, table, ["id"], ["v", "o"]).select("id", "v", "first", "o"))

    by_id = {}
    for i, v, first, o in events:
        by_id[i] = (i, v, by_id.get(i, (0, 0, first))[2], o)
    want = sorted(by_id.values(), key=lambda r: tuple((False, str(x)) for x in r))
    got = run()
    # files may arrive in any order; order by o decides only inside a batch
    assert [r[0] for r in got] == [r[0] for r in want]
    assert run() == got
    assert len(glob.glob(f"{table}/batch=*")) == 4


def test_insert_stream_keeps_first_rows(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, 2), (1, 1), (2, 1)], "id INT, o INT").coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema
    for _ in range(2):
        stream = arrivals.arriving(spark, source, schema)
        arrivals.insert_stream(
            stream, str(tmp_path / "t"), str(tmp_path / "p"), ["id"], [F.col("o")]
        ).awaitTermination()
    stored = arrivals.stored_batches(spark, str(tmp_path / "t")).drop("batch")
    assert rows(stored) == [(1, 1), (2, 1)]


def test_folded_batches_are_read_once_and_joined_by_newer_ones(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "id INT, v INT, o INT"
    write = lambda n, *r: spark.createDataFrame(list(r), schema).write.parquet(f"{path}/batch={n}")
    read = lambda: rows(arrivals.current(spark, path, ["id"], ["v"]))
    assert arrivals.fold_batches(spark, path, ["id"], ["v"]) is None
    write(0, (1, 10, 1), (2, 20, 1))
    write(1, (1, 11, 2))
    before = read()
    assert arrivals.fold_batches(spark, path, ["id"], ["v"]) == 1
    assert arrivals.fold_batches(spark, path, ["id"], ["v"]) == 1
    assert read() == before == [(1, 11, 1), (2, 20, 1)]
    assert all("batch=" not in f for f in arrivals.stored_batches(spark, path).inputFiles())
    write(2, (2, 21, 3), (3, 30, 3))
    assert read() == [(1, 11, 1), (2, 21, 1), (3, 30, 3)]
    # a replay of batch 1 sees what came before it
    assert rows(arrivals.stored_batches(spark, path, before=1).select("id", "v")) == [(1, 10), (2, 20)]


def test_named_upserts_leave_names_and_ids(spark, rows):
    repos = "repo_id INT, repo_name STRING, homepage STRING, enriched_at INT"
    merged = sinks.upsert_enriched_repos(
        spark.createDataFrame([(1, "a/old", "x", 1)], repos),
        spark.createDataFrame([(1, "a/new", None, 2), (2, "b/b", "y", 2)], repos),
    )
    assert rows(merged) == rows(spark.createDataFrame([(1, "a/old", None, 2), (2, "b/b", "y", 2)], repos))
    files = "file_id INT, repo_full_name STRING, file_path STRING, content STRING, fetched_at INT"
    merged = sinks.upsert_files(
        spark.createDataFrame([(7, "a/b", "p", "old", 1)], files),
        spark.createDataFrame([(9, "a/b", "p", "new", 2)], files),
    )
    assert rows(merged) == [(7, "a/b", "p", "new", 2)]


def test_relevant_events_on_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(
        '{"type": "PushEvent", "repo": {"name": "a/b", "topics": ["x"]}, '
        '"payload": {"commits": [{"message": "use LoRA"}]}}\n'
        '{"type": "WatchEvent", "repo": {"name": "a/defi-lora"}}\n'
    )
    stream = arrivals.arriving(spark, str(source), ACTIVITY_EVENT, "json")
    kept = arrivals.relevant_events(stream)
    query = kept.writeStream.format("memory").queryName("kept").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r["repo"]["name"] for r in spark.table("kept").collect()] == ["a/b"]


# --- quality -----------------------------------------------------------------------


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, None, 2.0), (None, "x", None)], "id INT, s STRING, c DOUBLE")
    q = quality
    checks = [
        q.min_rows(3), q.min_rows(4), q.not_null("id"), q.unique("id"), q.in_set("s", ["a"]),
        q.between("c", 0, 1), q.unique("s"),
    ]
    got = {(r["expectation"], r["observed"], r["success"]) for r in q.check_table(df, "t", checks).collect()}
    assert got == {
        ("min_rows", 3, True), ("min_rows", 3, False), ("not_null(id)", 1, False),
        ("unique(id)", 1, False), ("in_set(s)", 1, False), ("between(c)", 1, False),
        ("unique(s)", 0, True),
    }
    with pytest.raises(quality.QualityError, match="unique\\(id\\)"):
        q.gate(q.check_table(df, "t", [q.unique("id")]))
    q.gate(q.check_table(df.limit(0), "t", [q.unique("id"), q.not_null("id"), q.between("c", 0, 1)]))


# --- incremental -------------------------------------------------------------------


def test_backlogs(spark):
    log = spark.createDataFrame(
        [(1, "a", "code", "2024-01-01", False), (2, "b", "repo_search", "2024-01-03", False),
         (3, "c", "repo_search", "2024-01-02", False), (4, "d", "code", "2024-01-04", True), (5, "e", "code", "2024-01-05", False)],
        "repo_id INT, repo_name STRING, search_source STRING, discovered_at STRING, enriched BOOLEAN",
    )
    done = spark.createDataFrame([(5,)], "repo_id INT")
    assert [r[0] for r in incremental.enrichment_backlog(log, done, 2).collect()] == [4, 2]
    assert [r[0] for r in incremental.discovery_backlog(log, done, 9).collect()] == [3, 2, 1]


def test_stale_and_changed(spark):
    rows = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "k INT, at INT")
    done = spark.createDataFrame([(1, 4), (2, 5)], "k INT, done INT")
    assert {r[0] for r in incremental.stale(rows, done, "k", "at", "done").collect()} == {1, 3}
    tree = spark.createDataFrame(
        [("r", "a", "1"), ("r", "b", "2"), ("r", "c", ""), ("r", "d", "4")], "repo STRING, path STRING, sha STRING"
    )
    stored = spark.createDataFrame(
        [("r", "a", "1"), ("r", "b", "x"), ("r", "c", "")], "repo_full_name STRING, file_path STRING, file_sha STRING"
    )
    assert {r["path"] for r in incremental.changed_files(tree, stored).collect()} == {"b", "c", "d"}


def test_date_windows(spark):
    days = spark.createDataFrame([("2022-12-31",), ("2023-06-30",), ("2023-07-01",), ("2025-01-01",), (None,)], "d STRING")
    got = [r[0] for r in days.select(incremental.date_window(F.col("d").cast("date"))).collect()]
    assert got == [
        "created:<2023-01-01", "created:2023-01-01..2023-06-30", "created:2023-07-01..2023-12-31",
        "created:>=2025-01-01", None,
    ]


def test_floor(spark):
    df = spark.createDataFrame([(1, None), (2, 9), (3, 10)], "k INT, downloads INT")
    assert {r[0] for r in incremental.above_floor(df, "downloads", 10).collect()} == {3}
    assert {r[0] for r in incremental.above_floor(df, "downloads", 10, False).collect()} == {1, 3}


# --- warehouse ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    data = {
        "github_repos_enriched": [
            dict(repo_id=1, repo_name="a/x", enrichment_status="ok", primary_language="Python"),
            dict(repo_id=2, repo_name="a/y", enrichment_status=None),
        ],
        "github_repos_bronze": [dict(repo_id=1, repo_name="a/x", star_count=7)],
        "huggingface_models_bronze": [
            dict(model_id=f"o/m{i}", base_model="o/m0" if i else "o/m0", downloads=i * 10, likes=i,
                 tags='["peft"]', is_lora_relevant=True if i < 4 else None) for i in range(5)
        ],
        "github_hf_links": [
            dict(repo_full_name="a/x", model_id="o/m1", link_type="same_username", confidence=0.7),
            dict(repo_full_name="a/x", model_id="o/m1", link_type="fuzzy_name", confidence=0.9),
        ],
        "github_files": [
            dict(file_id=1, repo_full_name="a/y", file_path="t.py", file_category="training_script", file_size=3),
            dict(file_id=2, repo_full_name="a/x", file_path="c.yaml", file_category="config", file_size=4),
        ],
        "lora_configs_raw": [],
        "github_repos_embedded": [],
        "repo_lora_params": [dict(repo_full_name="a/x", rank_value=8)],
        "hf_models_lora_params": [
            dict(model_id=f"o/m{i}", rank_value=8 if i % 2 else 16, bf16=True) for i in range(5)
        ],
    }
    for name, entries in data.items():
        schema = bronze_schema(name)
        table = [
            tuple(
                Decimal(str(e[f.name])) if f.name == "confidence" and f.name in e else e.get(f.name)
                for f in schema.fields
            )
            for e in entries
        ]
        spark.createDataFrame(table, schema).write.parquet(f"{root}/{name}")
    return warehouse.build_all(bronze.load_bronze(spark, root))


def test_every_mart_builds_and_exports(built, tmp_path):
    marts = warehouse.Marts(built)
    written = {n: c for n, c, _ in sinks.export_tables(marts.all(), str(tmp_path), {"github_files": ["content"]})}
    assert written == {
        "outcomes": 4, "practice_stats": 3, "repo_lora_params": 1, "hf_model_tree": 1, "hf_model_tree_edges": 4,
        "hf_models_lora_params": 5, "repos": 2, "hf_models": 5, "github_hf_links": 1,
        "repos_needing_llm": 1, "github_files": 2,
    }
    assert marts.load("outcomes", 2).count() == 2
    with pytest.raises(KeyError):
        marts.load("nope")


def test_marts_hold_what_they_should(built):
    repos = {r["repo_id"]: r for r in built["repos"].collect()}
    assert repos[1]["is_enriched"] is True and repos[1]["star_count"] == 7
    assert repos[2]["is_enriched"] is None
    link = built["silver_github_hf_links"].first()
    assert (link["best_confidence"], link["link_types"], link["is_high_confidence"], link["primary_language"]) == (
        0.9, "fuzzy_name,same_username", True, "Python")
    tree = built["hf_model_tree"].first()
    assert (tree["fine_tune_count"], tree["total_downloads"]) == (4, 100)
    assert sorted(r["model_id"] for r in built["hf_model_tree_edges"].collect()) == ["o/m1", "o/m2", "o/m3", "o/m4"]
    assert built["repos_needing_llm_extraction"].first()["repo_full_name"] == "a/y"
    results = quality.run_suites(built, quality.MODEL_SUITES)
    assert results.filter("NOT success").count() == 0


def test_link_types_need_no_list(spark):
    rows = [("r", "m", t, 0.5, None) for t in ("new", "same_username", "new")]
    df = spark.createDataFrame(rows, "repo_full_name string, model_id string, link_type string, confidence double, created_at timestamp")
    assert warehouse.collapsed_links(df).first()["link_types"] == "new,same_username"


def test_a_missing_column_is_an_error(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1,)], "a INT")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    with pytest.raises(ValueError, match="b"):
        bronze.conform(df, schema)
    assert bronze.conform(df, schema, ["b"]).first() == (1, None)


def test_medians_of_a_null_group(spark):
    from quadrille.operators import ranks

    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g STRING, v DOUBLE")
    for rows in (0, 1000):
        got = {r["g"]: r["m"] for r in ranks.group_medians(df, ["g"], "v", "m", rows).collect()}
        assert got == {None: 2.0, "a": 5.0}


def test_bytes_become_text(spark):
    df = spark.createDataFrame([(1, bytearray("é".encode()))], "id INT, t BINARY")
    assert bronze.bytes_to_text(df).first()["t"] == "é"


def test_top_groups(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "p STRING, q STRING")
    got = [tuple(r) for r in reports.top_of_each(df, ["p", "q"], 1).collect()]
    assert got == [("p", "a", 2), ("q", "(none)", 2)]
    assert set(vocab.LINK_TYPES) >= {"fuzzy_name"}
