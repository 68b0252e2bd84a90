import pytest
from pyspark.sql import functions as F

from quadrille.operators import extract, params, reports


def files(spark, *rows):
    return spark.createDataFrame(
        [("r/a", i, *r) for i, r in enumerate(rows)],
        "repo_full_name STRING, file_id BIGINT, file_path STRING, file_category STRING, content STRING",
    )


def found(spark, path, category, content):
    got = extract.extract_files(files(spark, (path, category, content))).orderBy("ord").collect()
    return [(r["source"], r["param_name"], r["param_value"], r["confidence"]) for r in got]


def values(got):
    return {name: value for _, name, value, _ in got}


def test_json_layer(spark):
    blob = '{"r": 8, "lora_alpha": 16, "target_modules": ["q", "v"], "lora_dropout": 0.0, "x": 1}'
    got = found(spark, "adapter_config.json", "adapter_config", blob)
    assert values(got) == {
        "rank_value": "8", "lora_alpha": "16", "target_modules": '["q", "v"]', "lora_dropout": "0.0",
    }
    assert {(s, c) for s, _, _, c in got} == {("json", 1.0)}


@pytest.mark.parametrize(
    "blob, want",
    [
        ('{"r": 16, "lora_alpha": null, "foo": "bar"}', {"rank_value": "16"}),
        ("not-json", {}), ("[1]", {}), ("5", {}),
        ('{"r": 16, "target_modules": ["target_modules"]}', {"rank_value": "16"}),
        ('{"optim": "AdamW (b=1)", "bf16": "true", "fp16": true}', {"optimizer": "adamw", "fp16": "true"}),
        ('{"optimizer": {"type": "AdamW"}, "lr": 2e-5}', {"optimizer": "adamw", "learning_rate": "2e-05"}),
        ('{"scheduler": {"type": "", "name": "Cosine x"}}', {"scheduler": "cosine"}),
        ('{"optimizer": {"type": 3, "name": "sgd"}}', {}),
        ('{"fp16": {"enabled": true}}', {"fp16": '{"enabled": true}'}),
    ],
)
def test_json_rules(spark, blob, want):
    assert values(found(spark, "adapter_config.json", "adapter_config", blob)) == want


def test_yaml_layer(spark):
    flat = "lora_r: 32\nlora_dropout: 0.05\noptimizer: AdamW\nlr_scheduler: cosine w\nbf16: true\nseed: 1\n"
    got = found(spark, "c/lora.yaml", "config", flat)
    assert values(got) == {
        "rank_value": "32", "lora_dropout": "0.05", "optimizer": "adamw", "scheduler": "cosine",
        "bf16": "true",
    }
    assert {(s, c) for s, _, _, c in got} == {("yaml", 0.9)}
    nested = "lora:\n  rank: 16\n  alpha: 32\n  target_modules: [q, v]\nrank: 99\n"
    assert values(found(spark, "c/lora.yml", "config", nested)) == {
        "rank_value": "16", "lora_alpha": "32", "target_modules": '["q", "v"]',
    }
    deepspeed = "optimizer:\n  type: AdamW\n  params:\n    lr: 0.0002\nscheduler:\n  type: WarmupLR\n"
    assert values(found(spark, "c/ds.yaml", "config", deepspeed)) == {
        "optimizer": "adamw", "learning_rate": "0.0002", "scheduler": "warmuplr",
    }


@pytest.mark.parametrize(
    "blob",
    ["lora_r: lora_r\noptimizer: optim\n", "target_modules:\n  - target_modules\n", ":\n:\n::x::", "a: b"],
)
def test_yaml_without_values(spark, blob):
    assert found(spark, "c/lora.yaml", "config", blob) == []


def test_code_layer(spark):
    code = (
        "x = peft.LoraConfig(r=16, target_modules=['q'], bias=none, **kw)\n"
        "print(r=99)\nTrainingArguments(optim='adamw_torch (b)', fp16=True, warmup=f(3))\n"
    )
    assert values(found(spark, "train.py", "training_script", code)) == {
        "rank_value": "16", "target_modules": '["q"]', "lora_bias": "none",
        "optimizer": "adamw_torch", "fp16": "true",
    }
    assert found(spark, "train.py", "training_script", "def f(:\n") == []
    long = f"TrainingArguments(optim='{'a' * 60}')"
    assert found(spark, "train.py", "training_script", long) == []


def test_prose_layer(spark):
    text = "PageRank=16, rank=64, lora_alpha=128, lr=3e-4, num_train_epochs=5 and batch_size=8."
    got = found(spark, "x/train.md", "training_script", text)
    assert values(got) == {
        "rank_value": "64", "lora_alpha": "128", "learning_rate": "3e-4",
        "num_train_epochs": "5", "batch_size": "8",
    }
    assert {(s, c) for s, _, _, c in got} == {("regex", 0.5)}


def test_routes(spark):
    assert found(spark, "requirements.txt", "dependencies", "rank=3") == []
    assert found(spark, "lora/x.toml", "config", "rank=3")[0][0] == "regex"
    assert found(spark, "c/run.json", "config", '{"a": {"r": 4}}')[0][:3] == ("yaml", "rank_value", "4")
    assert found(spark, "c/run.json", "config", '{"r": 4, "a": {"alpha": 5}}') == [
        ("json", "rank_value", "4", 1.0)
    ]
    assert found(spark, "adapter_config.json", "adapter_config", '{"a": {"r": 4}}') == []


def test_the_last_call_of_a_file_stays(spark):
    repos = spark.createDataFrame([("r/a", "ok"), ("r/b", "error")], "repo_name STRING, enrichment_status STRING")
    code = "LoraConfig(r=1, alpha=2)\nLoraConfig(r=3)\n"
    got = extract.raw_config_rows(files(spark, ("train.py", "training_script", code)), repos)
    assert {(r["param_name"], r["param_value"]) for r in got.collect()} == {
        ("rank_value", "3"), ("lora_alpha", "2"),
    }


CARD = (
    "---\nlora_r: 16\ntags:\n  - peft\n---\n# Model\nEarlier rank=8.\n"
    "```python\nLoraConfig(r=4, lora_alpha=32)\n```\n~~~json\n{\"peft\": {\"alpha\": 3}}\n~~~\n"
    "```\nLoraConfig(r=5)\n```\n```bash\nrank=77\n```\nepochs: 3"
)


def test_card_layers(spark):
    cards = spark.createDataFrame([("m", CARD), ("e", ""), ("n", None)], "model_id STRING, card_content STRING")
    got = extract.extract_cards(cards).orderBy("part", "ord").collect()
    assert [(r["source"], r["param_name"], r["param_value"]) for r in got] == [
        ("yaml", "rank_value", "16"), ("ast", "rank_value", "4"), ("ast", "lora_alpha", "32"),
        ("yaml", "lora_alpha", "3"), ("ast", "rank_value", "5"), ("regex", "rank_value", "8"),
        ("regex", "num_train_epochs", "3"),
    ]


def test_card_params_prefer_the_adapter_over_the_card(spark):
    models = spark.createDataFrame(
        [("m", "rank=8 " * 40, True), ("done", CARD * 2, True), ("short", "rank=8", False)],
        "model_id STRING, card_content STRING, is_lora_relevant BOOLEAN",
    )
    adapters = spark.createDataFrame([("m", '{"r": 64, "bias": "all"}')], "model_id STRING, config_json STRING")
    done = spark.createDataFrame([("done",)], "model_id STRING")
    got = extract.model_params(models, adapters, done).collect()
    assert [(r["model_id"], r["rank_value"], r["lora_bias"]) for r in got] == [("m", 64, "all")]


def raw(spark, *rows):
    return spark.createDataFrame(
        [("e", i, *r) for i, r in enumerate(rows)],
        "entity STRING, id INT, source STRING, param_name STRING, param_value STRING, confidence DOUBLE",
    )


def merged(df, names=("rank_value", "optimizer")):
    return params.merge_params(df, ["entity"], [F.col("id")], names).first()


def test_merge_takes_the_best_source_and_means_the_confidence(spark):
    row = merged(raw(
        spark, ("regex", "rank_value", "8", 0.5), ("ast", "rank_value", "16", 1.0),
        ("ast", "rank_value", "17", 1.0), ("yaml", "optimizer", "x", 0.9), ("json", "optimizer", "", 1.0),
    ))
    assert (row["rank_value"], row["optimizer"]) == ("16", "x")
    assert row["param_sources"] == {"rank_value": "ast", "optimizer": "yaml"}
    assert (row["total_params_extracted"], row["extraction_confidence"]) == (2, 0.95)


def test_merge_keeps_an_entity_with_only_empty_values(spark):
    row = merged(raw(spark, ("ast", "rank_value", "", 1.0), ("yaml", "optimizer", None, 0.9)))
    assert (row["total_params_extracted"], row["extraction_confidence"]) == (0, 0.0)


@pytest.mark.parametrize(
    "name, text, want",
    [
        ("rank_value", "0", None), ("rank_value", "-1", -1), ("rank_value", "513", None),
        ("rank_value", "3.7", 3), ("rank_value", " 8 ", 8), ("rank_value", "1e400", None),
        ("lora_alpha", "0", None), ("num_train_epochs", "978", None), ("warmup_steps", "0", 0),
        ("learning_rate", "2e-4", 2e-4), ("learning_rate", "11", None), ("lora_dropout", "nan", None),
        ("bf16", "yes", True), ("bf16", "auto", False), ("bf16", '{"enabled": "auto"}', None),
        ("bf16", "{'enabled': True}", True), ("bf16", '{"enabled": false}', False), ("bf16", "{x", None),
        ("target_modules", "q, v ,", '["q", "v"]'), ("target_modules", '["q","v"]', '["q", "v"]'),
        ("target_modules", '"q"', '["q"]'), ("optimizer", "a" * 60, "a" * 50), ("optimizer", "", None),
    ],
)
def test_typed_values(spark, name, text, want):
    df = spark.createDataFrame([(text,)], "v STRING")
    assert df.select(params.typed_param(name, F.col("v"))).first()[0] == want


def test_answers_and_fallback_inputs(spark):
    answers = spark.createDataFrame(
        [("r/a", '{"rank_value": 8, "r": 9, "optim": "AdamW(x)", "bias": "", "lr": null}')],
        "repo_full_name STRING, answer_json STRING",
    )
    some = files(
        spark, ("requirements.txt", "dependencies", "x"), ("c.yaml", "config", " "),
        ("train.py", "training_script", "y" * 50),
    )
    rows = extract.answer_rows(answers, extract.first_files(some)).collect()
    assert {(r["file_id"], r["source"], r["param_name"], r["param_value"], r["confidence"]) for r in rows} == {
        (2, "llm", "rank_value", "8", 0.7), (2, "llm", "optimizer", "adamw", 0.7),
    }
    text = extract.fallback_inputs(some, file_chars=10, total_chars=60).first()["message"]
    want = f"File: train.py (training_script)\n```\n{'y' * 10}\n```\n"
    assert text == (want + "File: requirements.txt (dependencies)\n```\nx\n```\n")[:60]


def test_tree_facts(spark):
    tree = spark.createDataFrame(
        [("a", "src/Tests/x.py"), ("a", "setup.py"), ("a", "requirements.txt"), ("a", "sub/package.json"),
         ("b", ".github/workflows/ci.yml"), ("b", "contest/x.py")],
        "repo STRING, path STRING",
    )
    got = {r["repo"]: tuple(r)[1:] for r in extract.tree_facts(tree).collect()}
    assert got == {"a": (True, False, "requirements.txt"), "b": (False, True, None)}


def test_nested_values_read_alike_in_json_and_yaml(spark):
    from quadrille.functions import parsers

    value = [1, [2, 3], {"a": 1, "b": "x,y:z"}]
    import json

    text = json.dumps({"target_modules": value})
    rows = found(spark, "adapter_config.json", "adapter_config", text)
    again = found(spark, "c/lora.yml", "config", text)
    assert [r[2] for r in rows] == [r[2] for r in again] == [json.dumps(value)]
    assert [leaf for _, leaf in parsers.call_leaves("f(a=x.y, b=-1, c=[1], d=g(), e=None, h=z)", frozenset("f"))] == [
        ("text", "y", "y", None), ("scalar", "-1", None, None), ("list", "[1]", None, 1), ("null", None, None, None),
        ("null", None, None, None), ("text", "z", "z", None)]


def test_each_different_text_of_files_is_read_once(spark, monkeypatch):
    """Copies of a config in many repositories: the parsers see it once, every file gets its rows."""
    entered = []
    parse = extract.parse_leaves
    monkeypatch.setattr(extract, "parse_leaves", lambda df, *args: entered.append(df.count()) or parse(df, *args))
    texts = ["lora_r: 8\nalpha: 16\n", "lora_r: 4\nlora_r: 5\n", "# nothing\n"]
    files = spark.createDataFrame(
        [(f"o/r{i % 7}", i, "configs/lora.yaml", "config", texts[i % 3]) for i in range(60)]
        + [("o/r0", 60, "configs/lora.json", "config", texts[0]), ("o/r0", 60, "configs/lora.json", "config", texts[0])],
        "repo_full_name string, file_id int, file_path string, file_category string, content string")
    found = extract.extract_files(files).select("repo_full_name", "file_id", "param_name", "param_value").collect()
    assert entered == [4]
    want = {0: [("rank_value", "8"), ("lora_alpha", "16")], 1: [("rank_value", "5")], 2: []}
    of = [(f"o/r{i % 7}", i, *row) for i in range(60) for row in want[i % 3]]
    of += [("o/r0", 60, *row) for row in want[0]] * 2
    assert sorted(map(tuple, found)) == sorted(of)


def test_each_different_answer_is_read_once(spark):
    """Equal answers of many repositories meet one reading; every repository gets its rows."""
    answers = spark.createDataFrame([(f"r/{i}", '{"rank_value": 8}') for i in range(20)], "repo_full_name STRING, answer_json STRING")
    first = spark.createDataFrame([(f"r/{i}", i) for i in range(20)], "repo_full_name STRING, file_id INT")
    rows = extract.answer_rows(answers, first)
    assert sorted(r["file_id"] for r in rows.collect()) == list(range(20))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [answer_json" in plan


def test_each_different_text_of_cards_is_read_once(spark, monkeypatch):
    """Copies of a card: the parsers see its parts once, every model gets its rows."""
    entered, parse = [], extract.parse_leaves
    monkeypatch.setattr(extract, "parse_leaves", lambda df, *args: entered.append(df.count()) or parse(df, *args))
    cards = spark.createDataFrame([(f"m{i}", "---\nlora_r: 4\n---\nrank=8\n") for i in range(20)], "model_id STRING, card_content STRING")
    rows = extract.extract_cards(cards).collect()
    assert len({r["model_id"] for r in rows}) == 20 and len(rows) == 40
    assert entered == [2]


def test_raw_rows_stay_dealt_by_their_repository(spark, monkeypatch):
    some = files(
        spark, ("out/adapter_config.json", "adapter_config", '{"r": 8}'), ("c/lora.yaml", "config", "lora_r: 4\n"),
    )
    repos = spark.createDataFrame([("r/a", "ok")], "repo_name STRING, enrichment_status STRING")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = extract.raw_config_rows(some, repos)
        planned = extract.repo_params(raw)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_salt_l" not in planned
    # A hot repository is spread, with the same rows.
    hot = extract.hot_keys
    monkeypatch.setattr(extract, "hot_keys", lambda df, keys: hot(df, keys, 1))
    spread = extract.raw_config_rows(some, repos)
    assert "_salt_l" in spread._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, raw.collect())) != []


def test_yield_counts_files_without_parameters(spark):
    some = files(
        spark, ("a/train.py", "training_script", "x = 1\n"), ("b/train.py", "training_script", "LoraConfig(r=8)\n"),
        ("c/train.py", "training_script", "x = 1\n"),
    )
    found = reports.extraction_yield(extract.found_in_files(some, ["file_id"], nothing=True))
    assert [tuple(r) for r in found.collect()] == [("ast", 3, 1, 1)]


def test_json_layer_reads_entries_as_rows(spark):
    texts = [
        '{"r": 8, "lora_alpha": 16.0, "target_modules": ["q", "v"], "lora_dropout": 0.1, "x": 1}', "[1]", "nonsense", "", None,
        '{"optim": "AdamW (b)", "lr": 2e-5, "bf16": "auto", "fp16": null, " Epochs ": 1e3, "bias": {"type": "", "name": "Cosine x"}}',
        '{"lr": 0.30000000000000004, "alpha": 12345678901234567890, "r": -0.0, "optimizer": {"name": "sgd"}, "scheduler": ["cos in"]}',
        '{"z": 1, "r": 1, "r": 2, "target_modules": ["target_modules"], "warmup": [], "lr_scheduler": "", "alpha": {"b": [1, "c: d"]}}',
        '{"modules_to_save": "a,b", "lr": 1E400, "dropout": 1e-7, "epochs": 3.50, "batch_size": true}', "{}", '{"r": 1',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, content STRING")
    got = extract.json_layer(df, ["id"])
    want = df.select("id", F.explode(extract.json_params(F.col("content"))).alias("e")).select(
        "id", F.lit("json").alias("source"), "e.ord", "e.param_name", "e.param_value")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 15
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.schema.names == want.schema.names and "Generate posexplode(from_json(" in plan
