"""The corpus tables, derived from the TPC-H-style tables that queries are checked on.

Parts play the models, customers the repositories and orders the repositories' files;
line items supply adoption counts and raw parameter rows. Every mapping covers its
whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_id(key: str) -> F.Column:
    return F.concat(F.lit("part/"), F.col(key).cast("string"))


def models_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as published models; returned line items as their adoption."""
    adoption = (
        table(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'R'")
        .groupBy("l_partkey")
        .agg(
            F.sum("l_quantity").cast("bigint").alias("downloads"),
            F.countDistinct("l_orderkey").alias("likes"),
        )
    )
    part = table(spark, sf_dir, "part")
    return part.join(adoption, part.p_partkey == adoption.l_partkey, "left").select(
        model_id("p_partkey").alias("model_id"),
        F.col("p_brand").alias("author"),
        F.when(F.col("p_type") != "PROMO", model_id("p_size")).alias("base_model"),
        F.col("p_type").alias("pipeline_tag"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("library_name"),
        "downloads",
        "likes",
        F.to_json(
            F.array(F.col("p_brand"), F.concat(F.lit("base_model:adapter:"), model_id("p_size")))
        ).alias("tags"),
        F.when(F.col("p_brand") != "Brand#10", F.col("p_brand") != "Brand#11").alias(
            "is_lora_relevant"
        ),
        F.when(F.col("p_size") > 25, "organic").otherwise("targeted_lora").alias(
            "collection_source"
        ),
    )


def model_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training parameters of the models, one row per part of all brands but one."""
    size = F.col("p_size")
    return (
        table(spark, sf_dir, "part")
        .filter("p_brand <> 'Brand#7'")
        .select(
            model_id("p_partkey").alias("model_id"),
            size.alias("rank_value"),
            (size * 2).cast("double").alias("lora_alpha"),
            F.split_part("p_name", F.lit(" "), F.lit(1)).alias("optimizer"),
            F.lower("p_type").alias("scheduler"),
            (size / 100000).alias("learning_rate"),
            F.when(size > 10, F.floor(size / 10) / 100).alias("lora_dropout"),
            (F.col("p_retailprice") > 950).alias("bf16"),
            F.when(F.col("p_retailprice") > 950, F.lit(0.0)).otherwise(F.lit(1.0)).alias("fp16"),
        )
    )


def full_name(nation: str, name: str) -> F.Column:
    return F.concat_ws("/", F.col(nation), F.col(name))


def repos_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as repositories of their nation."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    balance = F.col("c_acctbal")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("repo_id"),
        full_name("n_name", "c_name").alias("repo_name"),
        F.concat_ws(" ", F.lit("Recipes of"), F.lower("c_mktsegment")).alias("description"),
        F.col("c_mktsegment").alias("primary_language"),
        (balance > 5000).alias("has_tests"),
        (balance > 8000).alias("has_ci"),
        F.floor(F.abs(balance) / 100).cast("int").alias("contributors_count"),
        F.when(balance < 0, "not_found").when(balance < 9500, "ok").alias("enrichment_status"),
    )


def repos_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity counts from urgent orders; customers without any have no row."""
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("repo_id"))
        .agg(
            F.count(F.lit(1)).alias("star_count"),
            F.max("o_orderdate").alias("last_seen_at"),
        )
    )


def files(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Orders as files of the ordering customer's repository, with content to parse."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    if dealt:
        # Before the contents are made, so that only numbers move.
        orders = orders.repartition("o_orderkey")
    key = F.col("o_orderkey").cast("string")
    priority = F.col("o_orderpriority")
    rank = (1 + F.floor(F.col("o_totalprice") / 1000)).cast("string")
    alpha = F.dayofmonth("o_orderdate").cast("string")
    path = (
        F.when(priority == "1-URGENT", F.concat(F.lit("scripts/train_"), key, F.lit(".py")))
        .when(priority == "2-HIGH", F.concat(F.lit("configs/lora_"), key, F.lit(".yaml")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("configs/run_"), key, F.lit(".json")))
        .when(
            priority == "4-NOT SPECIFIED",
            F.concat(F.lit("out/"), key, F.lit("/adapter_config.json")),
        )
        .otherwise(F.concat(F.lit("env/"), key, F.lit("/requirements.txt")))
    )
    code = F.concat(
        F.lit("from peft import LoraConfig\nlog(r=1)\ncfg = LoraConfig(r="), rank,
        F.lit(", lora_alpha="), alpha, F.lit(", bias=\"none\", target_modules=[\"q\", \"v\"])\n"),
    )
    nested = F.concat(
        F.lit("peft:\n  lora_r: "), rank, F.lit("\n  alpha: "), alpha,
        F.lit("\noptimizer:\n  type: AdamW\n  params:\n    lr: 0.0002\nscheduler: scheduler\n"),
    )
    flat = F.concat(
        F.lit('{"r": '), rank, F.lit(', "lora_alpha": '), alpha,
        F.lit(', "bf16": true, "optim": "AdamW (fused)", "lr": "auto", "seed": 7}'),
    )
    deep = F.concat(F.lit('{"peft": {"rank": '), rank, F.lit(', "alpha": '), alpha, F.lit("}}"))
    content = (
        F.when(priority == "1-URGENT", code)
        .when(priority == "2-HIGH", nested)
        .when(priority == "3-MEDIUM", deep)
        .when(priority == "4-NOT SPECIFIED", flat)
        .otherwise(F.lit("peft==0.10\n"))
    )
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("o_orderkey").alias("file_id"),
            full_name("n_name", "c_name").alias("repo_full_name"),
            path.alias("file_path"),
            content.alias("content"),
            F.col("o_totalprice").cast("bigint").alias("file_size"),
            F.col("o_orderdate").alias("fetched_at"),
        )
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw parameter rows of their order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("entity"),
        F.col("l_linestatus").alias("param_name"),
        F.col("l_partkey").cast("string").alias("param_value"),
        F.col("l_returnflag").alias("source"),
        (1 - F.col("l_discount")).alias("confidence"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_extendedprice",
    )
