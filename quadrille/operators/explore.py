"""The explorer's queries: filter, sort, page, drill down."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.functions.text import asked_value, contains_text, exact_round, render_param
from quadrille.operators.skew import skew_join

INSIGHT_SORTS = ("avg_success_score", "prevalence", "score_lift")
MODEL_SORTS = ("composite_success_score", "downloads", "likes", "fine_tune_fan_out")
REPO_SORTS = ("star_count", "extraction_confidence")
PAGE_LIMIT = 200
EVIDENCE_LIMIT = 50

REPO_FIELDS = (
    "repo_id", "repo_name", "description", "primary_language", "topics", "license",
    "homepage", "star_count", "forks_count", "open_issues_count", "contributors_count",
    "commit_count_30d", "has_tests", "has_ci", "is_fork", "is_archived", "readme_length",
    "repo_created_at", "pushed_at", "enriched_at", "is_enriched",
)


class Page(NamedTuple):
    """One page of rows and everything that matched."""

    items: DataFrame
    matching: DataFrame
    limit: int
    offset: int

    def total(self) -> DataFrame:
        return self.matching.agg(F.count(F.lit(1)).alias("total"))


def _one_of(name: str, value: str, allowed) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {sorted(allowed)}")
    return value


def _known_param(name: str) -> str:
    if name not in vocab.PARAMS:
        raise ValueError(f"unknown parameter {name!r}")
    return name


def _within(name: str, value: int, low: int, high: int | None = None) -> int:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} is out of range")
    return value


def _sorted_by(column: Column, order: str) -> Column:
    _one_of("order", order, ("asc", "desc"))
    return column.asc_nulls_last() if order == "asc" else column.desc_nulls_last()


def _page(
    df: DataFrame, by: Column, order: str, key: list[str], limit: int, offset: int
) -> Page:
    _within("limit", limit, 1, PAGE_LIMIT)
    _within("offset", offset, 0)
    items = df.orderBy(_sorted_by(by, order), *key).offset(offset).limit(limit)
    return Page(items, df, limit, offset)


def _after(key: Sequence[str], last: Sequence) -> Column:
    """Whether a row comes after one with the values ``last`` of ``key``, column by column."""
    later, equal = F.lit(False), F.lit(True)
    for name, value in zip(key, last, strict=True):
        later = later | (equal & (F.col(name) > F.lit(value)))
        equal = equal & (F.col(name) == F.lit(value))
    return later


def page_after(
    df: DataFrame, by: str, order: str, key: Sequence[str], last: Sequence | None, limit: int
) -> DataFrame:
    """The rows that follow ``last`` = (value of ``by``, values of ``key``) in the page order; the first
    page without it.

    The condition is a filter, so what came before is neither sorted nor carried, and on a table laid
    out by ``by`` it is not even read. NULLs come last: a value is followed by them, too, and among
    them the key alone decides. ``key`` must be unique and not NULL.
    """
    _within("limit", limit, 1, PAGE_LIMIT)
    ordered = _sorted_by(F.col(by), order)
    if last is not None:
        value, rest = last[0], _after(key, last[1:])
        column = F.col(by)
        if value is None:
            df = df.filter(column.isNull() & rest)
        else:
            beyond = column > F.lit(value) if order == "asc" else column < F.lit(value)
            df = df.filter(beyond | column.isNull() | ((column == F.lit(value)) & rest))
    return df.orderBy(ordered, *key).limit(limit)


def pages(df: DataFrame, by: str, order: str, key: Sequence[str], limit: int) -> Iterator[tuple[DataFrame, list]]:
    """Page after page as (frame, its at most ``limit`` rows), each found from the last row before it."""
    last = None
    while True:
        page = page_after(df, by, order, key, last, limit)
        rows = page.collect()
        if rows:
            yield page, rows
        if len(rows) < limit:
            return
        last = [rows[-1][by], *[rows[-1][k] for k in key]]


def _params_struct(params: DataFrame, key: str) -> DataFrame:
    fields = [c for c in (*vocab.PARAMS, *vocab.PROVENANCE) if c in params.columns]
    return params.select(key, F.struct(*fields).alias("lora_params"))


# --- summary -----------------------------------------------------------------------


def summary(
    repos: DataFrame, models: DataFrame, links: DataFrame, params: DataFrame, files: DataFrame
) -> DataFrame:
    """Corpus counts and the share of repositories with files that gave parameters."""
    count = F.count(F.lit(1))
    with_files = files.agg(F.countDistinct("repo_full_name")).scalar()
    with_params = params.agg(count).scalar()
    row = repos.agg(
        count.alias("repos_total"),
        F.count_if("is_enriched").alias("repos_enriched"),
    )
    return (
        row.select(
            "*",
            models.agg(count).scalar().alias("hf_models_total"),
            links.agg(count).scalar().alias("links_total"),
            with_params.alias("repos_with_params"),
            with_files.alias("_with_files"),
        )
        .withColumn(
            "extraction_coverage",
            F.when(F.col("_with_files") == 0, 0.0).otherwise(
                exact_round(F.try_divide("repos_with_params", "_with_files"), 3)
            ),
        )
        .drop("_with_files")
    )


# --- practice statistics -----------------------------------------------------------


def insights(
    stats: DataFrame,
    quadrant: str | None = None,
    param_name: str | None = None,
    min_prevalence: int | None = None,
    sample_ok: bool | None = None,
    sort: str = "avg_success_score",
    order: str = "desc",
    limit: int = 50,
    offset: int = 0,
) -> Page:
    _one_of("sort", sort, INSIGHT_SORTS)
    df = stats
    if quadrant:
        # A plus sign often arrives as a space.
        wanted = _one_of("quadrant", quadrant.replace(" ", "+"), vocab.QUADRANTS)
        df = df.filter(F.col("quadrant") == wanted)
    if param_name:
        df = df.filter(F.col("param_name") == param_name)
    if min_prevalence is not None:
        df = df.filter(F.col("prevalence") >= min_prevalence)
    if sample_ok is not None:
        df = df.filter(F.col("sample_ok") == sample_ok)
    return _page(df, F.col(sort), order, ["param_name", "param_value"], limit, offset)


def value_matches(name: str, asked: str) -> Column:
    """A parameter column shows the value a user asked for."""
    return render_param(name, F.col(name)) == asked_value(name, F.lit(asked))


def insight_models(
    params: DataFrame, outcomes: DataFrame, param_name: str, value: str, limit: int = 10
) -> DataFrame:
    """The best-scored models that use a parameter value."""
    _known_param(param_name)
    _within("limit", limit, 1, EVIDENCE_LIMIT)
    using = params.filter(value_matches(param_name, value)).select("model_id")
    return (
        outcomes.select(
            "model_id", "base_model", "pipeline_tag", "library_name", "downloads", "likes",
            "fine_tune_fan_out", "composite_success_score",
        )
        .join(using, "model_id")
        .orderBy(F.col("composite_success_score").desc_nulls_last(), "model_id")
        .limit(limit)
    )


# --- models ------------------------------------------------------------------------


def _attach(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of one page to a table of any size, without moving the table.

    The page's keys (at most PAGE_LIMIT) are broadcast to pick the table's few rows.
    """
    needed = table.join(F.broadcast(rows.select(key)), key, "left_semi")
    return rows.join(needed, key, "left")


def _with_model_context(rows: DataFrame, models: DataFrame, params: DataFrame) -> DataFrame:
    facts = [c for c in ("tags", "tag_count", "created_at", "last_modified") if c in models.columns]
    with_facts = _attach(rows, models.select("model_id", *facts), "model_id")
    return _attach(with_facts, _params_struct(params, "model_id"), "model_id")


def models_page(
    outcomes: DataFrame,
    models: DataFrame,
    params: DataFrame,
    base_model: str | None = None,
    pipeline_tag: str | None = None,
    library_name: str | None = None,
    min_downloads: int | None = None,
    sort: str = "composite_success_score",
    order: str = "desc",
    limit: int = 50,
    offset: int = 0,
) -> Page:
    """Scored models; only the page's rows are joined to their context."""
    _one_of("sort", sort, MODEL_SORTS)
    df = outcomes
    for name, value in (
        ("base_model", base_model), ("pipeline_tag", pipeline_tag), ("library_name", library_name),
    ):
        if value:
            df = df.filter(F.col(name) == value)
    if min_downloads is not None:
        df = df.filter(F.col("downloads") >= min_downloads)
    page = _page(df, F.col(sort), order, ["model_id"], limit, offset)
    items = _with_model_context(page.items, models, params)
    return page._replace(items=items.orderBy(_sorted_by(F.col(sort), order), "model_id"))


def model_detail(
    outcomes: DataFrame, models: DataFrame, params: DataFrame, edges: DataFrame, model: str,
    children: int | None = None,
) -> DataFrame:
    """One model with parameters and children ([] without any), in one row.

    ``edges`` has a row per (base_model, model_id); ``children`` keeps the first so many by id.
    """
    row = outcomes.filter(F.col("model_id") == model)
    if row.isEmpty():
        raise KeyError(model)
    own = edges.filter(F.col("base_model") == model).select("model_id")
    shown = own if children is None else own.orderBy("model_id").limit(children)
    listed = shown.agg(F.sort_array(F.collect_list("model_id")).alias("fine_tune_models")).select(
        F.lit(model).alias("model_id"), "fine_tune_models"
    )
    return (
        _with_model_context(row, models, params)
        .join(listed, "model_id", "left")
        .withColumn(
            "fine_tune_models", F.coalesce("fine_tune_models", F.array().cast("array<string>"))
        )
    )


# --- repositories ------------------------------------------------------------------


def repos_page(
    repos: DataFrame,
    params: DataFrame,
    param: str | None = None,
    value: str | None = None,
    language: str | None = None,
    has_tests: bool | None = None,
    q: str | None = None,
    sort: str = "star_count",
    order: str = "desc",
    limit: int = 50,
    offset: int = 0,
) -> Page:
    """Repositories, optionally only those whose parameter shows a value."""
    _one_of("sort", sort, REPO_SORTS)
    if bool(param) != bool(value):
        raise ValueError("param and value must be passed together")
    df = repos.select(*[c for c in REPO_FIELDS if c in repos.columns])
    if param:
        using = params.filter(value_matches(_known_param(param), value))
        df = df.join(
            using.select(F.col("repo_full_name").alias("repo_name")), "repo_name", "left_semi"
        )
    if language:
        df = df.filter(F.col("primary_language") == language)
    if has_tests is not None:
        df = df.filter(F.col("has_tests") == has_tests)
    if q:
        df = df.filter(contains_text(q, F.col("repo_name"), F.col("description")))
    by = F.col("star_count")
    if sort == "extraction_confidence":
        rated = params.select(
            F.col("repo_full_name").alias("repo_name"),
            F.col("extraction_confidence").alias("_confidence"),
        )
        df, by = df.join(rated, "repo_name", "left"), F.col("_confidence")
    page = _page(df, by, order, ["repo_name"], limit, offset)
    structs = _params_struct(params, "repo_full_name").withColumnRenamed(
        "repo_full_name", "repo_name"
    )
    items = _attach(page.items, structs, "repo_name")
    return page._replace(
        items=items.orderBy(_sorted_by(by, order), "repo_name").drop("_confidence"),
        matching=df.drop("_confidence"),
    )


def linked_models(repos: DataFrame, links: DataFrame) -> DataFrame:
    """(repo_name, model_id, best_confidence) of every repository, best first per page."""
    ends = links.select(
        F.col("repo_full_name").alias("repo_name"), "model_id", "best_confidence"
    )
    return skew_join(ends, repos.select("repo_name"), ["repo_name"], "left_semi")


def repo_detail(
    repos: DataFrame, params: DataFrame, links: DataFrame, name: str
) -> tuple[DataFrame, DataFrame]:
    """One repository with its parameters, and its linked models by confidence.

    The links stay rows: a repository may be linked to a large share of all models.
    """
    row = repos.filter(F.col("repo_name") == name)
    if row.isEmpty():
        raise KeyError(name)
    structs = _params_struct(params, "repo_full_name").withColumnRenamed(
        "repo_full_name", "repo_name"
    )
    detail = row.select(*[c for c in REPO_FIELDS if c in repos.columns]).join(
        structs, "repo_name", "left"
    )
    linked = (
        links.filter(F.col("repo_full_name") == name)
        .select("model_id", "best_confidence")
        .orderBy(F.col("best_confidence").desc(), "model_id")
    )
    return detail, linked
