"""Exact vector search and the question context built from its hits."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.functions.text import render_param, scrub, sql_round, stable_uuid
from quadrille.session import cut_lineage

COLLECTIONS = ("repos", "models")
TEXT_CAP = 2000
CARD_CAP = 1500
PRACTICE_LINES = 8
# Questions that travel with the tasks at a time.
SHIPPED_QUESTIONS = 2_000
# Bytes of the scores that a task computes at a time.
MATRIX_BYTES = 64 << 20
# Scores are compared with so many digits: sums in another order agree to that.
SCORE_DIGITS = 12


# --- collections -------------------------------------------------------------------


def repo_points(enriched: DataFrame, vectors: DataFrame) -> DataFrame:
    """Collection of usable repositories: id, vector and payload."""
    topics = F.coalesce(F.from_json("topics", "array<string>"), F.array().cast("array<string>"))
    payload = F.struct(
        "repo_id", "repo_name", "primary_language", topics.alias("topics"),
        F.substring("readme_content", 1, TEXT_CAP).alias("readme_content"),
        F.date_format("enriched_at", "yyyy-MM-dd'T'HH:mm:ss").alias("enriched_at"),
    )
    usable = enriched.filter("readme_content IS NOT NULL AND enrichment_status = 'ok'")
    return usable.join(vectors, "repo_id").select(
        F.col("repo_id").cast("string").alias("id"), "vector", payload.alias("payload")
    )


def model_points(models: DataFrame, vectors: DataFrame) -> DataFrame:
    """Collection of relevant models; the id is a stable UUID of the model id."""
    payload = F.struct(
        "model_id", "base_model", "pipeline_tag", "library_name", "downloads", "likes",
        F.substring("card_content", 1, TEXT_CAP).alias("card_content"),
    )
    usable = models.filter("card_content IS NOT NULL AND is_lora_relevant")
    return usable.join(vectors, "model_id").select(
        stable_uuid(F.col("model_id")).alias("id"), "vector", payload.alias("payload")
    )


# --- search ------------------------------------------------------------------------


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


class _Nearest:
    """The k best points so far of every question, read slice by slice."""

    def __init__(self, questions: np.ndarray, k: int, matrix_bytes: int) -> None:
        self.unit, self.k = _unit(questions), k
        self.slice = max(1, matrix_bytes // (8 * len(questions)))
        # What is below the k-th best score by more than rounding can make up is not looked at.
        self.floor = np.full(len(questions), -np.inf)
        self.parts: list[tuple] = []
        self.pending = 0

    def read(self, ids: np.ndarray, unit: np.ndarray) -> None:
        for start in range(0, len(ids), self.slice):
            part = ids[start : start + self.slice]
            scores = self.unit @ unit[start : start + self.slice].T
            if len(part) > self.k and np.isneginf(self.floor).any():
                known = np.where(np.isnan(scores), -np.inf, scores)
                kth = np.partition(known, -self.k, axis=1)[:, -self.k]
                self.floor = np.maximum(self.floor, kth - 10.0**-SCORE_DIGITS)
            row, at = np.divmod(np.flatnonzero(scores >= self.floor[:, None]), len(part))
            self.parts.append((row, -np.round(scores[row, at], SCORE_DIGITS), part[at]))
            self.pending += len(row)
            if self.pending > 2 * self.k * len(self.floor):
                self._settle()

    def _settle(self) -> None:
        row, score, ids = (np.concatenate(column) for column in zip(*self.parts))
        order = np.lexsort((pd.factorize(ids, sort=True)[0], score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last, kept = place == self.k - 1, place < self.k
        self.floor[row[last]] = np.maximum(self.floor[row[last]], -score[last] - 10.0**-SCORE_DIGITS)
        self.parts, self.pending = [(row[kept], score[kept], ids[kept])], 0

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the question, id and score of each."""
        if not self.parts:
            return np.zeros(0, int), np.zeros(0, object), np.zeros(0)
        self._settle()
        row, score, ids = self.parts[0]
        return row, ids, -score


def _cut(hits: DataFrame, k: int) -> DataFrame:
    """The k best by the whole score; it is rounded for display only."""
    order = Window.partitionBy("question").orderBy(F.col("score").desc(), "id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.withColumn("score", sql_round(F.col("score"), 4))


def search_many(
    points: DataFrame,
    questions: DataFrame,
    k: int,
    shipped: int = SHIPPED_QUESTIONS,
    matrix_bytes: int = MATRIX_BYTES,
) -> DataFrame:
    """The k most similar points of every question: (question, id, score, rank).

    ``points`` is (id, vector), ``questions`` (question, vector). Similarity is the cosine; ties of
    the whole score go to the lower id, and it is shown with four digits. Up to ``shipped`` questions
    travel to the tasks, which read the points once; more stay a table and meet the points block by
    block (:func:`quadrille.operators.inverted.search_exact`). A task holds a matrix of at most
    ``matrix_bytes`` and the k best of every question, and gives out only those.
    """
    id_type = points.schema["id"].dataType.simpleString()
    question_type = questions.schema["question"].dataType.simpleString()
    schema = f"question {question_type}, id {id_type}, score DOUBLE"
    points = points.select("id", "vector")
    rows = questions.select("question", "vector").limit(shipped + 1).collect()
    if not rows:
        return _cut(points.sparkSession.createDataFrame([], schema), k)
    if len(rows) > shipped:
        from quadrille.operators.inverted import search_exact

        return search_exact(points, questions, k, question_block=shipped, matrix_bytes=matrix_bytes)
    return _cut(points.mapInPandas(_scan(rows, k, matrix_bytes), schema), k)


def _scan(rows: list, k: int, matrix_bytes: int):
    asked = np.empty(len(rows), dtype=object)
    asked[:] = [r["question"] for r in rows]
    matrix = np.array([r["vector"] for r in rows], dtype=np.float64)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nearest = _Nearest(matrix, k, matrix_bytes)
        for batch in batches:
            if len(batch):
                nearest.read(batch["id"].to_numpy(), _unit(_stack(batch["vector"])))
        row, ids, scores = nearest.hits()
        if len(row):
            yield pd.DataFrame({"question": asked[row], "id": ids, "score": scores})

    return scan


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns in double arithmetic; 0 for a zero vector."""
    wide = lambda c: c.cast("array<double>")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    dot = total(F.zip_with(wide(a), wide(b), lambda x, y: x * y))
    norms = F.sqrt(total(F.transform(wide(a), lambda x: x * x))) * F.sqrt(
        total(F.transform(wide(b), lambda x: x * x))
    )
    return F.coalesce(F.try_divide(dot, norms), F.lit(0.0))


def search(
    collections: Mapping[str, DataFrame], vector: Sequence[float], kind: str, k: int
) -> DataFrame:
    """(kind, score, id, payload) of the k points of one collection nearest to a vector."""
    if kind not in collections:
        raise ValueError(f"unknown kind {kind!r}; options: {sorted(collections)}")
    points = collections[kind]
    asked = F.array(*[F.lit(float(x)) for x in vector])
    return (
        points.select(
            F.lit("repo" if kind == "repos" else "model").alias("kind"),
            F.round(cosine(F.col("vector"), asked), SCORE_DIGITS).alias("score"),
            "id",
            *[c for c in points.columns if c not in ("id", "vector")],
        )
        .orderBy(F.col("score").desc(), "id")
        .limit(k)
        .withColumn("score", sql_round(F.col("score"), 4))
    )


def search_all(
    collections: Mapping[str, DataFrame],
    vector: Sequence[float],
    k: int,
    kind: str = "all",
    limit: int | None = None,
) -> DataFrame:
    """k hits per collection, best first overall; ``limit`` cuts the merged list."""
    kinds = list(collections) if kind == "all" else [kind]
    hits = search(collections, vector, kinds[0], k)
    for more in kinds[1:]:
        hits = hits.unionByName(search(collections, vector, more, k), allowMissingColumns=True)
    ordered = hits.orderBy(F.col("score").desc(), "kind", "id")
    return ordered.limit(limit) if limit else ordered


# --- question context --------------------------------------------------------------


def recipe_text(params: DataFrame) -> Column:
    """'optimizer=adamw, rank=64, lr=0.0002' from the parameters that are set."""
    parts = []
    for name, label in vocab.RECIPE_LABELS.items():
        if name in params.columns:
            shown = scrub(render_param(name, F.col(name)), 60)
            parts.append(
                F.when(F.col(name).isNotNull(), F.concat(F.lit(f"{label}="), shown))
            )
    return F.concat_ws(", ", *parts)


def with_recipes(hits: DataFrame, recipes: DataFrame) -> DataFrame:
    """Attach recipes (source_id, recipe) to hits by ``source_id``.

    Hits are few per question; their keys pick the recipes before the join.
    """
    needed = recipes.join(hits.select("source_id").distinct(), "source_id", "left_semi")
    return hits.join(needed, "source_id", "left")


def best_practices(stats: DataFrame, limit: int = PRACTICE_LINES) -> DataFrame:
    """Rare values that work and have enough models behind them, best first."""
    return (
        stats.filter("quadrant = 'rare+works' AND sample_ok")
        .orderBy(F.col("avg_success_score").desc(), "param_name", "param_value")
        .limit(limit)
    )


def practice_lines(practices: DataFrame) -> DataFrame:
    """The practices (a short list) as one text."""
    line = F.concat(
        F.lit("- "), scrub(F.col("param_name")), F.lit("="), scrub(F.col("param_value")),
        F.lit(" — avg success "), F.col("avg_success_score").cast("string"),
        F.lit(" across "), F.col("prevalence").cast("string"), F.lit(" models"),
    )
    rows = F.sort_array(
        F.collect_list(
            F.struct(
                (-F.col("avg_success_score")).alias("s"), "param_name", "param_value",
                line.alias("line"),
            )
        )
    )
    head = F.lit("validated practice statistics (rare-but-works, sample_ok):")
    return practices.agg(
        F.array_join(
            F.concat(F.array(head), F.transform(rows, lambda r: r["line"])), "\n"
        ).alias("practices")
    )


def hit_lines(kind: Column, payload: Mapping[str, Column], recipe: Column) -> Column:
    """The context lines of one hit."""
    get = lambda name, cap=200: scrub(payload.get(name, F.lit(None)), cap)
    head = F.when(
        kind == "repo",
        F.concat(
            F.lit("- [repo] "), get("repo_name"), F.lit(" (language="),
            get("primary_language"), F.lit(", topics="), get("topics"), F.lit(")"),
        ),
    ).otherwise(
        F.concat(
            F.lit("- [model] "), get("model_id"), F.lit(" (base_model="), get("base_model"),
            F.lit(", task="), get("pipeline_tag"), F.lit(", downloads="), get("downloads"),
            F.lit(", likes="), get("likes"), F.lit(")"),
        )
    )
    body = F.when(kind == "repo", get("readme_content", CARD_CAP)).otherwise(
        get("card_content", CARD_CAP)
    )
    label = F.when(kind == "repo", F.lit("  readme: ")).otherwise(F.lit("  card: "))
    return F.concat_ws(
        "\n",
        head,
        F.when(body != "", F.concat(label, body)),
        F.when(recipe != "", F.concat(F.lit("  extracted recipe: "), recipe)),
    )


def context_blocks(lines: DataFrame, questions: DataFrame) -> DataFrame:
    """One text per question from its ranked hit lines (question, rank, line).

    A question has at most 2k hits, so the collected list is short.
    """
    ordered = F.sort_array(F.collect_list(F.struct("rank", "line")))
    joined = lines.groupBy("question").agg(
        F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("context")
    )
    nothing = F.lit("(no matching repositories or models were found)")
    return questions.select("question").join(joined, "question", "left").withColumn(
        "context", F.coalesce("context", nothing)
    )


def user_message(context: Column, practices: Column, question: Column) -> Column:
    """The delimited context followed by the question."""
    return F.concat(
        F.lit("Context — top matching LoRA repositories and models from the corpus:\n"),
        F.lit("<retrieved_context>\n"),
        F.concat_ws("\n\n", F.nullif(practices, F.lit("")), context),
        F.lit("\n</retrieved_context>\n\nQuestion: "),
        question,
    )


def shown_list(c: Column) -> Column:
    """A list of texts as the context shows it: ['lora', 'peft']."""
    quoted = F.transform(c, lambda x: F.when(
        F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"')), F.concat(F.lit('"'), x, F.lit('"'))
    ).otherwise(F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'"))))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def context(
    collections: Mapping[str, DataFrame],
    questions: DataFrame,
    params: Mapping[str, DataFrame],
    stats: DataFrame | None,
    k: int,
    practice_limit: int = PRACTICE_LINES,
) -> DataFrame:
    """(question, message): every question with its hits in all collections, recipes and practices.

    ``collections`` holds points by kind (``repo_points``, ``model_points``), ``questions``
    (question, vector, text), ``params`` the parameter tables by kind, keyed by ``repo_full_name``
    or ``model_id``. There are at most k hits per question and collection, and ``practice_limit``
    practices in all; what is joined to them is picked by their keys first.
    """
    lines = None
    for kind, points in collections.items():
        single = "repo" if kind == "repos" else "model"
        name, key = ("repo_name", "repo_full_name") if single == "repo" else ("model_id", "model_id")
        hits = search_many(points, questions, k)
        known = points.select("id", "payload").join(hits.select("id").distinct(), "id", "left_semi")
        found = hits.join(known, "id").withColumn("source_id", F.col(f"payload.{name}"))
        if kind in params:
            table = params[kind]
            found = with_recipes(found, table.select(F.col(key).alias("source_id"), recipe_text(table).alias("recipe")))
        else:
            found = found.withColumn("recipe", F.lit(None).cast("string"))
        payload = {f: F.col(f"payload.{f}") for f in points.schema["payload"].dataType.names}
        if "topics" in payload:
            payload["topics"] = shown_list(payload["topics"])
        # Best first over all collections, then by kind and id.
        place = F.struct((-F.col("score")).alias("s"), F.lit(single).alias("kind"), F.col("id").cast("string").alias("i"))
        part = found.select("question", place.alias("rank"), hit_lines(F.lit(single), payload, F.col("recipe")).alias("line"))
        lines = part if lines is None else lines.unionByName(part)
    practices = None
    if stats is not None:
        best = cut_lineage(best_practices(stats, practice_limit))
        practices = None if best.isEmpty() else practice_lines(best).first()[0]
    blocks = context_blocks(lines, questions).join(questions.select("question", "text"), "question")
    message = user_message(F.col("context"), F.lit(practices).cast("string"), F.col("text"))
    return blocks.select("question", message.alias("message"))
