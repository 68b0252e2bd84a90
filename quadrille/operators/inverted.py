"""Vector search over inverted lists: points filed under cells, questions probe a few of them.

Cells are the centres of a spherical k-means over a bounded sample of points; every point is filed
under its nearest centre. A question probes the cells whose centres are nearest to it, and is
compared there exactly. Points and questions stay tables: both are cut into blocks by (cell, part),
where a cell has as many parts as it has blocks of points, so a cell that holds a third of all points is
many tasks' work; a task compares one block of points with a tile of questions, block by block, and gives
out the k best of each question only. With a single cell the search is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.operators.vectors import MATRIX_BYTES, _cut, _Nearest, _stack, _unit
from quadrille.session import cut_lineage

# The k-means is fitted on at most so many points, which bounds what the driver reads and computes.
SAMPLE_POINTS = 20_000
ROUNDS = 8
# Points and questions of one block.
BLOCK_POINTS, BLOCK_QUESTIONS = 8_192, 1_024
# Questions that a block of points meets at a time, block by block; a cell falls into so many such
# tiles at least, if it has as many blocks; tasks for all tiles.
TILE_QUESTIONS, CELL_TILES, TILE_TASKS = 16_384, 32, 4_000
# Cells that a question probes.
PROBES = 8


def fit_cells(points: DataFrame, cells: int, sample: int = SAMPLE_POINTS) -> np.ndarray:
    """Unit centres of at most ``cells`` cells, from the ``sample`` different vectors with the lowest hashes."""
    told = points.filter(F.col("vector").isNotNull()).select("vector").dropDuplicates(["vector"])
    drawn = told.orderBy(F.xxhash64("vector"), "vector").limit(sample).collect()  # at most ``sample`` rows
    if not drawn:
        return np.zeros((1, 1))
    unit = _unit(np.array([r["vector"] for r in drawn], dtype=np.float64))
    # Each centre starts at the point that is farthest from those chosen before.
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(cells, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    centres = unit[chosen]
    for _ in range(ROUNDS):
        owner = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, unit)
        filled = np.abs(sums).sum(axis=1) > 0
        centres = np.where(filled[:, None], _unit(sums), centres)
    return centres


def _nearest_cells(df: DataFrame, key: str, centres: np.ndarray, n: int) -> DataFrame:
    """(key, vector, cell): every row with its ``n`` nearest cells; NULL vectors have none."""
    n = min(n, len(centres))
    # Vectors of floats travel as such: half the bytes, and the same numbers when they are compared.
    kind = df.schema["vector"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = df.filter(F.col("vector").isNotNull()).select(key, F.col("vector").cast(kind).alias("vector"))
    if len(centres) == 1:
        return rows.withColumn("cell", F.lit(0))
    shared = df.sparkSession.sparkContext.broadcast(centres)  # cells times the width of a vector
    step = max(1, MATRIX_BYTES // (8 * len(centres)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.iloc[start : start + step]
                scores = _unit(_stack(part["vector"])) @ shared.value.T
                best = np.argsort(-scores, axis=1, kind="stable")[:, :n]
                out = part.loc[part.index.repeat(n)].copy()
                out["cell"] = best.ravel().astype(np.int32)
                yield out

    return rows.mapInPandas(place, f"{key} {df.schema[key].dataType.simpleString()}, vector {kind}, cell int")


def file_points(points: DataFrame, centres: np.ndarray, block: int = BLOCK_POINTS) -> DataFrame:
    """The index: (cell, part, parts, id, vector) of every point with a vector, written once."""
    filed = cut_lineage(_nearest_cells(points.select("id", "vector"), "id", centres, 1))
    # One row per cell, of which there are as many as centres.
    sizes = filed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id", "vector", F.spark_partition_id()), F.col("parts")).cast("int")
    return cut_lineage(filed.join(F.broadcast(sizes), "cell").select("cell", part.alias("part"), "parts", "id", "vector"))


def search_index(
    index: DataFrame, centres: np.ndarray, questions: DataFrame, k: int, probes: int = PROBES,
    question_block: int = BLOCK_QUESTIONS, matrix_bytes: int = MATRIX_BYTES, tile: int = TILE_QUESTIONS,
) -> DataFrame:
    """(question, id, score, rank): the k best points of the cells that each question probes.

    ``questions`` is (question, vector). Both sides meet by (cell, part, tile of questions); a point
    travels once per ``tile`` of questions that probe its cell, a question once per part of a cell. A
    task compares ``question_block`` questions at a time.
    """
    types = {"question": questions.schema["question"].dataType.simpleString(), "id": index.schema["id"].dataType.simpleString()}
    asked = cut_lineage(_nearest_cells(questions.select("question", "vector"), "question", centres, probes))
    counts = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("asked"))
    parts = index.groupBy("cell").agg(F.max("parts").alias("parts"))
    even = F.least(F.ceil(F.col("asked") / question_block), F.ceil(F.lit(CELL_TILES) / F.col("parts")))
    tiles = F.greatest(F.ceil(F.col("asked") / tile), even).cast("int")
    # One row per cell, of which there are as many as centres.
    sizes = cut_lineage(counts.join(parts, "cell").select("cell", "parts", tiles.alias("tiles")))
    met = sizes.agg(F.sum(F.col("tiles").cast("bigint") * F.col("parts"))).first()[0] or 0
    # A number of its own, as rows this few would be put into a handful of tasks.
    tasks = int(min(max(2 * met, 1), TILE_TASKS))
    own = F.pmod(F.xxhash64("question", "vector"), F.col("tiles")).cast("int").alias("tile")
    each_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    each_tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")
    keys = ["cell", "tile", "part"]
    left = asked.join(F.broadcast(sizes), "cell").select("cell", own, each_part, "question", "vector")
    right = index.drop("parts").join(F.broadcast(sizes), "cell").select("cell", each_tile, "part", "id", "vector")
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)

    def compare(questions: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"question": [], "id": [], "score": []})]
        ids, unit = points["id"].to_numpy(), _unit(_stack(points["vector"])) if len(points) else None
        for start in range(0, len(questions) if len(points) else 0, question_block):
            block = questions.iloc[start : start + question_block]
            nearest = _Nearest(_stack(block["vector"]), k, matrix_bytes)
            nearest.read(ids, unit)
            row, hit, score = nearest.hits()
            found.append(pd.DataFrame({"question": block["question"].to_numpy()[row], "id": hit, "score": score}))
        return pd.concat(found[1:] or found)

    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        compare, f"question {types['question']}, id {types['id']}, score DOUBLE"
    )
    return _cut(hits, k)


def search_exact(points: DataFrame, questions: DataFrame, k: int, **how) -> DataFrame:
    """The same over all points: one cell."""
    centre = np.zeros((1, 1))
    return search_index(file_points(points, centre), centre, questions, k, probes=1, **how)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(questions, recall): the share of the exact hits that ``found`` has."""
    hit = found.select("question", "id", F.lit(1).alias("hit"))
    return exact.join(hit, ["question", "id"], "left").agg(
        F.countDistinct("question").alias("questions"), (F.count("hit") / F.count(F.lit(1))).alias("recall")
    )
