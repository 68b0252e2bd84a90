"""Raw parameter rows to one typed row per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.functions.text import exact_round, folded, let, number_of, strip


def priority_of(source: Column) -> Column:
    ranked = F.lit(0)
    for name, priority in vocab.SOURCE_PRIORITY.items():
        if priority:
            ranked = F.when(source == name, priority).otherwise(ranked)
    return ranked


def merge_params(
    rows: DataFrame,
    entity: Sequence[str],
    order: Sequence[Column],
    names: Sequence[str] = vocab.PARAMS,
    priority: Column | None = None,
) -> DataFrame:
    """Best row per (entity, parameter) as one wide row of texts with provenance.

    The highest source priority wins, then the highest confidence, then the first in
    ``order``. Empty values never win, but an entity with only empty values keeps a row.
    Both groupings are combined in the map tasks: an entity with a third of the rows
    leaves each of them as one candidate per parameter.
    """
    entity = list(entity)
    ranked = priority if priority is not None else priority_of(F.col("source"))
    # Smallest wins, so priority and confidence are negated and ``order`` is not.
    place = F.struct(
        (-ranked).alias("p"),
        (-F.col("confidence").cast("double")).alias("c"),
        *[c.alias(f"o{i}") for i, c in enumerate(order)],
    )
    picked = F.struct(
        F.col("param_value").alias("value"),
        F.col("source"),
        F.col("confidence").cast("double").alias("confidence"),
    )
    usable = (F.col("param_value") != "") & F.col("param_name").isin(*names)
    best = rows.groupBy(*entity, "param_name").agg(
        F.min_by(picked, F.when(usable, place)).alias("_pick")
    )
    # At most one entry per known parameter is listed.
    entry = F.when(F.col("_pick").isNotNull(), F.struct("param_name", "_pick"))
    wide = best.groupBy(*entity).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_all")
    ).select(*entity, *[F.try_element_at("_all", F.lit(n)).alias(n) for n in names])
    found = F.filter(
        F.array(*[
            F.struct(F.lit(n).alias("name"), F.col(f"{n}.source").alias("source"),
                     F.col(f"{n}.confidence").alias("confidence"))
            for n in names
        ]),
        lambda x: x["source"].isNotNull(),
    )
    counted = wide.withColumn("_found", found)
    total = F.size("_found")
    mean = F.aggregate("_found", F.lit(0.0), lambda a, x: a + x["confidence"]) / total
    return counted.select(
        *entity,
        *[F.col(f"{n}.value").alias(n) for n in names],
        F.map_from_entries(
            F.transform("_found", lambda x: F.struct(x["name"], x["source"]))
        ).alias("param_sources"),
        total.alias("total_params_extracted"),
        F.when(total > 0, exact_round(mean, 2)).otherwise(F.lit(0.0)).alias(
            "extraction_confidence"
        ),
    )


# --- typed values ------------------------------------------------------------------


def _whole(name: str, text: Column) -> Column:
    low, high = vocab.INT_BOUNDS[name]

    def bounded(number: Column) -> Column:
        # Far outside the bounds is out anyway; the cast must not overflow.
        cut = F.when(F.abs(number) < 1e9, number).cast("int")
        inside = cut.between(low, high)
        return F.when(inside & (cut != 0) if name == "rank_value" else inside, cut)

    return let(number_of(text), bounded)


def _real(name: str, text: Column) -> Column:
    low, high = vocab.FLOAT_BOUNDS[name]
    return let(number_of(text), lambda number: F.when(number.between(low, high), number))


def _truth(text: Column) -> Column:
    """Truth of a word, or of the ``enabled`` entry of an object ('auto' gives NULL)."""

    def enabled(bare: Column) -> Column:
        # Python-style literals become JSON first.
        as_json = F.replace(bare, F.lit("'"), F.lit('"'))
        for literal, word in (("True", "true"), ("False", "false"), ("None", "null")):
            as_json = F.regexp_replace(as_json, rf"\b{literal}\b", word)
        parsed = F.try_parse_json(F.when(bare.contains("'"), as_json).otherwise(bare))
        return folded(F.try_variant_get(parsed, "$.enabled", "string"))

    switched = lambda word: F.when(word != "auto", word.isin(*vocab.TRUE_WORDS))
    return let(
        strip(text),
        lambda bare: F.when(bare.startswith("{"), let(enabled(bare), switched)).otherwise(
            F.lower(bare).isin(*vocab.TRUE_WORDS)
        ),
    )


def json_string(text: Column) -> Column:
    """A text as a quoted JSON string."""
    return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")


def _modules(text: Column) -> Column:
    """A JSON list: parsed when it is JSON (a scalar is wrapped), else split at commas."""

    def items(parsed: Column) -> Column:
        listed = F.try_variant_get(parsed, "$", "array<variant>")
        pieces = F.filter(F.transform(F.split(text, ","), strip), lambda s: s != "")
        return (
            F.when(listed.isNotNull(), F.transform(listed, lambda v: F.to_json(v)))
            .when(parsed.isNotNull(), F.array(F.to_json(parsed)))
            .otherwise(F.transform(pieces, json_string))
        )

    # Most lists of names are no JSON at all: do not even try.
    like_json = text.rlike(r'^\s*(?:[\[{"]|-?\d|true\b|false\b|null\b)')
    joined = F.array_join(let(F.try_parse_json(F.when(like_json, text)), items), ", ")
    return F.concat(F.lit("["), joined, F.lit("]"))


def typed_param(name: str, text: Column) -> Column:
    """The typed value of one parameter; junk and out-of-range values give NULL."""
    if name in vocab.INT_PARAMS:
        value = _whole(name, text)
    elif name in vocab.FLOAT_PARAMS:
        value = _real(name, text)
    elif name in vocab.BOOL_PARAMS:
        value = _truth(text)
    elif name == "target_modules":
        value = _modules(text)
    elif name in vocab.NAME_PARAMS:
        value = F.substring(text, 1, vocab.NAME_CHARS)
    else:
        value = text
    return F.when(text.isNotNull() & (text != ""), value)


def typed_params(wide: DataFrame, names: Sequence[str] = vocab.PARAMS) -> DataFrame:
    """Apply :func:`typed_param` to a wide frame of texts; other columns pass through."""
    return wide.select(*[
        typed_param(c, F.col(c)).alias(c) if c in names else F.col(c) for c in wide.columns
    ])


def params_table(rows: DataFrame, entity: str, order: Sequence[Column]) -> DataFrame:
    """Raw rows to the typed parameter table, provenance as JSON text."""
    typed = typed_params(merge_params(rows, [entity], order))
    return typed.withColumn("param_sources", F.to_json("param_sources")).withColumn(
        "extraction_confidence", F.col("extraction_confidence").cast("decimal(3,2)")
    )
