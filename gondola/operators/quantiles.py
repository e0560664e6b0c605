"""Exact medians and quantiles of row-level groups of any size.

Spark's `median` and `percentile` keep the distinct values of a group in one buffer. A group
here may hold a large share of the table (one item, one chain, one product), so:

0. the groups are sized; if all are small enough, `median` does the work at once;
1. else rows are counted per (group, value) with map-side combining. A repeated price becomes one
   weighted row, and a large group is spread over many tasks by its values. The counts are
   written as a table;
2. if no group has more than `BUFFER_VALUES` distinct values, `percentile` weighted by those
   counts finishes the work;
3. otherwise the counts are added up per (group, cell), a cell being a narrow value range.
   The running total over a group's cells tells which cell holds each wanted rank, and only
   the values of those cells are ranked. The number of cells depends on the numeric range and
   not on the rows: at most 16,384 per unit of log1p, some 250,000 for prices up to 5 million.

Groups bounded by a dimension (chains of a province, items of the basket) do not need this and
use the built-in `median`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gondola.operators.common import null_safe_join
from gondola.sources.shared import materialize

BUFFER_VALUES = 100_000
CELLS_PER_UNIT = 1 << 14


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (keys, value) as a written table: keys, value, filas. Rows with a null value do not
    take part; a null key is a key."""
    counts = (
        df.select(*keys, value)
        .dropna(subset=[value])
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("filas"))
    )
    return materialize(counts, "value-counts")


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group (an action)."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def exact_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    buffer_values: int = BUFFER_VALUES,
) -> DataFrame:
    """One row per group: keys, one column per entry of `probabilities` (name -> probability,
    linear interpolation between ranks) and `n`, the number of values.

    `counts` is a written table of weighted values, as from `value_counts`; it may have further
    columns. Runs one small job to size the largest group.
    """
    if largest_group(counts, keys) <= buffer_values:
        # One buffer serves all probabilities.
        wanted = F.array(*[F.lit(float(p)) for p in probabilities.values()])
        return counts.groupBy(*keys).agg(
            F.percentile(value, wanted, F.col("filas")).alias("_found"), F.sum("filas").alias("n")
        ).select(
            *keys, *[F.col("_found")[i].alias(name) for i, name in enumerate(probabilities)], "n"
        )
    return _quantiles_by_cells(counts, list(keys), value, probabilities)


def _cell(value: Column) -> Column:
    """Non-decreasing in the value, so that every cell is a range."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(float(CELLS_PER_UNIT)))


def _quantiles_by_cells(
    counts: DataFrame, keys: list[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    values = (
        counts.groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.sum("filas").alias("_c"))
        .withColumn("_cell", _cell(F.col("_v")))
    )
    group = W.partitionBy(*keys)
    running = group.orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
    cells = (
        values.groupBy(*keys, "_cell")
        .agg(F.sum("_c").alias("_here"))
        .withColumn("_before", F.sum("_here").over(running) - F.col("_here"))
        .withColumn("n", F.sum("_here").over(group))
    )
    # Zero-based ranks on both sides of the position p * (n - 1).
    position = {name: (F.col("n") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    wanted = F.lit(False)
    for at in position.values():
        wanted = wanted | (
            (F.floor(at) < F.col("_before") + F.col("_here")) & (F.ceil(at) >= F.col("_before"))
        )
    cells = cells.where(wanted).drop("_here")

    in_cell = W.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = (
        null_safe_join(values, cells, [*keys, "_cell"])
        .withColumn("_to", F.col("_before") + F.sum("_c").over(in_cell))
        .withColumn("_from", F.col("_to") - F.col("_c"))
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v")))

    picked = ranked.groupBy(*keys, "n").agg(
        *[value_at(F.floor(at)).alias(f"_low_{name}") for name, at in position.items()],
        *[value_at(F.ceil(at)).alias(f"_high_{name}") for name, at in position.items()],
    )
    return picked.select(
        *keys,
        *[
            (
                F.col(f"_low_{name}")
                + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * (at - F.floor(at))
            ).alias(name)
            for name, at in position.items()
        ],
        "n",
    )


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str = "mediana",
    sizes: DataFrame | None = None,
    buffer_values: int = BUFFER_VALUES,
) -> DataFrame:
    """keys, `name` and `n`, the number of values, of a row-level frame.

    The groups are sized first (an action; `sizes`, keys and `n`, if known already). While
    none can overfill the buffer, that leaves one aggregation; otherwise the values are counted
    and `exact_quantiles` goes on from there. To be sized, the keys and values are written, so
    that the joins behind the frame are not made again.
    """
    present = df.select(*keys, value).dropna(subset=[value])
    if sizes is None:
        present = materialize(present, "values")
    largest = largest_group(present, keys) if sizes is None else sizes.agg(F.max("n")).first()[0]
    if (largest or 0) <= buffer_values:
        return present.groupBy(*keys).agg(
            F.median(value).alias(name), F.count(F.lit(1)).alias("n")
        )
    return exact_quantiles(value_counts(present, keys, value), keys, value, {name: 0.5}, buffer_values)
