"""Comparability within a basket item: same unit, and a price near the item's reference.

This is not cleaning. A discarded price may be right and still not be comparable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gondola.config import DEFAULTS, Thresholds
from gondola.operators.common import broadcast_within, pct
from gondola.operators.quantiles import exact_quantiles, value_counts


class NothingComparable(RuntimeError):
    """No row is left to compare."""


def _unit_ok():
    return F.coalesce(F.col("unidad_base") == F.col("unidad_esperada"), F.lit(False))


def _price_ok():
    return F.coalesce(F.col("precio_unitario") > 0, F.lit(False))


def reference_prices(labelled: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """item, referencia, n: the median unit price over all dates and provinces. Rows whose
    size comes from the description are trusted; where an item has enough of them, only they
    define its reference."""
    counts = value_counts(
        labelled.where(_unit_ok() & _price_ok()).withColumn(
            "_trusted", F.coalesce(F.col("fuente_tamano") == "descripcion", F.lit(False))
        ),
        ["item", "_trusted"],
        "precio_unitario",
    )
    trusted = counts.groupBy("item").agg(F.sum(F.when(F.col("_trusted"), F.col("filas"))).alias("_n"))
    enough = F.coalesce(F.col("_n"), F.lit(0)) >= cfg.trusted_rows_min
    usable = counts.join(trusted, "item").where(F.col("_trusted") | ~enough)
    return exact_quantiles(usable, ["item"], "precio_unitario", {"referencia": 0.5})


def annotate_comparable(
    labelled: DataFrame, dim: DataFrame, cfg: Thresholds = DEFAULTS
) -> DataFrame:
    """Adds `referencia` and `motivo`: unidad, sin_precio or rango for rows that cannot be
    compared, null for the others. Rows outside the basket are dropped.

    There is one reference per item, so the basket's row count bounds the joined side."""
    labelled = labelled.where(F.col("item").isNotNull())
    reference = reference_prices(labelled, cfg).select("item", "referencia")
    ratio = F.try_divide("precio_unitario", "referencia")
    return labelled.join(broadcast_within(reference, dim.count()), "item", "left").withColumn(
        "motivo",
        F.when(~_unit_ok(), "unidad")
        .when(~_price_ok(), "sin_precio")
        .when(~ratio.between(cfg.item_ratio_min, cfg.item_ratio_max), "rango"),
    )


def comparable(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("motivo").isNull()).drop("motivo", "referencia")


def require_rows(df: DataFrame, message: str = "no comparable row is left") -> DataFrame:
    """The frame itself, or an error if it is empty (an action)."""
    if df.isEmpty():
        raise NothingComparable(message)
    return df


def lost_units(annotated: DataFrame) -> DataFrame:
    """Rows lost per item because of their unit; an unknown unit is a group of its own."""
    return (
        annotated.where(F.col("motivo") == "unidad")
        .groupBy("item", "unidad_base")
        .agg(F.count(F.lit(1)).alias("filas"))
        .orderBy(F.desc("filas"), "item", "unidad_base")
    )


def range_discards(annotated: DataFrame) -> DataFrame:
    """Rows out of range per item and size source, with their extremes and the reference."""
    return (
        annotated.where(F.col("motivo") == "rango")
        .groupBy("item", "fuente_tamano")
        .agg(
            F.count(F.lit(1)).alias("filas"),
            F.min("precio_unitario").alias("pu_min"),
            F.max("precio_unitario").alias("pu_max"),
            F.max("referencia").alias("referencia"),
        )
        .orderBy(F.desc("filas"), "item", "fuente_tamano")
    )


def funnel(clean: DataFrame, annotated: DataFrame) -> DataFrame:
    """One row: clean rows and dates, rows in the basket, comparable rows, and the shares."""
    total = clean.groupBy("fecha").agg(F.count(F.lit(1)).alias("_n")).agg(
        F.sum("_n").alias("filas_limpias"), F.count("fecha").alias("fechas")
    )
    inside = annotated.agg(
        F.count(F.lit(1)).alias("filas_canasta"),
        F.count_if(F.col("motivo").isNull()).alias("filas_comparables"),
    )
    both = total.unionByName(inside, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        "*",
        pct(F.col("filas_canasta"), F.col("filas_limpias")).alias("pct_canasta"),
        pct(F.col("filas_comparables"), F.col("filas_canasta")).alias("pct_comparables"),
    )
