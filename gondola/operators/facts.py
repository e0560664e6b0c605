"""The star schema: price facts, dispersion, basket scenarios and chain ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from gondola.config import DEFAULTS, Thresholds
from gondola.operators.common import null_safe_join
from gondola.operators.quantiles import BUFFER_VALUES, exact_quantiles, largest_group
from gondola.sources.shared import materialize

PRICE_GRAIN = ("fecha", "item", "categoria", "cadena", "provincia")


def fact_precio_item(
    precios: DataFrame, cfg: Thresholds = DEFAULTS, buffer_values: int = BUFFER_VALUES
) -> DataFrame:
    """Median unit price, observations and distinct EANs per date, item, chain and province.

    The groups are sized first (an action). If none can overfill a median's buffer, one
    aggregation does the rest. Otherwise the rows are counted per (grain, EAN, unit price)
    into a written table, which spreads a large group over many tasks, and the medians come
    from there. Rows without a unit price are not comparable and take no part; a null in the grain is a group
    like any other.
    """
    keys = list(PRICE_GRAIN)
    rows = precios.select(*keys, "ean", "precio_unitario").dropna(subset=["precio_unitario"])
    if largest_group(rows, keys) <= buffer_values:
        return (
            rows.groupBy(*keys)
            .agg(
                F.median("precio_unitario").alias("precio_mediano"),
                F.count(F.lit(1)).alias("n_observaciones"),
                F.countDistinct("ean").alias("n_eans"),
            )
            .where(F.col("n_observaciones") >= cfg.fact_rows_min)
        )
    counted = materialize(
        rows.groupBy(*keys, "ean", "precio_unitario").agg(F.count(F.lit(1)).alias("filas")),
        "price-counts",
    )
    eans = counted.select(*keys, "ean").distinct().groupBy(*keys).agg(F.count("ean").alias("n_eans"))
    medians = exact_quantiles(
        counted, keys, "precio_unitario", {"precio_mediano": 0.5}, buffer_values
    )
    return (
        null_safe_join(medians.where(F.col("n") >= cfg.fact_rows_min), eans, keys)
        .select(*keys, "precio_mediano", F.col("n").alias("n_observaciones"), "n_eans")
    )


def fact_dispersion(fact: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """Spread of the chain medians of an item within a date and province. A group holds one
    row per chain, so the plain median is bounded. Ties take the first name for the cheapest
    chain and the last for the dearest."""
    price = F.col("precio_mediano")
    lowest, highest = F.min(price), F.max(price)
    return (
        fact.groupBy("fecha", "item", "categoria", "provincia")
        .agg(
            F.count("cadena").alias("cadenas_comparadas"),
            lowest.alias("precio_min"),
            F.median(price).alias("precio_med"),
            highest.alias("precio_max"),
            (highest - lowest).alias("gap_pesos"),
            (100.0 * (F.try_divide(highest, F.nullif(lowest, F.lit(0.0))) - 1)).alias("gap_pct"),
            F.min_by("cadena", F.struct(price, F.col("cadena"))).alias("cadena_mas_barata"),
            F.max_by("cadena", F.struct(price, F.col("cadena"))).alias("cadena_mas_cara"),
        )
        .where(F.col("cadenas_comparadas") >= cfg.chains_min)
    )


def fact_canasta(dispersion: DataFrame, dim: DataFrame) -> DataFrame:
    """Monthly basket cost per date and province: every item at its cheapest chain, at the
    market median and at its dearest chain, with the weight of the items covered."""
    quantity = F.col("cantidad_mes")
    total = dim.select(F.sum("cantidad_mes")).scalar()
    return (
        dispersion.join(dim.select("item", "cantidad_mes"), "item")
        .groupBy("fecha", "provincia")
        .agg(
            F.sum(F.col("precio_min") * quantity).alias("canasta_optima"),
            F.sum(F.col("precio_med") * quantity).alias("canasta_tipica"),
            F.sum(F.col("precio_max") * quantity).alias("canasta_peor"),
            F.countDistinct("item").alias("items_cubiertos"),
            F.sum(quantity).alias("_cubierto"),
        )
        .withColumn("cobertura_ponderada", F.try_divide(F.col("_cubierto"), total))
        .drop("_cubierto")
    )


def fact_ranking(fact: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """Chain index per date and province, 100 = market: the median over items of the ratio to
    the item's market median. A ratio of medians would depend on the assortment instead."""
    market = F.median("precio_mediano").over(W.partitionBy("fecha", "item", "provincia"))
    ratio = F.try_divide(F.col("precio_mediano"), F.nullif(market, F.lit(0.0)))
    return (
        fact.select("fecha", "cadena", "provincia", "item", ratio.alias("_ratio"))
        .groupBy("fecha", "cadena", "provincia")
        .agg(
            F.countDistinct("item").alias("items"),
            (100.0 * F.median("_ratio")).alias("indice_vs_mercado"),
        )
        .where(F.col("items") >= cfg.ranking_items_min)
    )
