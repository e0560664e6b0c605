"""Diagnostics over the clean table: volume, coverage, catalogue, stability and jumps.

Distinct counts are written as a distinct followed by a count, one column group at a time.
Both steps combine map-side, and a large group is spread over tasks by the counted column;
several `count(distinct)` in one aggregation would multiply the rows instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gondola.config import DEFAULTS, Thresholds
from gondola.functions.text import strip, unit_clean
from gondola.functions.units import unit_ignored, unit_known
from gondola.operators.common import broadcast_within, null_safe_join, pct
from gondola.operators.quantiles import exact_median, exact_quantiles, value_counts
from gondola.sources.shared import materialize

BRANCH = ("id_comercio", "id_sucursal")


def _distinct_eans(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "ean").distinct().groupBy(key).agg(F.count("ean").alias("eans"))


def _by_branch(df: DataFrame, key: str) -> DataFrame:
    """Rows per branch of the key: small, whatever the number of rows."""
    columns = dict.fromkeys((key, "cadena", "provincia", *BRANCH))
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("filas"))


def _branches() -> Column:
    return F.countDistinct(F.struct(*BRANCH)).alias("sucursales")


def volume_by_day(clean: DataFrame) -> DataFrame:
    days = _by_branch(clean, "fecha").groupBy("fecha").agg(
        F.sum("filas").alias("filas"),
        F.countDistinct("cadena").alias("cadenas"),
        _branches(),
        F.countDistinct("provincia").alias("provincias"),
    )
    return (
        null_safe_join(days, _distinct_eans(clean, "fecha"), ["fecha"])
        .select("fecha", "filas", "eans", "cadenas", "sucursales", "provincias")
        .orderBy("fecha")
    )


def concentration(clean: DataFrame) -> DataFrame:
    """Share of the rows per chain, largest first, with the running share (top 3 is the third
    row's). `sucursales` counts merchant and branch together; `ids_sucursal` counts the branch
    number alone, which merchants reuse."""
    by_size = W.orderBy(F.desc("filas"), "cadena").rowsBetween(W.unboundedPreceding, 0)
    total = F.sum("filas").over(W.partitionBy())
    chains = _by_branch(clean, "cadena").groupBy("cadena").agg(
        F.sum("filas").alias("filas"),
        _branches(),
        F.countDistinct("id_sucursal").alias("ids_sucursal"),
        F.countDistinct("provincia").alias("provincias"),
    )
    return (
        null_safe_join(chains, _distinct_eans(clean, "cadena"), ["cadena"])
        .withColumn("pct", F.round(pct(F.col("filas"), total), 1))
        .withColumn("pct_acumulado", F.sum("pct").over(by_size))
        .orderBy(F.desc("filas"), "cadena")
    )


def geo_coverage(clean: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """Rows, chains and branches per province; a province is comparable from three chains up."""
    return (
        _by_branch(clean, "provincia").groupBy("provincia")
        .agg(F.sum("filas").alias("filas"), F.countDistinct("cadena").alias("cadenas"), _branches())
        .withColumn("comparable", F.col("cadenas") >= cfg.chains_min)
        .orderBy(F.desc("filas"), "provincia")
    )


def geo_summary(coverage_: DataFrame) -> DataFrame:
    """One row: provinces, comparable ones and the share of rows they hold."""
    return coverage_.agg(
        F.count(F.lit(1)).alias("provincias"),
        F.count_if("comparable").alias("comparables"),
        pct(F.sum(F.when(F.col("comparable"), F.col("filas")).otherwise(0)), F.sum("filas"))
        .alias("pct_filas"),
    )


# ---- catalogue --------------------------------------------------------------------------


def _texts_per_ean(df: DataFrame) -> DataFrame:
    return (
        df.select("ean", "descripcion").where(F.col("ean").isNotNull()).distinct()
        .groupBy("ean").agg(F.count("descripcion").alias("n_desc"))
    )


def texts_per_ean(df: DataFrame) -> DataFrame:
    """How many EANs have how many different descriptions."""
    return (
        _texts_per_ean(df).groupBy("n_desc").agg(F.count(F.lit(1)).alias("eans")).orderBy("n_desc")
    )


def catalog_stats(df: DataFrame) -> DataFrame:
    return _texts_per_ean(df).agg(
        F.max("n_desc").alias("max_desc_por_ean"),
        F.round(F.avg("n_desc"), 2).alias("promedio"),
        F.count_if(F.col("n_desc") > 1).alias("eans_con_varias"),
        F.count(F.lit(1)).alias("eans_totales"),
    )


def ean_examples(df: DataFrame, low: int = 3, high: int = 6, n: int = 5) -> DataFrame:
    """The texts of the first EANs that have between `low` and `high` of them. The EANs are
    picked before any text is gathered."""
    picked = _texts_per_ean(df).where(F.col("n_desc").between(low, high)).orderBy("ean").limit(n)
    return (
        df.join(broadcast_within(picked.select("ean"), n), "ean", "left_semi")
        .select("ean", "descripcion").distinct()
        .groupBy("ean")
        .agg(F.array_join(F.sort_array(F.collect_set("descripcion")), "  |  ").alias("textos"))
        .orderBy("ean")
    )


def raw_cardinality(raw: DataFrame, n: int = 5000) -> DataFrame:
    """Distinct values and examples of two fields over the first rows of a raw file: a count
    of codes is not a code."""
    fields = F.array(*(
        F.struct(F.lit(field).alias("campo"), F.col(field).alias("valor"))
        for field in ("productos_ean", "id_producto")
    ))
    # Both fields from one reading of the file.
    head = raw.orderBy("orden").limit(n).select(F.inline(fields)).where("valor is not null")
    return (
        head.groupBy("campo")
        .agg(
            F.countDistinct("valor").alias("distintos"),
            F.slice(F.sort_array(F.collect_set("valor")), 1, 5).alias("ejemplos"),
        )
        .orderBy("campo")
    )


# ---- units ------------------------------------------------------------------------------


def unit_frequency(df: DataFrame, n: int = 30) -> DataFrame:
    """The most frequent unit texts and whether they are mapped or ignored on purpose. Only
    stripped and lowered, as a check on the raw text."""
    unit = F.col("productos_unidad_medida_presentacion")
    plain = F.lower(strip(F.col("u")))
    return (
        df.where(unit.isNotNull()).groupBy(unit.alias("u")).agg(F.count(F.lit(1)).alias("filas"))
        .orderBy(F.desc("filas"), "u").limit(n)
        .select("u", "filas", unit_known(plain).alias("mapeada"), unit_ignored(plain).alias("ignorada_a_proposito"))
    )


def unknown_units(df: DataFrame, n: int = 25) -> DataFrame:
    """Unit texts that are neither mapped nor ignored, by weight. The raw texts are counted
    first, so that each is cleaned once."""
    unit = unit_clean(F.col("productos_unidad_medida_presentacion"))
    return (
        df.where(F.col("productos_unidad_medida_presentacion").isNotNull())
        .groupBy("productos_unidad_medida_presentacion").agg(F.count(F.lit(1)).alias("filas"))
        .groupBy(unit.alias("unidad")).agg(F.sum("filas").alias("filas"))
        .where(~unit_known(F.col("unidad")) & ~unit_ignored(F.col("unidad")))
        .orderBy(F.desc("filas"), "unidad").limit(n)
    )


# ---- basket coverage --------------------------------------------------------------------


def coverage(labelled: DataFrame) -> DataFrame:
    """Rows, EANs, median unit price and share in the expected unit per basket item."""
    keys = ["categoria", "item"]
    ok = F.coalesce(F.col("unidad_base") == F.col("unidad_esperada"), F.lit(False))
    counted = materialize(
        labelled.where(F.col("item").isNotNull())
        .groupBy(*keys, "ean", "precio_unitario", ok.alias("ok"))
        .agg(F.count(F.lit(1)).alias("filas")),
        "coverage",
    )
    sizes = counted.groupBy(*keys).agg(
        F.sum("filas").alias("filas"),
        F.round(pct(F.sum(F.when(F.col("ok"), F.col("filas")).otherwise(0)), F.sum("filas")), 1)
        .alias("pct_unidad_ok"),
    )
    eans = counted.select(*keys, "ean").distinct().groupBy(*keys).agg(F.count("ean").alias("eans"))
    priced = counted.where(F.col("precio_unitario").isNotNull())
    medians = exact_quantiles(priced, keys, "precio_unitario", {"precio_unitario_mediano": 0.5})
    return (
        null_safe_join(null_safe_join(sizes, eans, keys), medians.drop("n"), keys, "left")
        .select(*keys, "filas", "eans", "precio_unitario_mediano", "pct_unidad_ok")
        .orderBy(F.desc("filas"), "item")
    )


def coverage_review(coverage_: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """Items whose pattern deserves a look."""
    return coverage_.where(
        (F.col("pct_unidad_ok") < cfg.coverage_unit_pct) | (F.col("eans") < cfg.coverage_eans)
    ).orderBy(F.desc("filas"), "item")


def items_without_data(coverage_: DataFrame, dim: DataFrame) -> DataFrame:
    return dim.select("item").join(coverage_, "item", "left_anti").orderBy("item")


# ---- time -------------------------------------------------------------------------------


def _daily_prices(clean: DataFrame) -> DataFrame:
    """Median price per date, chain and EAN with the previous one the chain reported."""
    daily = exact_median(clean, ["fecha", "cadena", "ean"], "precio", "precio").drop("n")
    previous = F.lag("precio").over(W.partitionBy("cadena", "ean").orderBy("fecha"))
    return daily.withColumn("previo", previous).where(F.col("previo").isNotNull())


def _change() -> Column:
    return F.try_divide(F.col("precio"), F.nullif(F.col("previo"), F.lit(0.0))) - 1


def price_jumps(clean: DataFrame, cfg: Thresholds = DEFAULTS, n: int = 20) -> DataFrame:
    """The largest changes above the threshold between a product's consecutive dates."""
    top = (
        _daily_prices(clean)
        .where(F.abs(_change()) > cfg.jump_min)
        .withColumn("var_pct", F.round(100.0 * _change(), 0))
        .orderBy(F.desc(F.abs("var_pct")), "fecha", "cadena", "ean")
        .limit(n)
    )
    # Only the listed products need a text.
    keys = ["fecha", "cadena", "ean"]
    listed = broadcast_within(top.select(*keys), n)
    texts = (
        null_safe_join(clean, listed, keys, "left_semi")
        .groupBy(*keys).agg(F.min("descripcion").alias("descripcion"))
    )
    return (
        null_safe_join(top, texts, keys, "left")
        .select(
            "fecha", "cadena", "ean", F.substring("descripcion", 1, 45).alias("producto"),
            F.round("previo", 0).alias("antes"), F.round("precio", 0).alias("despues"), "var_pct",
        )
        .orderBy(F.desc(F.abs("var_pct")), "fecha", "cadena", "ean")
    )


def jump_counts(clean: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """Changes above the threshold and all pairs of consecutive dates."""
    return _daily_prices(clean).agg(
        F.count_if(F.abs(_change()) > cfg.jump_min).alias("saltos"),
        F.count(F.lit(1)).alias("pares"),
    )


def branch_stability(clean: DataFrame) -> DataFrame:
    """How many branches report how many days, and the share that reports every day."""
    days = (
        clean.select("cadena", *BRANCH, "fecha").distinct()
        .groupBy("cadena", *BRANCH).agg(F.count("fecha").alias("dias"))
    )
    histogram = days.groupBy("dias").agg(F.count(F.lit(1)).alias("sucursales"))
    all_days = clean.select(F.countDistinct("fecha")).scalar()
    return histogram.select(
        "dias", "sucursales",
        (F.col("dias") == all_days).alias("completas"),
        pct(F.col("sucursales"), F.sum("sucursales").over(W.partitionBy())).alias("pct"),
    ).orderBy("dias")


def chain_days(clean: DataFrame) -> DataFrame:
    """Days reported per chain; a chain with fewer than all of them is incomplete."""
    all_days = clean.select(F.countDistinct("fecha")).scalar()
    return (
        clean.select("cadena", "fecha").distinct()
        .groupBy("cadena").agg(F.count("fecha").alias("dias_reportados"))
        .withColumn("incompleta", F.col("dias_reportados") < all_days)
        .orderBy("dias_reportados", "cadena")
    )


# ---- prices -----------------------------------------------------------------------------

PERCENTILES = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def describe_prices(df: DataFrame, columns=("precio", "precio_unitario")) -> DataFrame:
    """Count, mean, deviation, extremes and exact percentiles, one row per column. The counts
    of each value are written once and serve all of them."""
    result = None
    for column in columns:
        counts = value_counts(df, [], column)
        quantiles = exact_quantiles(counts, [], column, PERCENTILES)
        value, n = F.col(column), F.col("filas")
        mean = F.sum(value * n) / F.sum(n)
        moments = counts.agg(F.sum(n).alias("_n"), F.min(value).alias("min"), F.max(value).alias("max"),
                             mean.alias("media"))
        centre = moments.select("media").scalar()
        spread = counts.agg(
            F.sqrt(F.try_divide(F.sum((value - centre) * (value - centre) * n), F.sum(n) - 1)).alias("desvio")
        )
        parts = [quantiles, moments.drop("_n"), spread]
        joined = parts[0]
        for part in parts[1:]:
            joined = joined.unionByName(part, allowMissingColumns=True)
        row = joined.agg(*[F.first(c, ignorenulls=True).alias(c) for c in joined.columns]).select(
            F.lit(column).alias("columna"), F.col("n").alias("filas"), "media", "desvio", "min",
            *PERCENTILES, "max",
        )
        result = row if result is None else result.union(row)
    return result


def price_histogram(df: DataFrame, column: str = "precio", bins: int = 100) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed."""
    present = df.select(column).where(F.col(column).isNotNull())
    low, high = present.select(F.min(column)).scalar(), present.select(F.max(column)).scalar()
    position = F.floor(F.try_divide((F.col(column) - low) * bins, high - low))
    return (
        present.groupBy(F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int").alias("intervalo"))
        .agg(F.count(F.lit(1)).alias("filas"))
        .orderBy("intervalo")
    )
