"""Findings and report records, all computed from the star tables.

The star tables are small by construction: their grain is date, item, chain and province, the
last three being dimensions. Windows without a partition run over items or dates only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from gondola.config import DEFAULTS, RULES, Thresholds
from gondola.functions.text import date_text, gap_band, json_safe
from gondola.operators.common import at_latest, pct

DASH = "—"
SCENARIOS = ("canasta_optima", "canasta_tipica", "canasta_peor")


def top_dispersion(dispersion: DataFrame, n: int = 10) -> DataFrame:
    """The widest gaps of the latest date."""
    return (
        at_latest(dispersion)
        .orderBy(F.desc("gap_pct"), "item", "provincia")
        .limit(n)
        .select(
            "item", "provincia",
            F.round("gap_pct", 1).alias("gap_pct"),
            F.round("precio_min", 0).alias("min"),
            F.round("precio_max", 0).alias("max"),
            "cadena_mas_barata", "cadena_mas_cara",
        )
    )


def gap_median(dispersion: DataFrame) -> DataFrame:
    """Median gap over all dates."""
    return dispersion.agg(F.coalesce(F.median("gap_pct"), F.lit(0.0)).alias("gap_mediano_pct"))


def basket_now(canasta: DataFrame) -> DataFrame:
    """Mean basket cost of the latest date in the three scenarios, and the saving."""
    means = at_latest(canasta).agg(
        *[F.round(F.avg(c), 0).alias(c.removeprefix("canasta_")) for c in SCENARIOS]
    )
    return means.withColumn("ahorro_mensual_pesos", F.col("tipica") - F.col("optima")).withColumn(
        "ahorro_mensual_pct",
        F.round(100.0 * (1 - F.try_divide("optima", "tipica")), 1),
    )


def basket_change(canasta: DataFrame) -> DataFrame:
    """Change of the mean typical basket from the first date to the last."""
    daily = canasta.groupBy("fecha").agg(F.avg("canasta_tipica").alias("v"))
    first, last = F.min_by("v", "fecha"), F.max_by("v", "fecha")
    return daily.agg(
        date_text(F.min("fecha")).alias("f0"),
        date_text(F.max("fecha")).alias("f1"),
        F.count(F.lit(1)).alias("dias"),
        (100.0 * (F.try_divide(last, F.nullif(first, F.lit(0.0))) - 1)).alias("var_pct"),
    )


def findings(dispersion: DataFrame, canasta: DataFrame, n: int = 10) -> DataFrame:
    """The summary record: one row with nested fields, as written to JSON."""
    # Ranked by the gaps before rounding, as the table is; at most n rows are numbered.
    top = top_dispersion(dispersion, n)
    widest = at_latest(dispersion).orderBy(F.desc("gap_pct"), "item", "provincia").limit(n)
    exact = widest.select("item", "provincia", F.col("gap_pct").alias("_gap"))
    top = top.join(exact, ["item", "provincia"])
    entry = F.struct(-F.col("_gap"), "item", "provincia", F.struct(*[c for c in top.columns if c != "_gap"]).alias("col2"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["col2"])
    now = basket_now(canasta)
    parts = [
        top.agg(listed.alias("top_dispersion")),
        gap_median(dispersion),
        now.select(
            F.struct("optima", "tipica", "peor").alias("canasta"),
            "ahorro_mensual_pesos", "ahorro_mensual_pct",
        ),
        basket_change(canasta).select(F.struct("f0", "f1", "dias", "var_pct").alias("variacion_canasta")),
    ]
    return one_row(*parts)


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row frames side by side."""
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part, allowMissingColumns=True)
    return joined.agg(*[F.first(c, ignorenulls=True).alias(c) for c in joined.columns])


# ---- dispersion -------------------------------------------------------------------------


def dispersion_by_item(dispersion: DataFrame, dim: DataFrame, n: int | None = None) -> DataFrame:
    """Latest date: median gap and prices over provinces per item, widest first."""
    result = (
        at_latest(dispersion)
        .groupBy("categoria", "item")
        .agg(
            F.median("gap_pct").alias("gap"),
            F.median("precio_min").alias("pmin"),
            F.median("precio_max").alias("pmax"),
            F.countDistinct("provincia").alias("provincias"),
        )
        .join(dim.select("item", F.col("unidad_base").alias("unidad")), "item", "left")
        .fillna(DASH, ["unidad"])
        .orderBy(F.desc("gap"), "item")
    )
    return result.limit(n) if n else result


def dispersion_by_category(dispersion: DataFrame) -> DataFrame:
    return (
        at_latest(dispersion)
        .groupBy("categoria")
        .agg(
            F.median("gap_pct").alias("brecha_mediana"),
            F.countDistinct("item").alias("items"),
            F.count(F.lit(1)).alias("observaciones"),
        )
        .orderBy(F.desc("brecha_mediana"), "categoria")
    )


def detail(dispersion: DataFrame, dim: DataFrame) -> DataFrame:
    """Latest date, one row per item and province, widest gap first."""
    rounded = [F.round(c, 1).alias(c) for c in ("precio_min", "precio_med", "precio_max", "gap_pct")]
    return (
        at_latest(dispersion)
        .join(dim.select("item", F.col("unidad_base").alias("unidad")), "item", "left")
        .orderBy(F.desc("gap_pct"), "item", "provincia")
        .select(
            "item", "categoria", "provincia", *rounded, "cadena_mas_barata", "cadena_mas_cara",
            "cadenas_comparadas", "unidad",
        )
        .fillna(DASH, ["cadena_mas_barata", "cadena_mas_cara", "unidad", "categoria"])
    )


def explore(
    detalle: DataFrame,
    provincia: str | None = None,
    categoria: str | None = None,
    texto: str = "",
    order_by: str = "gap_pct",
    ascending: bool = False,
    limit: int = 400,
    cfg: Thresholds = DEFAULTS,
) -> DataFrame:
    """The explorer's view of the detail table, with the band of each gap."""
    if provincia:
        detalle = detalle.where(F.col("provincia") == provincia)
    if categoria:
        detalle = detalle.where(F.col("categoria") == categoria)
    if texto.strip():
        detalle = detalle.where(F.contains(F.lower("item"), F.lit(texto.strip().lower())))
    key = F.asc(order_by) if ascending else F.desc(order_by)
    return (
        detalle.withColumn("banda", gap_band(F.col("gap_pct"), cfg))
        .orderBy(key, "item", "provincia")
        .limit(limit)
    )


def filter_lists(dispersion: DataFrame) -> DataFrame:
    """One row with the sorted categories and provinces of the latest date."""
    latest = at_latest(dispersion)
    return latest.agg(
        F.sort_array(F.collect_set("categoria")).alias("categorias"),
        F.sort_array(F.collect_set("provincia")).alias("prov_lista"),
    )


# ---- basket -----------------------------------------------------------------------------


def basket_by_date(canasta: DataFrame) -> DataFrame:
    """Mean over provinces of the three scenarios per date, with the spread and the saving."""
    return (
        canasta.groupBy("fecha")
        .agg(*[F.avg(c).alias(c) for c in SCENARIOS])
        .select(
            "fecha",
            date_text(F.col("fecha"), with_year=False).alias("dia"),
            *SCENARIOS,
            (F.col("canasta_tipica") - F.col("canasta_optima")).alias("ahorro"),
            (F.col("canasta_peor") - F.col("canasta_optima")).alias("rango"),
            (100.0 * (1 - F.try_divide("canasta_optima", "canasta_tipica"))).alias("ahorro_pct"),
        )
        .orderBy("fecha")
    )


def basket_by_province(canasta: DataFrame) -> DataFrame:
    """Latest typical basket per province against the mean of the provinces and the cheapest."""
    everywhere = W.partitionBy()
    cost = F.col("canasta_tipica")
    return (
        at_latest(canasta)
        .groupBy("provincia")
        .agg(F.avg("canasta_tipica").alias("canasta_tipica"))
        .select(
            "provincia", "canasta_tipica",
            F.avg(cost).over(everywhere).alias("media"),
            (cost > F.avg(cost).over(everywhere)).alias("sobre_media"),
            (100.0 * (F.try_divide(F.max(cost).over(everywhere), F.min(cost).over(everywhere)) - 1))
            .alias("brecha_pct"),
        )
        .orderBy("canasta_tipica", "provincia")
    )


def savings_pareto(dispersion: DataFrame, dim: DataFrame) -> DataFrame:
    """Which items the possible saving comes from: mean over provinces of (median - lowest
    price) x monthly quantity, with the cumulative share in descending order."""
    running = W.orderBy(F.desc("ahorro_mensual"), "item").rowsBetween(W.unboundedPreceding, 0)
    saving = (F.col("precio_med") - F.col("precio_min")) * F.col("cantidad_mes")
    return (
        at_latest(dispersion)
        .join(dim.select("item", "cantidad_mes"), "item")
        .groupBy("item")
        .agg(F.avg(saving).alias("ahorro_mensual"))
        .select(
            "item", "ahorro_mensual",
            pct(F.sum("ahorro_mensual").over(running), F.sum("ahorro_mensual").over(W.partitionBy()))
            .alias("acumulado_pct"),
            F.row_number().over(W.orderBy(F.desc("ahorro_mensual"), "item")).alias("puesto"),
        )
        .orderBy("puesto")
    )


# ---- chains -----------------------------------------------------------------------------


def chain_index(ranking: DataFrame) -> DataFrame:
    """Latest index per chain: median over provinces, and the spread between chains."""
    everywhere = W.partitionBy()
    return (
        at_latest(ranking)
        .groupBy("cadena")
        .agg(
            F.median("indice_vs_mercado").alias("indice"),
            F.sum("items").alias("items"),
            F.countDistinct("provincia").alias("provincias"),
        )
        .withColumn("rango", F.max("indice").over(everywhere) - F.min("indice").over(everywhere))
        .orderBy("indice", "cadena")
    )


def chain_category_ratio(fact: DataFrame) -> DataFrame:
    """Latest median ratio (100 = market) of a chain's prices per category, in long form."""
    market = F.median("precio_mediano").over(W.partitionBy("item", "provincia"))
    return (
        at_latest(fact)
        .select(
            "cadena", "categoria",
            (100.0 * F.try_divide(F.col("precio_mediano"), market)).alias("ratio"),
        )
        .groupBy("cadena", "categoria")
        .agg(F.round(F.median("ratio"), 0).alias("ratio"))
    )


def chain_category_pivot(fact: DataFrame, categories: list[str]) -> DataFrame:
    """The same as a table with one column per category of the basket."""
    return (
        chain_category_ratio(fact).groupBy("cadena").pivot("categoria", categories)
        .agg(F.first("ratio")).orderBy("cadena")
    )


def category_leaders(fact: DataFrame) -> DataFrame:
    """Cheapest chain of every category and how many chains lead one."""
    leaders = chain_category_ratio(fact).groupBy("categoria").agg(
        F.min_by("cadena", F.struct("ratio", "cadena")).alias("cadena"),
        F.min("ratio").alias("ratio"),
    )
    names = F.collect_set("cadena").over(W.partitionBy())
    return leaders.withColumn("lideres", F.size(names).cast("long")).orderBy("categoria")


def daily_change(fact: DataFrame) -> DataFrame:
    """Change in % of a chain's median item price against the previous date of the table. A
    chain missing on either date has no change."""
    daily = fact.groupBy("fecha", "cadena").agg(F.median("precio_mediano").alias("precio"))
    dates = daily.select("fecha").distinct().withColumn(
        "fecha_previa", F.lag("fecha").over(W.orderBy("fecha"))
    )
    before = daily.select(
        F.col("fecha").alias("fecha_previa"), "cadena", F.col("precio").alias("precio_previo")
    )
    return (
        daily.join(dates, "fecha")
        .join(before, ["fecha_previa", "cadena"])
        .select(
            "fecha", "cadena",
            (100.0 * (F.try_divide("precio", F.nullif("precio_previo", F.lit(0.0))) - 1)).alias("var_pct"),
        )
        .orderBy("fecha", "cadena")
    )


def daily_change_pivot(changes: DataFrame, chains: list[str]) -> DataFrame:
    """Dates as rows, chains as columns."""
    return changes.groupBy("fecha").pivot("cadena", chains).agg(F.first("var_pct")).orderBy("fecha")


# ---- quality log ------------------------------------------------------------------------


def discards_share(quality: DataFrame) -> DataFrame:
    """Discards of every rule over all days as % of the raw rows."""
    totals = quality.agg(
        F.sum("filas_crudas").alias("_filas"),
        *[F.sum(f"desc_{rule}").alias(rule) for rule in RULES],
    )
    entries = [
        F.struct(
            F.lit(rule).alias("regla"), F.col(rule).alias("filas"),
            pct(F.col(rule), F.col("_filas")).alias("pct"),
        )
        for rule in RULES
    ]
    return totals.select(F.inline(F.array(*entries))).orderBy("pct", "regla")


def quality_rollup(quality: DataFrame) -> DataFrame:
    """Totals and ranges over the daily quality log."""
    raw, final = F.sum("filas_crudas"), F.sum("filas_finales")
    ranges = []
    for name in ("cadenas", "sucursales", "eans_unicos"):
        ranges += [F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max")]
    gap = "pct_fuentes_discrepan"
    return quality.agg(
        F.count("fecha").alias("dias"),
        raw.alias("filas_crudas"),
        final.alias("filas_finales"),
        (100.0 * (1 - F.try_divide(final, raw))).alias("pct_descartado"),
        *ranges,
        F.min(gap).alias("discrepan_min"),
        F.max(gap).alias("discrepan_max"),
        F.avg(gap).alias("discrepan_media"),
        F.avg("pct_tamano_desc").alias("tamano_desc_media"),
        F.avg("pct_sin_tamano").alias("sin_tamano_media"),
    )


def kpis(dispersion: DataFrame, canasta: DataFrame, quality: DataFrame) -> DataFrame:
    """The dashboard's headline record, one row."""
    daily = canasta.groupBy("fecha").agg(*[F.avg(c).alias(c) for c in SCENARIOS])
    typical = F.max_by("canasta_tipica", "fecha")
    optimal = F.max_by("canasta_optima", "fecha")
    basket = daily.agg(
        typical.alias("canasta_tipica"),
        (typical - optimal).alias("ahorro"),
        F.round(100.0 * (1 - F.try_divide(optimal, typical)), 1).alias("ahorro_pct"),
        F.round(100.0 * (F.try_divide(typical, F.min_by("canasta_tipica", "fecha")) - 1), 1)
        .alias("var_periodo"),
        F.count(F.lit(1)).alias("dias"),
        date_text(F.min("fecha")).alias("desde"),
        date_text(F.max("fecha")).alias("hasta"),
    )
    gap = at_latest(dispersion).agg(F.round(F.median("gap_pct"), 1).alias("gap_mediano"))
    log = quality.agg(
        F.sum("filas_crudas").alias("filas_crudas"),
        F.max("cadenas").alias("cadenas"),
        F.max("sucursales").alias("sucursales"),
        F.max("eans_unicos").alias("eans"),
        F.round(100.0 * (1 - F.try_divide(F.sum("filas_finales"), F.sum("filas_crudas"))), 2)
        .alias("pct_descartado"),
        F.round(F.avg("pct_fuentes_discrepan"), 1).alias("discrepancia"),
    )
    return one_row(gap, basket, log)


def json_ready(df: DataFrame) -> DataFrame:
    """NaN and infinities of every double column to null, as strict JSON requires."""
    doubles = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*[json_safe(F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns])
