"""Clean table to star schema, findings and dashboard payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.config import DEFAULTS, Thresholds
from gondola.dims import BASKET, BasketItem, dim_item
from gondola.operators import facts as f, findings
from gondola.operators.compare import annotate_comparable, comparable, lost_units, range_discards, require_rows
from gondola.operators.texts import text_dictionary, with_items
from gondola.sources.shared import materialize
from gondola.sources.tables import export_json, export_star


def build_star(rows: DataFrame, dim: DataFrame, cfg: Thresholds = DEFAULTS) -> dict[str, DataFrame]:
    """The star tables of comparable rows. The price fact is stored once and the others, far
    smaller, are stored from it."""
    fact = materialize(f.fact_precio_item(rows, cfg), "fact_precio_item")
    dispersion = materialize(f.fact_dispersion(fact, cfg), "fact_dispersion")
    return {
        "dim_item": dim,
        "fact_precio_item": fact,
        "fact_dispersion": dispersion,
        "fact_canasta": materialize(f.fact_canasta(dispersion, dim), "fact_canasta"),
        "fact_ranking_cadenas": materialize(f.fact_ranking(fact, cfg), "fact_ranking_cadenas"),
    }


def transform(
    spark: SparkSession,
    clean: DataFrame,
    out: str,
    basket: Sequence[BasketItem] = BASKET,
    cfg: Thresholds = DEFAULTS,
) -> dict[str, DataFrame]:
    """Label, keep the comparable rows, build the star tables and export them as CSV with the
    findings as JSON and the rows lost for their unit or price. Fails if no row can be compared."""
    clean = require_rows(clean, "there is no clean data")
    dim = dim_item(spark, tuple(basket))
    labelled = with_items(clean, text_dictionary(clean, basket), basket_only=True)
    annotated = materialize(annotate_comparable(labelled, dim, cfg), "annotated")
    lost = {"unidades_perdidas": lost_units(annotated), "descartes_rango": range_discards(annotated)}
    export_star(lost, f"{out}/comparabilidad")
    star = build_star(require_rows(comparable(annotated)), dim, cfg)
    export_star(star, out)
    export_json(
        findings.findings(star["fact_dispersion"], star["fact_canasta"]), f"{out}/resumen_hallazgos"
    )
    return star


def dashboard_payload(star: dict[str, DataFrame], quality: DataFrame) -> DataFrame:
    """Everything the dashboard shows, as one row of nested fields ready for strict JSON."""
    dispersion, canasta, dim = star["fact_dispersion"], star["fact_canasta"], star["dim_item"]

    def listed(df: DataFrame, name: str) -> DataFrame:
        # Report-sized tables: one record per item, chain, province or date.
        numbered = findings.json_ready(df).withColumn("_n", F.monotonically_increasing_id())
        entry = F.struct("_n", F.struct(*df.columns).alias("r"))
        return numbered.agg(
            F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["r"]).alias(name)
        )

    headline = findings.json_ready(findings.kpis(dispersion, canasta, quality))
    return findings.one_row(
        headline.select(F.struct("*").alias("kpis")),
        listed(findings.basket_by_date(canasta), "canasta"),
        listed(findings.dispersion_by_item(dispersion, dim), "dispersion"),
        listed(findings.chain_index(star["fact_ranking_cadenas"]), "ranking"),
        listed(findings.basket_by_province(canasta), "provincias"),
        listed(findings.detail(dispersion, dim), "detalle"),
        findings.filter_lists(dispersion),
    )
