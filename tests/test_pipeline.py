"""The whole pipeline on a landing area, and the SQL oracles."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import oracle_rows, spark_rows
from gondola import catalog
from gondola.operators import checks, compare, texts
from gondola.plans import clean as clean_plan, star as star_plan
from gondola.sources import tables
from oracle import sql


def test_pipeline(spark, sf, tmp_path):
    landing, out = catalog.tables(spark, sf).landing, str(tmp_path / "lake")
    rejects = clean_plan.clean_days(spark, landing, out)
    assert rejects.isEmpty()
    clean = tables.read_clean(spark, f"{out}/precios")
    total = clean.count()
    assert total == catalog.tables(spark, sf).audited.where("descarte is null").count()
    assert clean.select("fecha").distinct().count() == tables.read_quality(spark, f"{out}/calidad").count() == 7

    # A repeated run finds nothing to do; a forced one replaces every day.
    clean_plan.clean_days(spark, landing, out)
    assert tables.read_clean(spark, f"{out}/precios").count() == total
    clean_plan.clean_days(spark, landing, out, force=True)
    clean = tables.read_clean(spark, f"{out}/precios")
    assert clean.count() == total
    assert tables.read_quality(spark, f"{out}/calidad").count() == 7

    # Facts need more rows per group than the smallest data has with the real basket.
    from gondola.config import Thresholds
    cfg = Thresholds(fact_rows_min=1, chains_min=2, ranking_items_min=1)
    star = star_plan.transform(spark, clean, f"{out}/star", cfg=cfg)
    assert star["fact_dispersion"].count() > 0
    exported = spark.read.option("header", True).csv(f"{out}/star/fact_precio_item")
    assert exported.count() == star["fact_precio_item"].count()
    labelled = texts.with_items(clean, texts.text_dictionary(clean), basket_only=True)
    annotated = compare.annotate_comparable(labelled, star["dim_item"], cfg)
    for name, motivo in (("unidades_perdidas", "unidad"), ("descartes_rango", "rango")):
        lost = spark.read.schema("item string, grupo string, filas long").option("header", True).csv(f"{out}/star/comparabilidad/{name}")
        assert (lost.agg(F.sum("filas")).first()[0] or 0) == annotated.where(F.col("motivo") == motivo).count()
    part = next(Path(f"{out}/star/resumen_hallazgos").glob("*.json"))
    record = json.loads(part.read_text())
    assert record["top_dispersion"] and set(record["canasta"]) == {"optima", "tipica", "peor"}
    payload = star_plan.dashboard_payload(star, tables.read_quality(spark, f"{out}/calidad"))
    shown = json.loads(payload.select(F.to_json(F.struct("*"))).first()[0])
    gaps = [d["gap_pct"] for d in shown["detalle"]]
    assert gaps == sorted(gaps, reverse=True) and shown["kpis"]["filas_crudas"] == 6000

    labelled = texts.with_items(clean, texts.text_dictionary(clean), basket_only=True)
    rows = compare.comparable(compare.annotate_comparable(labelled, star["dim_item"], cfg))
    found = {r["control"]: r["violaciones"] for r in checks.run_checks(clean, rows, star, cfg).collect()}
    assert len(found) == 9 and set(found.values()) == {0}

    # The checks do notice: a shifted median, a duplicate, a raw province code.
    shifted = star | {"fact_precio_item": star["fact_precio_item"].withColumn("precio_mediano", F.col("precio_mediano") * 1.01)}
    dirty = clean.union(clean.limit(1)).withColumn("provincia", F.lit("AR-X"))
    noticed = {r["control"]: r["violaciones"] for r in checks.run_checks(dirty, rows, shifted, cfg).collect()}
    assert noticed["V1 precio_item"] > 0 and noticed["V7 duplicados"] == 1
    assert noticed["V7 provincia sin mapear"] == total + 1


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "gap_pct" in df.columns


# Queries over the star tables, which are empty at the smallest scale.
STAR = {
    "precio_item", "dispersion", "canasta", "ranking_cadenas", "top_dispersion", "hallazgos",
    "variacion_canasta", "canasta_actual", "dispersion_item", "dispersion_categoria",
    "canasta_por_fecha", "geografia", "indice_cadenas", "pareto_ahorro", "pivot_cadena_categoria",
    "lider_categoria", "variacion_diaria", "variacion_diaria_pivot", "detalle", "explorador",
    "banda_brecha", "listas_filtro", "exportacion",
}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_oracle(spark, sf, name):
    if name in STAR:
        sf = sf.replace("sf0.001", "sf0.01")
    assert spark_rows(catalog.queries()[name](spark, sf)) == oracle_rows(sf, sql.oracle_sql()[name])
