"""Rule order, keep-last, outliers, guardrail, enrichment, comparability."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gondola.dims import BASKET, dim_item
from gondola.operators import compare, quality, sampling, texts
from gondola.operators.enrich import enrich

DAY, NEXT = dt.date(2026, 7, 24), dt.date(2026, 7, 25)
SCHEMA = "fecha date, id_comercio string, id_sucursal string, ean string, precio double, orden long"


def _marks(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["orden"]: r["descarte"] for r in quality.annotate_rules(df).collect()}


def test_rules_in_order(spark):
    rows = [
        (DAY, "1", "1", "0", None, 0), (DAY, "1", "1", "", 5.0, 1), (DAY, "1", "1", None, 5.0, 2),
        (DAY, "1", "1", "123", 0.0, 3), (DAY, "1", "1", "123456789012345", 5.0, 4),
        (DAY, "1", "1", "7791", 0.99, 5), (DAY, "1", "1", "7791", 5_000_000.01, 6),
        (DAY, "1", "1", "7792", 1.0, 7), (DAY, "1", "1", "7792", 5_000_000.0, 8),
        (NEXT, "1", "1", "7792", 3.0, 9), (DAY, None, "1", "7793", 1.0, 10), (DAY, None, "1", "7793", 2.0, 11),
        # The last copy is out of range, so the one before it is the row to keep.
        (DAY, "1", "1", "7794", 10.0, 12), (DAY, "1", "1", "7794", 11.0, 13), (DAY, "1", "1", "7794", 0.5, 14),
    ]
    assert _marks(spark, rows) == {
        0: "nulos", 1: "nulos", 2: "nulos", 3: "ean_invalido", 4: "ean_invalido",
        5: "precio_fuera_rango", 6: "precio_fuera_rango", 7: "duplicados", 8: None, 9: None,
        10: "duplicados", 11: None, 12: "duplicados", 13: None, 14: "precio_fuera_rango",
    }


def test_outliers(spark):
    five = [(DAY, "1", str(i), "7791", 100.0, i) for i in range(4)]
    assert set(_marks(spark, five[:3] + [(DAY, "1", "9", "7791", 9999.0, 9)]).values()) == {None}
    assert _marks(spark, five + [(DAY, "1", "9", "7791", 1000.0, 9)])[9] is None       # ratio 10 is kept
    assert _marks(spark, five + [(DAY, "1", "9", "7791", 1000.1, 9)])[9] == "outliers"
    assert _marks(spark, five + [(DAY, "1", "9", "7791", 9.9, 9)])[9] == "outliers"
    assert _marks(spark, five + [(NEXT, "1", "9", "7791", 9.9, 9)])[9] is None


def test_hot_copies(spark):
    """A listing repeated over a third of the table keeps exactly its last row."""
    hot = spark.range(5000).select(
        F.lit(DAY).alias("fecha"), F.lit("1").alias("id_comercio"), F.lit("1").alias("id_sucursal"),
        F.lit("7790000000001").alias("ean"), (F.col("id") % 50 + 10.0).alias("precio"), F.col("id").alias("orden"),
    )
    rest = spark.range(10000).select(
        F.lit(DAY).alias("fecha"), F.lit("1").alias("id_comercio"), F.col("id").cast("string").alias("id_sucursal"),
        F.lit("7790000000002").alias("ean"), F.lit(20.0).alias("precio"), (F.col("id") + 5000).alias("orden"),
    )
    kept = quality.kept(quality.annotate_rules(hot.union(rest)))
    assert kept.count() == 10001
    assert kept.where("ean = '7790000000001'").first()["orden"] == 4999


def test_guardrail(spark):
    rows = [(DAY, "1", str(i), "7791", 100.0 if i % 4 else None, i) for i in range(40)]
    annotated = quality.annotate_rules(spark.createDataFrame(rows, SCHEMA))
    with pytest.raises(quality.ExcessiveDiscard, match="nulos.*10 of 40"):
        quality.enforce_guardrail(annotated)
    counts = quality.enforce_guardrail(annotated, ignore=True)
    assert counts.where("regla = 'nulos'").first()["descarta"] == 10
    exact = [(DAY, "1", str(i), "7791", 100.0 if i % 5 else None, i) for i in range(40)]   # 20 % is allowed
    quality.enforce_guardrail(quality.annotate_rules(spark.createDataFrame(exact, SCHEMA)))


def test_enrich(spark):
    df = spark.createDataFrame([(DAY, "1", "1"), (DAY, "1", "2"), (DAY, "2", "1"), (NEXT, "1", "1")],
                               "fecha date, id_comercio string, id_sucursal string")
    branches = spark.createDataFrame(
        [(DAY, "1", "1", "AR-X", 5), (DAY, "1", "1", "AR-B", 2), (NEXT, "1", "1", "entre ríos", 1)],
        "fecha date, id_comercio string, id_sucursal string, sucursales_provincia string, orden long")
    chains = spark.createDataFrame(
        [(DAY, "1", "COTO CICSA", None, 1), (DAY, "1", "OTRO", "OTRA", 2), (NEXT, "1", "X", " vea ", 1)],
        "fecha date, id_comercio string, comercio_razon_social string, comercio_bandera_nombre string, orden long")
    got = {(r["fecha"], r["id_comercio"], r["id_sucursal"]): (r["provincia"], r["cadena"])
           for r in enrich(df, branches, chains).collect()}
    assert got == {
        (DAY, "1", "1"): ("Buenos Aires", "COTO CICSA"), (DAY, "1", "2"): ("Sin dato", "COTO CICSA"),
        (DAY, "2", "1"): ("Sin dato", "SIN_IDENTIFICAR"), (NEXT, "1", "1"): ("Entre Ríos", "VEA"),
    }
    assert {(r["provincia"], r["cadena"]) for r in enrich(df, None, None).collect()} == {("Sin dato", "SIN_IDENTIFICAR")}


def test_labels(spark):
    # Every item is hit; exclusion falls through to a later item.
    hits = {
        "LECHE ENTERA": "Leche entera", "YOGUR BEBIBLE": "Yogur bebible", "QUESO CREMOSO": "Queso cremoso",
        "MANTECA": "Manteca", "PAN BLANCO LACTAL": "Pan lactal", "HARINA 0000": "Harina 000", "FIDEO": "Fideos secos",
        "ARROZ FINO": "Arroz largo fino", "ACEITE GIRASOL": "Aceite girasol", "AZUCAR": "Azúcar", "YERBA": "Yerba mate",
        "CAFE TOSTADO": "Café molido", "SALSA TOMATE": "Puré de tomate", "ARVEJA": "Arvejas en lata", "ATUN": "Atún en lata",
        "HUEVO": "Huevos", "PAPA NEGRA": "Papa", "BANANA": "Banana", "COCA COLA": "Gaseosa cola",
        "AGUA SIN GAS": "Agua mineral", "CERVEZA": "Cerveza", "DETERGENTE": "Detergente", "LAVANDINA": "Lavandina",
        "JABON EN POLVO": "Jabón en polvo", "PAPEL HIGIENICO": "Papel higiénico", "SHAMPOO": "Shampoo",
        "CREMA DENTAL": "Pasta dental",
        "FIDEO CON SALSA DE TOMATE": "Puré de tomate", "PAPAÑA": None, "CAFÉ MOLIDO": None, "leche entera": None,
        "MANTECA DE CACAO CON BANANA": "Banana", "TELEVISOR": None,
    }
    df = spark.createDataFrame([(k,) for k in hits], "descripcion string")
    got = {r["descripcion"]: r["item"] for r in texts.with_items(df, texts.text_dictionary(df)).collect()}
    assert got == hits
    assert {v for v in got.values() if v} == {e.item for e in BASKET}
    loose = texts.text_dictionary(df, accent_insensitive=True)
    assert {r["descripcion"]: r["item"] for r in loose.collect()}["CAFÉ MOLIDO"] == "Café molido"
    with pytest.raises(ValueError):
        dim_item(spark, (BASKET[0], BASKET[0]))


def test_comparable(spark):
    rows = [("A", "kg", 100.0, "descripcion")] * 30 + [("A", "kg", 10_000.0, "presentacion")] * 50
    rows += [("A", "kg", 35.0, "presentacion"), ("A", "kg", 300.0, None), ("A", "kg", 34.9, None),
             ("A", "l", 100.0, None), ("A", None, None, None), ("A", "kg", None, None), ("A", "kg", 0.0, None)]
    rows += [("B", "kg", 10.0, "descripcion")] * 29 + [("B", "kg", 50.0, "presentacion")] * 31
    df = spark.createDataFrame(rows, "item string, unidad_base string, precio_unitario double, fuente_tamano string")
    df = df.withColumn("unidad_esperada", F.lit("kg"))
    reference = {r["item"]: r["referencia"] for r in compare.reference_prices(df).collect()}
    assert reference == {"A": 100.0, "B": 50.0}
    dim = spark.createDataFrame([("A",), ("B",)], "item string")
    annotated = compare.annotate_comparable(df, dim)
    counts = {(r["item"], r["motivo"]): r["count"] for r in annotated.groupBy("item", "motivo").count().collect()}
    assert counts == {("A", None): 32, ("A", "rango"): 51, ("A", "unidad"): 2, ("A", "sin_precio"): 2,
                      ("B", None): 31, ("B", "rango"): 29}
    with pytest.raises(compare.NothingComparable):
        compare.require_rows(df.where("false"))


def test_exact_sample(spark):
    df = spark.range(20_000).repartition(16)
    drawn = sampling.sample_rows(df, 500, seed=3)
    ids = [r[0] for r in drawn.collect()]
    assert len(ids) == len(set(ids)) == 500 and min(ids) < 2000 and max(ids) > 18_000
    assert sampling.sample_rows(df, 50_000).count() == 20_000


def test_samples_agree_however_rows_are_dealt(spark):
    df = spark.createDataFrame([(k % 50, None if k % 7 == 0 else str(k)) for k in range(900)], "`a.b` int, c string")
    rows = [sorted(map(str, sampling.sample_rows(df.repartition(n), 40, keys=["c"]).collect())) for n in (1, 9)]
    assert rows[0] == rows[1] and len(rows[0]) == 40
    assert rows[0] != sorted(map(str, sampling.sample_rows(df, 40, seed=1, keys=["c"]).collect()))
