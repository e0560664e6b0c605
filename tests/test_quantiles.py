"""Exact medians and quantiles, with and without a group too large for one buffer."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola import fixtures
from gondola.operators import facts, quantiles
from gondola.operators.quantiles import exact_median, exact_quantiles, value_counts

PROBABILITIES = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.77, "e": 1.0}


@pytest.fixture(scope="module")
def values(spark):
    """One group holds a third of the rows, half of those being one repeated price; others
    have one row, an even number of rows, negative and zero values."""
    rng = random.Random(7)
    rows = [("hot", 999.99 if rng.random() < 0.5 else round(rng.lognormvariate(6, 2), 2)) for _ in range(4000)]
    rows += [(f"k{rng.randrange(400)}", round(rng.uniform(-50, 5000), 3)) for _ in range(8000)]
    rows += [("one", 3.0), ("two", -1.0), ("two", 0.0), ("zeros", 0.0), ("zeros", 0.0), ("none", None)]
    return rows, spark.createDataFrame(rows, "k string, v double").repartition(8)


@pytest.mark.parametrize("buffer_values", [0, 100, 1_000_000])
def test_grouped(values, buffer_values):
    rows, df = values
    counts = value_counts(df, ["k"], "v")
    found = {r["k"]: r for r in exact_quantiles(counts, ["k"], "v", PROBABILITIES, buffer_values).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(found) == set(groups)
    for k, group in groups.items():
        assert found[k]["n"] == len(group)
        for name, p in PROBABILITIES.items():
            assert found[k][name] == pytest.approx(np.quantile(group, p), abs=1e-9), (k, name)


@pytest.mark.parametrize("buffer_values", [0, 1_000_000])
def test_whole_table(values, buffer_values):
    rows, df = values
    row = exact_quantiles(value_counts(df, [], "v"), [], "v", PROBABILITIES, buffer_values).first()
    all_values = [v for _, v in rows if v is not None]
    for name, p in PROBABILITIES.items():
        assert row[name] == pytest.approx(np.quantile(all_values, p), abs=1e-9)


def test_median_paths_agree(values):
    _, df = values
    direct = {r["k"]: r["mediana"] for r in exact_median(df, ["k"], "v").collect()}
    split = {r["k"]: r["mediana"] for r in exact_median(df, ["k"], "v", buffer_values=0).collect()}
    assert direct.keys() == split.keys()
    for k in direct:
        assert direct[k] == pytest.approx(split[k], abs=1e-9)


def test_price_fact_paths_agree(spark, sf):
    prices = fixtures.clean_prices(spark, sf, coarse=True)
    def rows(df):
        return sorted(tuple(r) for r in df.withColumn("precio_mediano", F.round("precio_mediano", 6)).collect())
    direct, split = facts.fact_precio_item(prices), facts.fact_precio_item(prices, buffer_values=0)
    assert rows(direct) == rows(split) and direct.count() > 0


def test_null_keys_are_groups(spark):
    from gondola.config import Thresholds
    from gondola.operators import diagnostics

    day = datetime.date(2026, 7, 1)
    keys = [(day, "A", None, "X", "P"), (day, "A", "c", None, "P"), (day, "A", "c", "X", None), (None, "A", "c", "X", "P")]
    rows = [(*k, f"779{e}", float(p), "d", "1", "1", "kg", "kg") for k in keys for e in range(3) for p in range(10)]
    frame = spark.createDataFrame(
        rows + [(day, "A", "c", "X", "P", "779", None, "d", "1", "1", "kg", "kg")],
        "fecha date, item string, categoria string, cadena string, provincia string, ean string, precio_unitario double, "
        "descripcion string, id_comercio string, id_sucursal string, unidad_base string, unidad_esperada string",
    ).withColumn("precio", F.col("precio_unitario"))
    for buffer in (0, 100_000):
        found = facts.fact_precio_item(frame, buffer_values=buffer).collect()
        assert {tuple(r)[:5] for r in found} == set(keys)
        assert {(r.precio_mediano, r.n_observaciones, r.n_eans) for r in found} == {(4.5, 30, 3)}
        medians = quantiles.exact_median(frame, ["cadena"], "precio", "m", buffer_values=buffer).collect()
        assert {(r.cadena, r.m, r.n) for r in medians} == {(None, 4.5, 30), ("X", 4.5, 90)}
    assert {(r.fecha, r.filas, r.eans) for r in diagnostics.volume_by_day(frame).collect()} == {(None, 30, 3), (day, 91, 4)}
    assert {(r.cadena, r.filas, r.eans) for r in diagnostics.concentration(frame).collect()} == {(None, 30, 3), ("X", 91, 4)}
    covered = {(r.categoria, r.filas, r.eans, r.precio_unitario_mediano) for r in diagnostics.coverage(frame).collect()}
    assert covered == {(None, 30, 3, 4.5), ("c", 91, 4, 4.5)}
    prices = [(d, None, "779", p) for d, p in ((day, 1.0), (datetime.date(2026, 7, 2), 9.0))]
    jumps = spark.createDataFrame(prices, "fecha date, cadena string, ean string, precio double").withColumn("descripcion", F.lit("T"))
    assert [(r.cadena, r.producto, r.antes, r.despues) for r in diagnostics.price_jumps(jumps).collect()] == [(None, "T", 1.0, 9.0)]
    assert diagnostics.jump_counts(jumps).first().saltos == 1 and Thresholds().fact_rows_min <= 30
