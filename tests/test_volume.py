"""What is moved between tasks: joins, ordered writes and reads that need not grow with copies."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gondola import catalog, fixtures
from gondola.operators import diagnostics, quality
from gondola.operators.quantiles import exact_median
from gondola.plans import clean as clean_plan
from gondola.sources import archives, raw, shared, zips

DAY = dt.date(2026, 7, 24)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Forty line items of ten orders, five customers, four parts and three suppliers."""
    root = str(tmp_path_factory.mktemp("small"))

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    put("region", [(0, "ASIA")], "r_regionkey long, r_name string")
    put("nation", [(0, 0)], "n_nationkey long, n_regionkey long")
    put("customer", [(k, 0, "MN"[k % 2]) for k in range(5)], "c_custkey long, c_nationkey long, c_mktsegment string")
    put("orders", [(k, k % 5) for k in range(10)], "o_orderkey long, o_custkey long")
    put("part", [(k, f"red ring {k}", 5 + k, "B") for k in range(4)], "p_partkey long, p_name string, p_size int, p_brand string")
    put("supplier", [(k, 0, f"S{k}") for k in range(3)], "s_suppkey long, s_nationkey long, s_name string")
    put(
        "lineitem",
        [(k % 10, k % 4, k % 3, 1 + k // 10, 1.0 + k, 100.5 + k, "R", dt.datetime(1995 + k % 2, 3, 4)) for k in range(40)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_shipdate timestamp",
    )
    return root


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_items_move_for_two_joins_only(spark, small):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _plan(fixtures.raw_productos(spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # Line items and their orders, then their parts; the customers' join has orders only.
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert sum("hashpartitioning(l_" in line for line in moved) == 2
    assert sum("hashpartitioning(o_custkey" in line and "+- Exchange" in line for line in moved) <= 1
    first = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "l_partkey" in first and "o_custkey" not in first
    assert fixtures.raw_productos(spark, small).count() == 40


def test_landing_holds_the_listing_in_its_order(spark, small):
    lines = spark.read.text(catalog.write_landing(spark, small)).where("rol = 'productos'")
    found = lines.where(~F.col("value").startswith("id_comercio")).count()
    assert found == 40
    listing = fixtures.raw_listing(spark, small)
    assert not {"productos_descripcion", "productos_precio_lista"} & set(listing.columns)
    wanted = fixtures.raw_productos(spark, small)
    again = fixtures.productos(listing).drop("paquete")
    assert again.columns == wanted.columns and again.exceptAll(wanted).isEmpty()
    for day, merchant in ((dt.date(1995, 1, 1), "M"), (dt.date(1996, 1, 1), "N")):
        of_file = (F.col("fecha") == day) & (F.col("paquete") == merchant)
        texts = [
            r.value for r in lines.where(of_file).select("value", "_metadata.file_path", F.monotonically_increasing_id().alias("n"))
            .orderBy("file_path", "n").collect() if not r.value.startswith("id_comercio")
        ]
        rows = wanted.where((F.col("fecha") == day) & (F.col("id_comercio") == merchant)).orderBy("orden")
        assert [t.split("|")[1] for t in texts] == [r.id_sucursal for r in rows.collect()] and texts


def test_medians_of_eans_with_an_outlier_only(spark):
    """In 7791 the dearest is 12 times the cheapest, yet near the median; 7792 has an outlier."""
    prices = {"7791": [5.0, 30.0, 31.0, 32.0, 60.0], "7792": [5.0, 5.0, 5.0, 6.0, 60.0], "7793": [5.0] * 5}
    rows = [(DAY, ean, p) for ean, of in prices.items() for p in of]
    df = spark.createDataFrame(rows, "fecha date, ean string, precio double")
    assert [(r._ean, r._mediana) for r in quality.wide_medians(df).collect()] == [("7792", 5.0)]
    assert [(r.ean, r.precio) for r in quality.outlier_prices(df).collect()] == [("7792", 60.0)]


def test_raw_cardinality_reads_the_file_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [(k, "1", f"77{k % 3}" if k else None) for k in range(9)]
    spark.createDataFrame(rows, "orden long, productos_ean string, id_producto string").write.parquet(path)
    found = diagnostics.raw_cardinality(spark.read.parquet(path), 8)
    assert _plan(found).count("FileScan parquet") == 1
    assert [(r.campo, r.distintos, r.ejemplos) for r in found.collect()] == [
        ("id_producto", 3, ["770", "771", "772"]), ("productos_ean", 1, ["1"]),
    ]


def test_median_does_not_repeat_the_joins_behind_its_rows(spark):
    rows = spark.createDataFrame([(k % 2, float(k)) for k in range(9)], "k long, v double")
    joined = rows.join(spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string"), "k")
    found = exact_median(joined, ["name"], "v")
    assert "Join" not in _plan(found)
    assert sorted(tuple(r) for r in found.collect()) == [("a", 4.0, 5), ("b", 4.0, 4)]


def _joins(df):
    return [line for line in _plan(df).splitlines() if "Join" in line]


@pytest.fixture
def listings(monkeypatch):
    """Counts how often line items are joined to what they are listed with."""
    made, real = [], fixtures._listing
    monkeypatch.setattr(fixtures, "_listing", lambda *of: made.append(of) or real(*of))
    return made


def test_landing_joins_line_items_once(spark, small, listings):
    root = catalog.write_landing(spark, small)
    assert len(listings) == 1
    schema = "id_sucursal string, sucursales_provincia string, sucursales_localidad string"
    names = ["id_comercio", *[c.split()[0] for c in schema.split(", ")]]
    written = (
        spark.read.schema(f"id_comercio string, {schema}, fecha date, paquete string, rol string")
        .options(header=True, sep=";").csv(root).where("rol = 'sucursales'").select("fecha", *names)
    )
    wanted = fixtures.raw_sucursales(spark, small).select("fecha", *names)
    assert written.count() > 0 and sorted(map(tuple, written.collect())) == sorted(map(tuple, wanted.collect()))


def test_audit_joins_line_items_once(spark, small, listings):
    audited = catalog.Tables(spark, small).audited
    assert len(listings) == 1 and audited.count() == 40
    # Supplier 0 is a seventeenth one, which the branches lack.
    assert audited.where("id_sucursal <> '0' AND sucursales_localidad IS NULL").isEmpty()


def test_audit_moves_rows_without_their_sizes(spark, small):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    staged = catalog.materialize(clean_plan.typed(fixtures.raw_productos(spark, small)), "staged")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        audited = clean_plan.audit_staged(staged, fixtures.raw_sucursales(spark, small, staged), fixtures.raw_comercio(spark, small))
        joins = _joins(audited)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    of = ["productos_unidad_medida", "descripcion", "id_comercio", "id_sucursal", "ean"]
    assert len(joins) >= len(of) and all(name in line for name, line in zip(of, joins))
    assert {"precio", "ean", "descripcion", "cantidad_base", "cadena", "provincia", "descarte"} <= set(audited.columns)


def test_dedupe_reads_written_listings(spark, small):
    found = catalog.queries()["dedupe"](spark, small)
    assert "c_custkey" not in _plan(found) and "l_partkey = " not in _plan(found)
    keys = ["fecha", "id_comercio", "id_sucursal", "ean"]
    clean = fixtures.clean_prices(spark, small)
    wanted = clean.groupBy(*keys).agg(F.max_by("precio", "orden").alias("precio"))
    assert 0 < found.count() < 40 and found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_many_copies_are_marked_once(spark, monkeypatch):
    """Beyond the bound of what is sent to the rows they are written; null keys are keys."""
    rows = [(DAY, m, "1", e, 10.0 + k % 7, k) for k in range(60) for m, e in (("A", f"77900000{k % 20:05d}"), (None, "7790000099999"))]
    df = spark.createDataFrame(rows, "fecha date, id_comercio string, id_sucursal string, ean string, precio double, orden int")
    few = quality.annotate_rules(df)
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)
    many = quality.annotate_rules(df)
    assert len(_joins(few)) == 2 and len(_joins(many)) == 1
    for found in (few, many):
        assert sorted(r.orden for r in quality.kept(found).collect()) == [*range(40, 60), 59]
    assert sorted(r.orden for r in quality.keep_last(df).collect()) == [*range(40, 60), 59]


def test_rows_that_cannot_meet_a_key_are_not_moved(spark, monkeypatch):
    """Beyond the bound of what is sent to the rows; null keys are keys, also beside others."""
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 3)
    rows = [(DAY if k % 3 else None, f"{k % 400}" if k % 5 else None, float(k)) for k in range(2000)]
    df = catalog.materialize(spark.createDataFrame(rows, "fecha date, ean string, precio double"), "rows")
    keys = [(DAY, "7"), (DAY, None), (None, "9"), (None, None), (DAY, "none of them")]
    found = catalog.materialize(spark.createDataFrame([(*k, 1.0) for k in keys], "_fecha date, _ean string, v double"), "found")
    joined, few = quality._join_few(df, found, ("fecha", "ean"))
    assert not few and joined.columns == [*df.columns, *found.columns]
    wanted = df.join(found, quality._same(df, found, ("fecha", "ean")), "left")
    assert joined.where("v = 1").count() > 100
    assert joined.exceptAll(wanted).isEmpty() and wanted.exceptAll(joined).isEmpty()
    # Of both sides of the union one is moved: the rows whose key's bit is set.
    assert "Union" in _plan(joined) and _plan(joined).count("NOT coalesce") == 1


def _shuffle_files(spark):
    found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(k).getName() for k in range(found.size()) if "shuffle" in found.apply(k).getName()}


def test_audit_leaves_no_staged_rows_and_no_shuffles(spark, small, monkeypatch):
    made, real = [], shared.new_path
    monkeypatch.setattr(shared, "new_path", lambda *of, **named: made.append(real(*of, **named)) or made[-1])
    before = _shuffle_files(spark)
    rows = catalog.queries()["reglas_calidad"](spark, small)
    assert not _shuffle_files(spark) - before and rows.count() == 40
    assert [p.rsplit("/", 1)[1].split("-")[0] for p in made if Path(p).exists()] == ["audited"]
    # Of the order, what names a row.
    assert catalog.tables(spark, small).audited.schema["orden"].dataType.names == ["l_orderkey", "l_linenumber"]
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "snappy"


def test_cleaned_days_move_rows_without_their_order(spark, small, tmp_path, monkeypatch):
    stored, real = {}, clean_plan.materialize
    monkeypatch.setattr(clean_plan, "materialize", lambda df, name, **of: stored.setdefault(name, df) and real(df, name, **of))
    clean_plan.clean_days(spark, catalog.write_landing(spark, small), str(tmp_path), ignore_guardrail=True)
    assert "orden" not in stored["audited"].columns
    assert spark.read.parquet(f"{tmp_path}/calidad").agg(F.sum("filas_crudas")).first()[0] == 40


def test_joined_lines_keep_their_order(spark, tmp_path):
    """Blocks of a file lie in any order and are not joined with one another; odd lines stay."""
    lines = ["id_comercio|id_sucursal|id_producto|productos_descripcion|productos_precio_lista"]
    lines += [f"1|1|{k}|{'T' * (k % 90)}|{k}" if k % 50 else "" for k in range(1, 900)]
    rows = [("2026-07-24", "p", "productos.csv", n // 300, (n // 300, n), line) for n, line in enumerate(lines)]
    dealt = rows[600:] + rows[:300] + rows[300:600]
    schema = "dia string, paquete string, nombre string, bloque int, orden struct<a: int, b: int>, linea string"
    texts = zips.joined_lines(spark.createDataFrame(dealt, schema).coalesce(1))
    found = texts.orderBy("orden").collect()
    assert len(found) == 3 and [r.linea.split("\n") for r in found] == [lines[k : k + 300] for k in (0, 300, 600)]
    assert [tuple(r.orden) for r in found] == [(0, 0), (1, 300), (2, 600)]
    zips.write_days(texts, str(tmp_path / "zips"))
    files, _ = archives.expand_archives(spark, str(tmp_path / "zips"))
    assert [r.texto.split("\n") for r in files.collect()] == [lines]


def test_archives_and_unpacked_texts_leave_no_copies(spark, small, tmp_path, monkeypatch):
    made, real = [], shared.new_path
    for module in (shared, catalog):
        monkeypatch.setattr(module, "new_path", lambda *of, **named: made.append(real(*of, **named)) or made[-1])
    before = _shuffle_files(spark)
    with shared.spare_disk(spark):
        root = catalog.Tables(spark, small).archives
    assert [p for p in made if Path(p).exists()] == [root] and not _shuffle_files(spark) - before
    assert archives.unpack(spark, root, str(tmp_path / "out")).count() == 0
    left = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in made if Path(p).exists()]
    assert left == ["archives", "rejected-archives"]
    rows, _ = raw.read_role(spark, "productos", str(tmp_path / "out"))
    wanted = fixtures.raw_productos(spark, small).select("id_comercio", "id_sucursal", "id_producto", "productos_precio_lista")
    found = rows.select(*wanted.columns)
    assert found.count() == 40 and found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
