"""Delimited files of every dialect, and nested archives."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from gondola.sources import archives, landing, raw

CORE = "id_comercio|id_sucursal|id_producto|Productos Descripción|productos_precio_lista"


def _write(root, name, text):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


@pytest.fixture
def lake(tmp_path):
    root = tmp_path / "raw"
    _write(root, "2026-07-24/feed_1/productos.csv", "\n".join([
        CORE + "|productos_marca|otra",
        "1|10|779001|LECHE ENTERA 1L|1.380,00|ILOLAY|x",
        '1|10|779002|"CAFE | MOLIDO"|900|NA|x',          # quoted delimiter, missing text
        "1|10|779003|CORTA",                              # short: padded
        "1|10|779004|LARGA|1|2|3|4|5",                    # long: dropped
        "",
        "1|11|779001|REPETIDA|2|M|x",
    ]))
    _write(root, "2026-07-24/feed_2/Producto_b.csv", "\n".join([
        CORE.replace("|", ";"),
        "2;10;779005;ARROZ 1KG;12,5;",                    # one nameless field at the end
        "2;10;779006;AZUCAR;13;",
    ]))
    _write(root, "2026-07-25/c/productos.csv", b"\xef\xbb\xbf" + CORE.replace("|", ",").encode()
           + b"\n3,1,779007,YERBA \xd1,5\n")
    _write(root, "2026-07-25/d/productos.csv", "id_comercio\tid_producto\n4\t1\n")   # no core columns
    _write(root, "2026-07-25/c/sucursales.csv", "id_comercio,id_sucursal,sucursales_provincia\n3,1,AR-X\n")
    _write(root, "2026-07-25/c/comercio.csv", "id_comercio,comercio_razon_social\n3,COTO CICSA\n")
    _write(root, "docs/productos.csv", CORE + "\n9|9|9|9|9\n")
    _write(root, "2026-07-25/c/leame.csv", "nada\n")
    return str(root)


def test_discover(spark, lake):
    found = {(r["path"].split("/raw/")[1], r["rol"], str(r["fecha"])) for r in landing.discover(spark, lake).collect()}
    assert ("2026-07-24/feed_2/Producto_b.csv", "productos", "2026-07-24") in found
    assert ("2026-07-25/c/comercio.csv", "comercio", "2026-07-25") in found
    assert len(found) == 6 and not any("docs" in p or "leame" in p for p, _, _ in found)


def test_files_left_out_have_a_reason(spark, lake):
    found = {(r["path"].split("/raw/")[1], r["motivo"]) for r in landing.unplaced(spark, lake).collect()}
    assert found == {("docs/productos.csv", "no day folder"), ("2026-07-25/c/leame.csv", "unknown role")}


def test_an_unreadable_file_does_not_end_the_job(spark, lake):
    files = landing.discover(spark, lake)
    gone = files.where(F.col("path").contains("feed_2")).withColumn("path", F.concat("path", F.lit(".gone.csv")))
    rows, rejects = raw.read_role(spark, "productos", lake, files.union(gone))
    reasons = {r["path"].split("/raw/")[1]: r["motivo"] for r in rejects.collect()}
    assert reasons.pop("2026-07-24/feed_2/Producto_b.csv.gone.csv").startswith("unreadable: ")
    assert set(reasons) == {"2026-07-25/d/productos.csv"}
    assert rows.count() == raw.read_role(spark, "productos", lake)[0].count()


def test_read_productos(spark, lake):
    rows, rejects = raw.read_role(spark, "productos", lake)
    got = {
        (str(r["fecha"]), r["id_comercio"], r["id_producto"], r["productos_descripcion"],
         r["productos_precio_lista"], r["productos_marca"])
        for r in rows.collect()
    }
    assert got == {
        ("2026-07-24", "1", "779001", "LECHE ENTERA 1L", "1.380,00", "ILOLAY"),
        ("2026-07-24", "1", "779002", "CAFE | MOLIDO", "900", None),
        ("2026-07-24", "1", "779003", "CORTA", None, None),
        ("2026-07-24", "1", "779001", "REPETIDA", "2", "M"),
        ("2026-07-24", "2", "779005", "ARROZ 1KG", "12,5", None),
        ("2026-07-24", "2", "779006", "AZUCAR", "13", None),
        ("2026-07-25", "3", "779007", "YERBA �", "5", None),
    }
    assert "productos_unidad_medida_presentacion" in rows.columns
    bad = rejects.collect()
    assert len(bad) == 1 and bad[0]["path"].endswith("/d/productos.csv") and "id_sucursal" in bad[0]["motivo"]
    order = [r["id_producto"] for r in rows.where("id_comercio = '1'").orderBy("orden").collect()]
    assert order == ["779001", "779002", "779003", "779001"]


def test_other_roles_and_no_files(spark, lake, tmp_path):
    rows, _ = raw.read_role(spark, "comercio", lake)
    assert rows.first()["comercio_razon_social"] == "COTO CICSA"
    (tmp_path / "empty" / "2026-01-01").mkdir(parents=True)
    _write(tmp_path / "empty", "2026-01-01/x/otros.csv", "a\n")
    rows, rejects = raw.read_role(spark, "productos", str(tmp_path / "empty"))
    assert rows.isEmpty() and rejects.isEmpty() and "id_producto" in rows.columns


def test_header_names():
    assert landing.slug(" Productos Descripción ") == "productos_descripcion"
    assert landing.slug("¿Precio (lista)?") == "precio_lista"
    assert [landing.delimiter_of(h) for h in ("a,b;c;d", "a|b", "a\tb", "abc", "a,b;c")] == [";", "|", "\t", ",", ","]


def _zip(files):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in files.items():
            z.writestr(name, content)
    return buffer.getvalue()


def test_archives(spark, tmp_path, monkeypatch):
    # Small chunks, so that the file is cut in several pieces.
    monkeypatch.setattr(archives, "CHUNK_BYTES", 64)
    monkeypatch.setattr(archives, "PIECE_CHUNKS", 2)
    lines = [CORE] + [f"1|10|{n}|TEXTO {n}|{n},50" for n in range(1000, 1040)]
    inner = _zip({"productos.csv": "\n".join(lines), "comercio.csv": "id_comercio|comercio_razon_social\n1|COTO\n"})
    outer = _zip({
        "2026-07-24/feed_1_2026-07-24.zip": inner,
        "2026-07-24/roto_2026-13-45.zip": b"not a zip",
        "2026-07-23/vacio.zip": _zip({"nota.txt": "x"}),
    })
    _write(tmp_path, "zips/feed_2026-07-20.zip", outer)
    _write(tmp_path, "zips/feed_2026-07-21.zip", b"broken")
    files, rejects = archives.expand_archives(spark, str(tmp_path / "zips"))
    assert {(r["archivo"].rsplit("/")[-1], r["motivo"].split(":")[0]) for r in rejects.collect()} == {
        ("feed_2026-07-21.zip", "corrupt archive"), ("feed_2026-07-20.zip", "corrupt inner archive"),
    }
    dates = archives.content_date(files.select("archivo", "paquete", "nombre").distinct()).collect()
    assert [str(r["fecha"]) for r in dates] == ["2026-07-24"]

    out = str(tmp_path / "landing")
    archives.unpack(spark, str(tmp_path / "zips"), out)
    rows, _ = raw.read_role(spark, "productos", out)
    got = [(r["id_producto"], r["productos_precio_lista"]) for r in rows.orderBy("orden").collect()]
    assert got == [(str(n), f"{n},50") for n in range(1000, 1040)]
    assert rows.select(F.countDistinct("orden.archivo")).first()[0] > 1


def _day(count, name="productos.csv", first=1000):
    lines = [CORE] + [f"1|10|{n}|TEXTO {n}|{n}" for n in range(first, first + count)]
    return _zip({name: "\n".join(lines)})


def _codes(spark, out):
    rows, _ = raw.read_role(spark, "productos", out)
    return sorted(int(r["id_producto"]) for r in rows.collect())


def _spoiled(data, mark):
    """The archive with a byte of one member changed, so that its checksum fails."""
    at = data.index(mark) + len(mark) + 20
    return data[:at] + bytes([data[at] ^ 255]) + data[at + 1 :]


def test_one_archive_of_a_day_and_repeated_runs(spark, tmp_path):
    zips, out = str(tmp_path / "zips"), str(tmp_path / "landing")
    _write(tmp_path, "zips/a.zip", _zip({"2026-07-24/x é.zip": _day(10), "2026-07-24/x è.zip": _day(10, first=2000)}))
    _write(tmp_path, "zips/b.zip", _zip({"2026-07-24/x_2026-07-24.zip": _day(7, first=500)}))
    _write(tmp_path, "zips/undated.zip", _zip({"x.zip": _day(3), "otros.csv": "a"}))
    _write(tmp_path, "zips/z_2026-07-25.zip", _zip({"y.zip": _day(4, "nada.csv")}))
    rejects = archives.unpack(spark, zips, out).collect()
    # The dates of folders inside an archive's names count by their last part only.
    assert _codes(spark, out) == list(range(500, 507))
    reasons = {(r["archivo"].rsplit("/")[-1], r["motivo"]) for r in rejects}
    assert ("undated.zip", "no content date") in reasons and ("z_2026-07-25.zip", "unknown role") in reasons
    _write(tmp_path, "zips/c_2026-07-24.zip", _zip({"x é.zip": _day(2), "x è.zip": _day(2, first=2000)}))
    rejects = archives.unpack(spark, zips, out).collect()
    assert _codes(spark, out) == [1000, 1001, 2000, 2001]
    assert ("b.zip", "another archive has the same content date") in {(r["archivo"].rsplit("/")[-1], r["motivo"]) for r in rejects}


def test_failing_checksums_reject_the_whole(spark, tmp_path):
    good, bad_inner = _day(5), _spoiled(_day(3000, first=9000), b"productos.csv")
    _write(tmp_path, "zips/a_2026-07-24.zip", _zip({"g.zip": good, "h.zip": bad_inner}))
    outer = _zip({"g.zip": good, "k.zip": _zip({"productos.csv": CORE + "\n" + "1|1|7|T|1\n" * 5000})})
    _write(tmp_path, "zips/b_2026-07-25.zip", _spoiled(outer, b"k.zip"))
    out = str(tmp_path / "landing")
    rejects = archives.unpack(spark, str(tmp_path / "zips"), out).collect()
    assert _codes(spark, out) == list(range(1000, 1005))
    assert {(r["archivo"].rsplit("/")[-1], r["paquete"], r["motivo"].split(":")[0]) for r in rejects} == {
        ("a_2026-07-24.zip", "h.zip", "corrupt inner archive"), ("b_2026-07-25.zip", None, "corrupt archive"),
    }


def test_streamed_members_of_every_kind(spark, tmp_path):
    import zlib

    from gondola.sources import zips

    class Unseekable(io.BytesIO):
        def seek(self, *a):
            raise io.UnsupportedOperation

        tell = seek

    def streamed(files, method):
        out = Unseekable()
        with zipfile.ZipFile(out, "w", method) as z:
            for name, content in files.items():
                with z.open(name, "w", force_zip64=len(content) % 2 == 0) as f:
                    f.write(content)
        return out.getvalue()

    files = {"a/": b"", "é.csv": b"x,y\n" * 70_000, "b.csv": b"", "c.csv": b"1\r\n2", "d.txt": b"zz" * 999}
    stored = io.BytesIO()
    with zipfile.ZipFile(stored, "w", zipfile.ZIP_STORED) as z:
        for name, content in files.items():
            z.writestr(name, content)
    for data in (_zip(files), streamed(files, zipfile.ZIP_DEFLATED), stored.getvalue()):
        for step in (1, 7, 1 << 16):
            if step == 1 and len(data) > 5000:
                continue
            pieces = (data[k : k + step] for k in range(0, len(data), step))
            found = {n: b"".join(p) for n, p in zips.inner_members(zips._Bytes(pieces))}
            assert found == files
        for cut in (len(data) // 2, 40):
            with pytest.raises(zips.UNREADABLE):
                for _, p in zips.inner_members(zips._Bytes(iter([data[:cut]]))):
                    list(p)
    assert zlib.crc32(b"") == 0
    (tmp_path / "vacio").mkdir()
    spark.dataSource.register(zips.ZipSource)
    assert spark.read.format("packed_csv").load(str(tmp_path / "vacio")).count() == 0
    _write(tmp_path, "uno.zip", _zip({"p_2026-07-24.zip": _day(3), "q.csv": "a\nb"}))
    rows = spark.read.format("packed_csv").load(f"file:{tmp_path}/uno.zip").collect()
    assert {(r["paquete"], r["nombre"], r["texto"].count("\n")) for r in rows} == {("p_2026-07-24.zip", "productos.csv", 3), ("", "q.csv", 1)}
    assert rows[0]["archivo"] == f"file:{tmp_path}/uno.zip"


def test_a_large_member_is_not_held(tmp_path):
    import tracemalloc

    from gondola.sources import zips

    line = b"1|10|7791234567890|TEXTO LARGO DE UN PRODUCTO|1234,50\n"
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z, z.open("productos.csv", "w") as f:
        for _ in range(60):
            f.write(line * 20_000)  # 66 MB in all
    with zipfile.ZipFile(outer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("grande.zip", inner.getvalue())
    _write(tmp_path, "x.zip", outer.getvalue())
    reader = zips.ZipReader({"path": str(tmp_path)})
    (member,) = reader.partitions()
    tracemalloc.start()
    lines = sum(r[4].count("\n") + 1 for r in reader.read(member))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lines == 60 * 20_000 and peak < 12 << 20


def test_packed_days_come_back(spark, tmp_path):
    from gondola.sources import zips

    rows = [(f"2026-07-{20 + k % 3}", str(k % 4), "productos.csv", k, CORE if k < 12 else f"1|1|{k}|T|{k}") for k in range(600)]
    files = spark.createDataFrame(rows, "dia string, paquete string, nombre string, orden int, linea string").repartition(5)
    zips.write_days(files, str(tmp_path / "zips"))
    assert archives.unpack(spark, str(tmp_path / "zips"), str(tmp_path / "out")).count() == 0
    assert _codes(spark, str(tmp_path / "out")) == list(range(12, 600))
