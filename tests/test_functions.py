"""Table-driven cases of the column functions."""

import pytest
from pyspark.sql import functions as F

from gondola.functions import size, text, units

# Description, quantity and base unit that must result.
SIZES = [
    ("ACEITE GIRASOL 900 ML", 0.9, "l"),
    ("ACEITE OLIVA CAÑUELAS EXTRA VIRGEN SUAVE PET 500 ML", 0.5, "l"),
    ("FIDEO GUISERO 500 GR", 0.5, "kg"),
    ("HARINA 000 X 1 KG", 1.0, "kg"),
    ("HARINA 0000 X 1 KG", 1.0, "kg"),
    ("YOGUR PACK 2 X 1 L", 2.0, "l"),
    ("GASEOSA 6 X 500 ML", 3.0, "l"),
    ("FIDEOS MATARAZZO TALLARIN N5 X500G PAQ-500-GR.", 0.5, "kg"),
    ("FIDEOS LUCCHETTI TIRABUZON N28 X500G", 0.5, "kg"),
    ("FIDEOS MATARAZZO PENNE RIGATE N45 X500G PAQ-0.5-KG", 0.5, "kg"),
    ("FIDEOS MOSTACHOL BULNEZ PAQUETE X 500 GRS", 0.5, "kg"),
    ("FIDEOS SECOS PAMPERITOS BULNEZ 500 GRS", 0.5, "kg"),
    ("ARROZ LARGO FINO 1KG", 1.0, "kg"),
    ("GASEOSA COLA 2.25 LTS", 2.25, "l"),
    ("GASEOSA COLA 2,25 LTS", 2.25, "l"),
    ("CERVEZA PACK X 6 X 473 ML", 2.838, "l"),
    ("CERVEZA RUBIA BARRIL 50 LTS", 50.0, "l"),
    ("PAPA NEGRA POR KG", 1.0, "kg"),
    ("CARNE PICADA COMUN POR KG", 1.0, "kg"),
    ("HUEVO BLANCO DOCENA", 12.0, "un"),
    ("PAPEL HIGIENICO 4 UNIDADES", 4.0, "un"),
    ("LECHE ENTERA LA SERENISIMA SACHET 1L", 1.0, "l"),
    ("MANTECA 200 GR", 0.2, "kg"),
    ("CREMA DENTAL 90 GR", 0.09, "kg"),
    ("YERBA MATE ELABORADA 1 KG", 1.0, "kg"),
    ("PRESERVATIVOS", None, None),
    ("FIBRA ESPONJA LISA TASK", None, None),
    ("", None, None),
    # Stage order and the edges between stages.
    ("MEDIA DOCENA HUEVOS", 6.0, "un"),
    ("HUEVOS 1 DOCENA", 12.0, "un"),
    ("X 0 GR POR KG", 1.0, "kg"),
    ("JABON 12 CM³", 0.012, "l"),
    ("200 X 5 GR", 0.005, "kg"),
    ("2 X 3 KG 4 X 5 KG", 20.0, "kg"),
    ("   ", None, None),
    (None, None, None),
]


def _column(spark, values, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").repartition(3)
    return [r[1] for r in df.select("i", expr(F.col("v"))).orderBy("i").collect()]


def test_sizes(spark):
    found = _column(spark, [case[0] for case in SIZES], size.parse_size)
    for (description, quantity, unit), got in zip(SIZES, found):
        if quantity is None:
            assert got is None, description
        else:
            assert got is not None, description
            assert got["unidad"] == unit and got["cantidad"] == pytest.approx(quantity, abs=1e-9), description


CASES = [
    (text.to_number, {
        "1.234,56": 1234.56, "1,234.56": 1234.56, "$ 1234": 1234.0, "12,5": 12.5,
        "1.234": 1.234, "1.234.567": None, "1,234,567": None, "1.234.567,89": 1234567.89,
        "1,234,567.89": 1234567.89, "": None, "-5": -5.0, "12-5": None, "-": None,
        "5.": 5.0, ".5": 0.5, "1e5": 15.0, None: None,
    }),
    (text.ean_norm, {"0000002674407": "2674407", "77-91 x": "7791", "000": "", "abc": "", None: None}),
    (text.desc_norm, {"\t café molido ": "CAFÉ MOLIDO", None: None}),
    (text.unit_clean, {"cm³": "cm3", "gr.": "gr", " Kg ": "kg", "media   docena": "media docena",
                       "Nº": "no", "½ l": "12 l", "l t": "l t", "": "", None: None}),
    (units.unit_base, {"GRS.": "kg", "LTS": "l", "KGM": "kg", "ea": "un", "pieza": None, "m2": None}),
    (units.unit_factor, {"gr": 0.001, "cl": 0.01, "docena": 12.0, "media docena": 6.0, "mt": None}),
    (text.province_name, {"AR-X": "Córdoba", " ar-c ": "CABA", "entre ríos": "Entre Ríos",
                          "o'higgins": "O'Higgins", "sin_dato": "Sin dato", None: "Sin dato",
                          "AR-I": "Ar-I", "": ""}),
    (text.plain_number, {"1000": 1000.0, " 2.5 ": 2.5, "1,5": None, "1d": None, "1e3": 1000.0,
                         "inf": None, "": None, None: None}),
]


@pytest.mark.parametrize("function, cases", CASES, ids=[c[0].__name__ for c in CASES])
def test_scalar(spark, function, cases):
    assert _column(spark, list(cases), function) == list(cases.values())


def test_presentation_size(spark):
    df = spark.createDataFrame(
        [(0, "1000", "cm3"), (1, "0", "kg"), (2, "-1", "kg"), (3, "x", "kg"), (4, "2", "pieza"), (5, None, "GR")],
        "i int, q string, u string",
    )
    got = [
        tuple(r[0]) for r in
        df.orderBy("i").select(units.presentation_size(F.col("q"), F.col("u"))).collect()
    ]
    assert got == [(1.0, "l"), (None, "kg"), (None, "kg"), (None, "kg"), (None, None), (None, "kg")]


def test_names_dates_bands(spark):
    row = spark.range(1).select(
        text.chain_name(F.lit(None).cast("string"), F.lit(" Coto cicsa ")).alias("legal"),
        text.chain_name(F.lit("vea"), F.lit("x")).alias("banner"),
        text.chain_name(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("none"),
        text.date_text(F.lit("2026-07-05").cast("date")).alias("d"),
        text.date_text(F.lit("2026-07-05").cast("date"), with_year=False).alias("dm"),
        *[text.gap_band(F.lit(float(v))).alias(f"g{v}") for v in (61, 60, 31, 30)],
        text.json_safe(F.lit(float("nan"))).alias("nan"),
        text.json_safe(F.lit(float("-inf"))).alias("inf"),
        text.json_safe(F.lit(1.5)).alias("ok"),
    ).first()
    assert tuple(row) == ("COTO CICSA", "VEA", "SIN_IDENTIFICAR", "05/07/2026", "05/07",
                          "alto", "medio", "medio", "bajo", None, None, 1.5)
