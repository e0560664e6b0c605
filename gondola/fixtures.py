"""The driver's retail tables seen as price listings, raw and clean.

`clean_prices` gives the clean table of the price pipeline; `raw_tables` gives the three raw
text tables with the kinds of dirt the pipeline has to cope with, built from integer columns
so that the right answer is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table stored in fewer pieces than there are cores is spread over them by a key; a
    table of many files is read as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its customer's segment and region and its part."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate",
    )
    lines = spread(lines, "l_orderkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    places = customers.join(
        nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")),
        F.col("c_nationkey") == F.col("n_nationkey"),
    ).select("c_custkey", "c_mktsegment", "r_name")
    # Orders, fewer and narrower than line items, meet their customers first: once neither
    # side is small enough to be sent whole, line items are moved for two joins, not three.
    placed = orders.join(places, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    return (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )


def _date() -> Column:
    return F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1))


ORDER = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate")


def _order() -> Column:
    return F.struct(*ORDER)


def _noun() -> Column:
    return F.split_part("p_name", F.lit(" "), F.lit(2))


def _part_text() -> Column:
    """A description whose package size is written in six different ways."""
    name, size = F.upper("p_name"), F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 6
    text = (
        F.when(kind == 0, F.concat(name, F.lit(" X "), size, F.lit("0 GR")))
        .when(kind == 1, F.concat(name, F.lit(" PACK X 6 X "), size, F.lit(" CC")))
        .when(kind == 2, F.concat(name, F.lit(" "), size, F.lit(",5 KG")))
        .when(kind == 3, F.concat(name, F.lit(" POR KG")))
        .when(kind == 4, F.concat(name, F.lit(" N"), size, F.lit(" DOCENA")))
        .otherwise(name)
    )
    offer = (
        F.when(F.col("l_returnflag") == "R", " - OFERTA")
        .when(F.col("l_returnflag") == "N", " - PROMO")
        .otherwise("")
    )
    return F.concat(text, offer)


def clean_prices(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    """Clean table, plus `item`, `categoria` and `unidad_esperada` (the part name and its
    noun stand in for the basket; only the noun when coarse) and `orden`, the position within
    the source."""
    line = F.col("l_linenumber")
    sized = line != 7
    return _listing(spark, sf_dir).select(
        _date().alias("fecha"),
        F.col("c_mktsegment").alias("id_comercio"),
        F.col("l_suppkey").cast("string").alias("id_sucursal"),
        F.col("c_mktsegment").alias("cadena"),
        F.col("r_name").alias("provincia"),
        (F.lit(7790000000000) + F.col("l_partkey")).cast("string").alias("ean"),
        _part_text().alias("descripcion"),
        F.col("l_extendedprice").alias("precio"),
        F.when(sized, F.col("l_quantity")).alias("cantidad_base"),
        F.when(line == 6, "un").when(sized, "kg").alias("unidad_base"),
        F.when(sized, F.col("l_extendedprice") / F.col("l_quantity")).alias("precio_unitario"),
        F.when(line <= 4, "descripcion").when(sized, "presentacion").alias("fuente_tamano"),
        F.col("p_brand").alias("productos_marca"),
        F.when(line <= 3, "1").when(sized, F.col("l_quantity").cast("int").cast("string"))
        .alias("productos_cantidad_presentacion"),
        _unit_text().alias("productos_unidad_medida_presentacion"),
        (_noun() if coarse else F.col("p_name")).alias("item"),
        _noun().alias("categoria"),
        F.lit("kg").alias("unidad_esperada"),
        _order().alias("orden"),
    )


# Unit texts as chains write them, mapped, unmapped and ignored ones.
UNIT_TEXTS = ("gr", "Kg", "cm³", "LTS", "gr.", "unidad", "pieza", "m2", "KGM", "ea",
              "MEDIA  docena", "cl")


def _unit_text() -> Column:
    texts = F.array(*[F.lit(t) for t in UNIT_TEXTS])
    return F.element_at(texts, (F.col("l_suppkey") % len(UNIT_TEXTS) + 1).cast("int"))


def dim_items(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    """The part names as basket: item, categoria, unidad_base, cantidad_mes."""
    return (
        read(spark, sf_dir, "part")
        .select((_noun() if coarse else F.col("p_name")).alias("item"), _noun().alias("categoria"))
        .distinct()
        .select(
            "item", "categoria", F.lit("kg").alias("unidad_base"),
            (1 + F.length("item") % 5).cast("double").alias("cantidad_mes"),
        )
    )


# Shelf texts, most of them of the basket, some excluded from it or outside it.
SHELF = (
    "LECHE ENTERA", "LECHE ENTERA EN POLVO", "YOGUR BEBIBLE FRUTILLA", "QUESO CREMOSO",
    "QUESO CREMOSO UNTABLE", "MANTECA", "MANTECA DE MANI", "PAN LACTAL BLANCO", "HARINA 000",
    "HARINA 0000 LEUDANTE", "FIDEO GUISERO", "FIDEO FRESCO", "ARROZ LARGO FINO",
    "ARROZ INTEGRAL LARGO", "ACEITE GIRASOL", "ACEITE GIRASOL Y OLIVA", "AZUCAR COMUN",
    "AZUCAR MASCABO", "YERBA MATE", "CAFE MOLIDO", "CAFE INSTANTANEO", "PURE DE TOMATE",
    "ARVEJA SECA", "ARVEJAS", "ATUN AL NATURAL", "HUEVO BLANCO", "HUEVO CHOCOLATE", "PAPA NEGRA",
    "PAPA FRITA", "PAPAÑA", "BANANA ECUADOR", "COCA COLA", "GASEOSA COLA ZERO",
    "AGUA MINERAL SIN GAS", "CERVEZA RUBIA", "CERVEZA SIN ALCOHOL", "DETERGENTE LIMON",
    "LAVANDINA", "JABON EN POLVO", "PAPEL HIGIENICO", "SHAMPOO 2 EN 1", "SHAMPOO NEUTRO",
    "CREMA DENTAL", "PASTA DENTAL ENJUAGUE", "TELEVISOR LED", "CEMENTO", "CAFÉ MOLIDO",
)


def _shelf_text() -> Column:
    """A shelf text by part and a package size in seven notations, in mixed case and padded."""
    phrase = F.element_at(
        F.array(*[F.lit(t) for t in SHELF]), (F.col("p_partkey") % len(SHELF) + 1).cast("int")
    )
    size = F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 7
    ending = (
        F.when(kind == 0, F.concat(F.lit(" "), size, F.lit("0 GR")))
        .when(kind == 1, F.concat(F.lit(" X "), size, F.lit(" X 500 ML")))
        .when(kind == 2, F.concat(F.lit(" "), size, F.lit(",5 KG")))
        .when(kind == 3, " POR KG")
        .when(kind == 4, F.concat(F.lit(" N"), size, F.lit(" DOCENA")))
        .when(kind == 5, " MEDIA DOCENA")
        .otherwise("")
    )
    text = F.concat(phrase, ending)
    return F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("  "), F.lower(text), F.lit(" "))).otherwise(text)


def cents() -> Column:
    """The list price in cents with the dirt of a price feed: zeros and shifted commas."""
    exact = F.round(F.col("l_extendedprice") * 100).cast("long")
    return (
        F.when(F.col("l_orderkey") % 211 == 0, F.lit(0).cast("long"))
        .when(F.col("l_orderkey") % 307 == 0, exact * 100)
        .otherwise(exact)
    )


def _price_text() -> Column:
    """The price as text in three notations; some rows have no number at all."""
    pesos, rest = F.floor(F.col("_cents") / 100), F.lpad((F.col("_cents") % 100).cast("string"), 2, "0")
    form = F.col("l_linenumber") % 3
    grouped = F.translate(F.format_number(pesos, 0), ",", ".")
    return (
        F.when(F.col("l_orderkey") % 401 == 0, "S/D")
        .when(form == 0, F.concat(grouped, F.lit(","), rest))
        .when(form == 1, F.concat(pesos.cast("string"), F.lit("."), rest))
        .otherwise(F.concat(F.lit("$ "), pesos.cast("string"), F.lit(","), rest))
    )


def _code_text() -> Column:
    code = (F.lit(7790000000000) + F.col("l_partkey")).cast("string")
    return (
        F.when(F.col("l_orderkey") % 101 == 0, "0")
        .when(F.col("l_orderkey") % 103 == 0, "AB-12")
        .when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("000"), code))
        .otherwise(code)
    )


def raw_productos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product listings, all text, with `fecha` and `orden` as the raw reader adds them."""
    return productos(raw_listing(spark, sf_dir)).drop("paquete")


def raw_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items that `productos` writes as text, with `fecha` and `paquete`, the merchant.
    Narrower than their text: what moves rows moves these. `ORDER` is their source order."""
    return _listing(spark, sf_dir).select(
        _date().alias("fecha"), F.col("c_mktsegment").alias("paquete"), *ORDER,
        "l_partkey", "l_suppkey", "p_size", "p_brand",
    )


def productos(listing: DataFrame) -> DataFrame:
    return listing.withColumns({"_cents": cents(), "p_partkey": F.col("l_partkey")}).select(
        "fecha", "paquete",
        _order().alias("orden"),
        F.col("paquete").alias("id_comercio"),
        F.col("l_suppkey").cast("string").alias("id_sucursal"),
        _code_text().alias("id_producto"),
        F.lit("1").alias("productos_ean"),
        _shelf_text().alias("productos_descripcion"),
        _price_text().alias("productos_precio_lista"),
        F.col("p_brand").alias("productos_marca"),
        F.when(F.col("l_linenumber") < 7, F.col("l_quantity").cast("int").cast("string"))
        .alias("productos_cantidad_presentacion"),
        _unit_text().alias("productos_unidad_medida_presentacion"),
    )


def raw_sucursales(spark: SparkSession, sf_dir: str, listed: DataFrame | None = None) -> DataFrame:
    """Branches per day and merchant, with province codes and a later copy that must lose.
    Every seventeenth supplier is missing. `listed`: the raw product listings, if they are stored
    already, so that line items are not joined anew for their branches."""
    rows = raw_productos(spark, sf_dir) if listed is None else listed
    seen = rows.select("fecha", "id_comercio", "id_sucursal").distinct()
    suppliers = read(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 17 != 0)
    both = seen.join(suppliers, F.col("id_sucursal") == F.col("s_suppkey").cast("string"))
    code = F.concat(F.lit("AR-"), F.char(F.col("s_nationkey") + 65))
    branch = both.select(
        "fecha", "id_comercio", "id_sucursal",
        F.explode(F.array(F.struct(F.lit(0).alias("orden"), code.alias("provincia")),
                          F.struct(F.lit(1).alias("orden"), F.lit("AR-B").alias("provincia")))).alias("v"),
        F.col("s_name").alias("sucursales_localidad"),
    )
    return branch.select(
        "fecha", "id_comercio", "id_sucursal", F.col("v.orden").alias("orden"),
        F.col("v.provincia").alias("sucursales_provincia"), "sucursales_localidad",
    )


def raw_comercio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants per day: one has no banner name and one is missing."""
    name = F.col("c_mktsegment")
    dates = read(spark, sf_dir, "lineitem").select(_date().alias("fecha")).distinct()
    merchants = (
        read(spark, sf_dir, "customer").select("c_mktsegment").distinct()
        .where(name != "MACHINERY")
        .agg(F.collect_set("c_mktsegment").alias("_names"))
    )
    listed = dates.select("fecha", F.explode(merchants.scalar()).alias("c_mktsegment"))
    return listed.select(
        "fecha", F.lit(0).alias("orden"), name.alias("id_comercio"),
        F.concat(name, F.lit(" S.A.")).alias("comercio_razon_social"),
        F.when(name != "BUILDING", F.concat(F.lit(" "), F.lower(name))).alias("comercio_bandera_nombre"),
    )
