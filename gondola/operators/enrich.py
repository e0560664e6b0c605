"""Names and places: product rows meet their branch and their chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gondola.functions.text import NO_CHAIN, NO_PROVINCE, chain_name, province_name
from gondola.sources.shared import materialize

PLACE_COLUMNS = ("sucursales_localidad", "sucursales_latitud", "sucursales_longitud")
BRANCH_COLUMNS = ("sucursales_provincia", *PLACE_COLUMNS)
CHAIN_COLUMNS = ("comercio_razon_social", "comercio_bandera_nombre")


def _first_per_key(df: DataFrame, keys: list[str], columns: tuple[str, ...]) -> DataFrame:
    """The first source row of every key, by aggregation: copies shrink before the shuffle."""
    present = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    first = F.min_by(F.struct(*present), F.col("orden"))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")


def branches(sucursales: DataFrame) -> DataFrame:
    """fecha, id_comercio, id_sucursal, provincia and place columns, written, so that its real
    size decides how product rows meet it. Names are made here, once per branch."""
    first = _first_per_key(sucursales, ["fecha", "id_comercio", "id_sucursal"], BRANCH_COLUMNS)
    named = first.withColumn("provincia", province_name(F.col("sucursales_provincia")))
    return materialize(named.drop("sucursales_provincia"), "branches")


def chains(comercios: DataFrame) -> DataFrame:
    """fecha, id_comercio, cadena, written."""
    first = _first_per_key(comercios, ["fecha", "id_comercio"], CHAIN_COLUMNS)
    named = first.withColumn(
        "cadena", chain_name(F.col("comercio_bandera_nombre"), F.col("comercio_razon_social"))
    )
    return materialize(named.drop(*CHAIN_COLUMNS), "chains")


def enrich(
    df: DataFrame, sucursales: DataFrame | None, comercios: DataFrame | None
) -> DataFrame:
    """Adds `cadena`, `provincia` and the place columns by day, merchant and branch. Rows
    without a match are kept. Both tables carry `fecha` and `orden`."""
    if sucursales is not None:
        df = df.join(branches(sucursales), ["fecha", "id_comercio", "id_sucursal"], "left")
    if comercios is not None:
        df = df.join(chains(comercios), ["fecha", "id_comercio"], "left")
    for name in ("provincia", "cadena", *PLACE_COLUMNS):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    return df.fillna({"cadena": NO_CHAIN, "provincia": NO_PROVINCE})
