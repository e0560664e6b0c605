"""Exact-size samples that a rerun draws again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def sample_rows(df: DataFrame, n: int, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """The `n` rows, or all if there are fewer, with the smallest hash of the seed and the keys
    (all columns, unless given), however the rows are partitioned.

    Each task keeps its n best, so nothing but those is shuffled and no row is counted first. Rows
    that agree in the keys follow each other in the order of all columns. A row's chance is n out of
    all rows, but rows with the same keys are drawn together."""
    named = list(keys or df.columns)
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in named]
    hashed = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return df.orderBy(hashed, *(F.col(f"`{c}`") for c in df.columns)).limit(n)


def discrepant(df: DataFrame) -> DataFrame:
    """Rows sized by a description in grams whose declared quantity is 1."""
    declared = F.col("productos_cantidad_presentacion").try_cast("double")
    return df.where(
        (F.col("fuente_tamano") == "descripcion")
        & F.col("descripcion").contains("GR")
        & (declared == 1)
    ).select(
        "descripcion", "cantidad_base", "unidad_base",
        F.col("productos_cantidad_presentacion").alias("cant_declarada"),
        F.col("productos_unidad_medida_presentacion").alias("uni_declarada"),
        F.round("precio", 0).alias("precio"),
        F.round("precio_unitario", 0).alias("precio_x_unidad"),
    )


def discrepant_cases(df: DataFrame, n: int = 12, seed: int = 42) -> DataFrame:
    """Some of them, drawn by their texts."""
    return sample_rows(discrepant(df), n, seed, ("descripcion", "cant_declarada", "uni_declarada"))
