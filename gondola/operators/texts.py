"""What a product description says: package size and basket item.

Descriptions repeat far more than they differ, so each distinct text is parsed once into a
written dictionary. Its real size decides how rows meet it: a broadcast below Spark's
threshold, a shuffled join above it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gondola.dims import BASKET, BasketItem
from gondola.functions.size import parse_size
from gondola.functions.text import plain_number, to_ascii, unit_clean
from gondola.functions.units import unit_of
from gondola.sources.shared import materialize


def item_of(
    description: Column, basket: Sequence[BasketItem] = BASKET, accent_insensitive: bool = False
) -> Column:
    """struct(item, categoria, unidad_esperada) of the first basket entry, in basket order,
    whose include pattern is found and whose exclude pattern is not; null if none."""
    text = to_ascii(description) if accent_insensitive else description
    position = None
    for number, entry in enumerate(basket, start=1):
        # (?U): \b must treat accented letters as letters.
        matches = text.rlike("(?U)" + entry.incluye)
        if entry.excluye:
            matches = matches & ~text.rlike("(?U)" + entry.excluye)
        position = (
            F.when(matches, number) if position is None else position.when(matches, number)
        )
    entries = F.array(
        *[
            F.struct(
                F.lit(e.item).alias("item"),
                F.lit(e.categoria).alias("categoria"),
                F.lit(e.unidad_base).alias("unidad_esperada"),
            )
            for e in basket
        ]
    )
    return F.try_element_at(entries, position)


def text_dictionary(
    df: DataFrame, basket: Sequence[BasketItem] = BASKET, accent_insensitive: bool = False
) -> DataFrame:
    """One row per distinct `descripcion`: cantidad_desc, unidad_desc, item, categoria,
    unidad_esperada (an action: the dictionary is written)."""
    parsed = (
        df.select("descripcion")
        .where(F.col("descripcion").isNotNull())
        .distinct()
        .select(
            "descripcion",
            parse_size(F.col("descripcion")).alias("_size"),
            item_of(F.col("descripcion"), basket, accent_insensitive).alias("_item"),
        )
        .select(
            "descripcion",
            F.col("_size.cantidad").alias("cantidad_desc"),
            F.col("_size.unidad").alias("unidad_desc"),
            "_item.*",
        )
    )
    return materialize(parsed, "texts")


UNIT_COLUMN = "productos_unidad_medida_presentacion"


def unit_dictionary(df: DataFrame) -> DataFrame:
    """One row per distinct unit text: its base unit and factor (an action)."""
    known = unit_of(unit_clean(F.col(UNIT_COLUMN)))
    found = df.select(UNIT_COLUMN).where(F.col(UNIT_COLUMN).isNotNull()).distinct().select(
        UNIT_COLUMN, known.alias("_u")
    )
    return materialize(
        found.select(UNIT_COLUMN, F.col("_u.unidad").alias("unidad_pres"), F.col("_u.factor").alias("_factor")),
        "units",
    )


def with_size(df: DataFrame, dictionary: DataFrame, unit_texts: DataFrame) -> DataFrame:
    """Package size and unit price. The description wins; the declared presentation fills
    what is missing, and `fuente_tamano` tells which one gave the quantity. The unit stays
    even if its quantity is missing."""
    number = plain_number(F.col("productos_cantidad_presentacion"))
    sizes = dictionary.select("descripcion", "cantidad_desc", "unidad_desc")
    return (
        df.join(sizes, "descripcion", "left")
        .join(unit_texts, UNIT_COLUMN, "left")
        .withColumn("_numero", number)
        .withColumn("cantidad_pres", F.when(F.col("_numero") > 0, F.col("_numero") * F.col("_factor")))
        .withColumn("cantidad_base", F.coalesce("cantidad_desc", "cantidad_pres"))
        .withColumn("unidad_base", F.coalesce("unidad_desc", "unidad_pres"))
        .withColumn(
            "fuente_tamano",
            F.when(F.col("cantidad_desc").isNotNull(), "descripcion")
            .when(F.col("cantidad_pres").isNotNull(), "presentacion"),
        )
        .withColumn("precio_unitario", F.try_divide("precio", "cantidad_base"))
        .drop("_numero", "_factor")
    )


def with_items(df: DataFrame, dictionary: DataFrame, basket_only: bool = False) -> DataFrame:
    """Adds item, categoria and unidad_esperada; null outside the basket."""
    names = dictionary.select("descripcion", "item", "categoria", "unidad_esperada")
    if basket_only:
        return df.join(names.where(F.col("item").isNotNull()), "descripcion")
    return df.join(names, "descripcion", "left")
