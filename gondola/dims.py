"""Static dimensions: the consumer basket, the unit aliases and the provinces."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class BasketItem(NamedTuple):
    item: str
    categoria: str
    incluye: str
    excluye: str | None
    unidad_base: str
    cantidad_mes: float


# The 27 basket items. Order matters, the first match wins.
BASKET = (
    BasketItem("Leche entera", "Lácteos", "LECHE.*ENTERA", "POLVO|CHOCOLAT|DESCREM|INFANT", "l", 30.0),
    BasketItem("Yogur bebible", "Lácteos", "YOGUR.*BEBIBLE", None, "kg", 6.0),
    BasketItem("Queso cremoso", "Lácteos", "QUESO.*CREMOSO", "UNTABLE|RALLADO", "kg", 1.5),
    BasketItem("Manteca", "Lácteos", "MANTECA", "MARGARINA|CACAO|MANI", "kg", 0.6),
    BasketItem("Pan lactal", "Panificados", "PAN.*LACTAL", None, "kg", 3.0),
    BasketItem("Harina 000", "Almacén", "HARINA.*(?:000|0000)", "LEUDANTE|INTEGRAL", "kg", 3.0),
    BasketItem("Fideos secos", "Almacén", "FIDEO", "FRESCO|SALSA|INSTANT", "kg", 3.0),
    BasketItem("Arroz largo fino", "Almacén", "ARROZ.*(?:LARGO|FINO)", "INTEGRAL|PARBOL", "kg", 3.0),
    BasketItem("Aceite girasol", "Almacén", "ACEITE.*GIRASOL", "OLIVA|MEZCLA|AEROSOL", "l", 2.5),
    BasketItem("Azúcar", "Almacén", "AZUCAR", "IMPALPABLE|ORGANIC|MASCABO", "kg", 2.0),
    BasketItem("Yerba mate", "Almacén", "YERBA", "COMPUESTA|SABORIZ", "kg", 2.0),
    BasketItem("Café molido", "Almacén", "CAFE.*(?:MOLIDO|TOSTADO)", "INSTANT|CAPSULA|SOLUBLE", "kg", 0.5),
    BasketItem("Puré de tomate", "Almacén", "(?:PURE|SALSA).*TOMATE", None, "kg", 2.0),
    BasketItem("Arvejas en lata", "Almacén", "ARVEJA", "SECA", "kg", 1.0),
    BasketItem("Atún en lata", "Almacén", "ATUN", None, "kg", 0.7),
    BasketItem("Huevos", "Frescos", "HUEVO", "CHOCOLATE|PASCUA|LIQUIDO", "un", 30.0),
    BasketItem("Papa", "Frutas y verduras", r"^PAPA\b", "CHIP|SNACK|FRITA|PURE", "kg", 8.0),
    BasketItem("Banana", "Frutas y verduras", "BANANA", "CHIP|DESHIDRAT", "kg", 4.0),
    BasketItem("Gaseosa cola", "Bebidas", "(?:COCA|GASEOSA).*COLA", "ZERO|LIGHT|SIN AZUCAR", "l", 9.0),
    BasketItem("Agua mineral", "Bebidas", "AGUA.*(?:MINERAL|SIN GAS)", "SABORIZ|TONICA", "l", 20.0),
    BasketItem("Cerveza", "Bebidas", "CERVEZA", "SIN ALCOHOL|0,0", "l", 4.0),
    BasketItem("Detergente", "Limpieza", "DETERGENTE", "ROPA|POLVO", "l", 1.5),
    BasketItem("Lavandina", "Limpieza", "LAVANDINA", "GEL", "l", 4.0),
    BasketItem("Jabón en polvo", "Limpieza", "JABON.*POLVO", None, "kg", 3.0),
    BasketItem("Papel higiénico", "Higiene", "PAPEL HIGIENICO", None, "un", 16.0),
    BasketItem("Shampoo", "Higiene", "SHAMPOO", "ACONDICIONADOR|2 EN 1", "l", 0.7),
    BasketItem("Pasta dental", "Higiene", "(?:PASTA|CREMA) DENTAL", "CEPILLO|ENJUAGUE", "kg", 0.27),
)

DIM_ITEM_SCHEMA = (
    "item string, categoria string, incluye string, excluye string, "
    "unidad_base string, cantidad_mes double"
)

# Unit aliases with their base unit and the factor that converts to it.
# Free text and UN/CEFACT Recommendation 20 codes occur in the same field.
UNIT_ALIASES = (
    ("kg", 0.001, "g gr grs grm gra gram gramo gramos"),
    ("kg", 1.0, "kg kgs kgr kilo kilos kilogramo kilogramos kgm"),
    ("kg", 0.000001, "mg miligramo miligramos"),
    ("l", 0.001, "ml mls mililitro mililitros cc cm3 cm³ mlt cmq"),
    ("l", 1.0, "l lt lts ltr ltrs litro litros"),
    ("l", 0.01, "clt cl"),
    ("l", 0.1, "dlt"),
    ("un", 1.0, "un u ud uds uni unid unidad unidades rollo rollos sobre sobres bolsa bolsas "
                "pack packs botella botellas lata latas paquete paquetes envase ea h87 pce pk ct"),
    ("un", 12.0, "docena docenas doc"),
)
HALF_DOZEN = ("media docena", "un", 6.0)

# Units of length, area or volume that have no base unit on purpose.
UNMAPPED_UNITS = ("m", "mt", "mtr", "m2", "mtk", "cm", "cmt", "m3", "mtq", "cu")

# ISO 3166-2 province codes.
PROVINCES = {
    "AR-A": "Salta", "AR-B": "Buenos Aires", "AR-C": "CABA", "AR-D": "San Luis",
    "AR-E": "Entre Ríos", "AR-F": "La Rioja", "AR-G": "Santiago del Estero",
    "AR-H": "Chaco", "AR-J": "San Juan", "AR-K": "Catamarca", "AR-L": "La Pampa",
    "AR-M": "Mendoza", "AR-N": "Misiones", "AR-P": "Formosa", "AR-Q": "Neuquén",
    "AR-R": "Río Negro", "AR-S": "Santa Fe", "AR-T": "Tucumán", "AR-U": "Chubut",
    "AR-V": "Tierra del Fuego", "AR-W": "Corrientes", "AR-X": "Córdoba",
    "AR-Y": "Jujuy", "AR-Z": "Santa Cruz",
}


def unit_map() -> dict[str, tuple[str, float]]:
    """Alias -> (base unit, factor)."""
    table = {
        alias: (base, factor)
        for base, factor, aliases in UNIT_ALIASES
        for alias in aliases.split()
    }
    alias, base, factor = HALF_DOZEN
    table[alias] = (base, factor)
    return table


def dim_item(spark: SparkSession, basket: tuple[BasketItem, ...] = BASKET) -> DataFrame:
    """The basket as a table, one row per item; a repeated item is an error."""
    names = [row.item for row in basket]
    if len(set(names)) != len(names):
        raise ValueError("the basket repeats an item")
    return spark.createDataFrame(list(basket), DIM_ITEM_SCHEMA)


def dim_unit(spark: SparkSession) -> DataFrame:
    """The unit aliases as a table: alias, unidad_base, factor."""
    rows = [(alias, base, factor) for alias, (base, factor) in unit_map().items()]
    return spark.createDataFrame(rows, "alias string, unidad_base string, factor double")
