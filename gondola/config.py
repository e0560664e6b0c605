"""Thresholds of the cleaning, comparability and reporting rules."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    """Every limit used by the operators; ranges include both ends."""

    price_min: float = 1.0
    price_max: float = 5_000_000.0
    ean_length_min: int = 4
    ean_length_max: int = 14
    # Price over the median of its EAN and day; applied from outlier_min_rows up.
    outlier_ratio_min: float = 0.1
    outlier_ratio_max: float = 10.0
    outlier_min_rows: int = 5
    # A rule that discards more than this share of the rows reaching it is an error.
    max_discard_share: float = 0.20
    # Agreement band between the two sources of the package size.
    agreement_min: float = 0.95
    agreement_max: float = 1.05
    # Unit price over the reference price of its item.
    item_ratio_min: float = 0.35
    item_ratio_max: float = 3.0
    trusted_rows_min: int = 30
    fact_rows_min: int = 3
    chains_min: int = 3
    ranking_items_min: int = 10
    jump_min: float = 1.0
    gap_high: float = 60.0
    gap_medium: float = 30.0
    coverage_unit_pct: float = 80.0
    coverage_eans: int = 5


DEFAULTS = Thresholds()

# Rules in the order in which they are applied.
RULES = ("nulos", "ean_invalido", "precio_fuera_rango", "duplicados", "outliers")

# Columns of the raw tables: those a file must have, and those kept when present.
RAW_COLUMNS = {
    "productos": (
        ("id_comercio", "id_sucursal", "id_producto", "productos_descripcion",
         "productos_precio_lista"),
        ("id_bandera", "productos_ean", "productos_marca",
         "productos_cantidad_presentacion", "productos_unidad_medida_presentacion",
         "productos_precio_referencia", "productos_cantidad_referencia",
         "productos_unidad_medida_referencia"),
    ),
    "sucursales": (
        ("id_comercio", "id_sucursal", "sucursales_provincia"),
        ("id_bandera", "sucursales_nombre", "sucursales_tipo", "sucursales_localidad",
         "sucursales_latitud", "sucursales_longitud"),
    ),
    "comercio": (
        ("id_comercio", "comercio_razon_social"),
        ("id_bandera", "comercio_cuit", "comercio_bandera_nombre"),
    ),
}

# Columns of the clean table; the last six are optional in the raw files and null if absent.
CLEAN_COLUMNS = (
    "fecha", "id_comercio", "id_sucursal", "cadena", "provincia", "ean", "descripcion",
    "precio", "cantidad_base", "unidad_base", "precio_unitario", "fuente_tamano",
)
CLEAN_EXTRAS = (
    "productos_marca", "productos_cantidad_presentacion",
    "productos_unidad_medida_presentacion", "sucursales_localidad", "sucursales_latitud",
    "sucursales_longitud",
)
