"""Units of measure: alias look-up and declared package sizes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gondola.dims import UNMAPPED_UNITS, unit_map
from gondola.functions.text import plain_number, unit_clean


def _lookup() -> Column:
    entries = ", ".join(
        f"'{alias}', named_struct('unidad', '{base}', 'factor', {factor!r}D)"
        for alias, (base, factor) in unit_map().items()
    )
    return F.expr(f"map({entries})")


def unit_of(clean_text: Column) -> Column:
    """struct(unidad, factor) of an already cleaned unit text, null if unknown."""
    return F.try_element_at(_lookup(), clean_text)


def unit_base(text: Column) -> Column:
    return unit_of(unit_clean(text))["unidad"]


def unit_factor(text: Column) -> Column:
    return unit_of(unit_clean(text))["factor"]


def unit_known(clean_text: Column) -> Column:
    return clean_text.isin(list(unit_map()))


def unit_ignored(clean_text: Column) -> Column:
    """Units left unmapped on purpose."""
    return clean_text.isin(list(UNMAPPED_UNITS))


def presentation_size(quantity: Column, unit: Column) -> Column:
    """struct(cantidad, unidad) in base units. The unit survives a missing quantity; a
    quantity that is not a positive number is null."""
    found = unit_of(unit_clean(unit))
    number = plain_number(quantity)
    return F.struct(
        F.when(number > 0, number * found["factor"]).alias("cantidad"),
        found["unidad"].alias("unidad"),
    )
