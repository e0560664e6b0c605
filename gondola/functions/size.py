"""Package size written in a product description, as one native expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gondola.dims import HALF_DOZEN, unit_map
from gondola.functions.text import strip, unit_clean
from gondola.functions.units import unit_of

# Longest first, so that KGS is never read as KG followed by an S.
_ALIASES = "|".join(
    sorted((a.upper() for a in unit_map() if a != HALF_DOZEN[0]), key=len, reverse=True)
)
_NUMBER = r"(\d+(?:[.,]\d+)?)"

# Fixed patterns. The look-behind keeps the cut number of pasta ("N28 X500G") from being read
# as a multiplier. (?U) gives \s, \d and \b their Unicode meaning.
MULTIPACK = rf"(?U)(?<![A-Z0-9]){_NUMBER}\s*[X*]\s*{_NUMBER}\s*({_ALIASES})(?![A-Z])"
SIMPLE = rf"(?U){_NUMBER}\s*({_ALIASES})(?![A-Z])"
BULK = rf"(?U)\b(?:POR|AL|X|PRECIO)\s+({_ALIASES})(?![A-Z])"
WORD = r"(?U)\b(DOCENA|MEDIA DOCENA|UNIDAD)\b"

MULTIPLIER_MIN, MULTIPLIER_MAX = 2, 100


def _let(value: Column, body) -> Column:
    """Evaluate a value once and use it several times."""
    return F.transform(F.array(value), body)[0]


def _double(text: Column) -> Column:
    return F.translate(text, ",", ".").try_cast("double")


def _amount(number: Column, alias: Column) -> Column:
    return F.struct(number.alias("numero"), alias.alias("alias"))


def _positive(amount: Column) -> Column:
    return _let(amount, lambda a: F.when(a["numero"] > 0, a))


def _multipack(text: Column) -> Column:
    """The last match whose multiplier is in range and whose size is positive."""
    found = F.transform(
        F.regexp_extract_all(text, F.lit(MULTIPACK), F.lit(0)),
        lambda m: F.struct(
            _double(F.regexp_extract(m, MULTIPACK, 1)).alias("veces"),
            _double(F.regexp_extract(m, MULTIPACK, 2)).alias("numero"),
            F.regexp_extract(m, MULTIPACK, 3).alias("alias"),
        ),
    )
    valid = F.filter(
        found,
        lambda m: m["veces"].between(MULTIPLIER_MIN, MULTIPLIER_MAX) & (m["numero"] > 0),
    )
    return _let(
        F.try_element_at(valid, F.lit(-1)),
        lambda m: F.when(m.isNotNull(), _amount(m["veces"] * m["numero"], m["alias"])),
    )


def _simple(text: Column) -> Column:
    """The last match only; if its size is zero no earlier match is tried."""
    last = F.try_element_at(F.regexp_extract_all(text, F.lit(SIMPLE), F.lit(0)), F.lit(-1))
    return _let(
        last,
        lambda m: _positive(
            _amount(_double(F.regexp_extract(m, SIMPLE, 1)), F.regexp_extract(m, SIMPLE, 2))
        ),
    )


def _first(text: Column, pattern: str) -> Column:
    """The first match, taken as one unit of its alias."""
    return _let(
        F.regexp_extract(text, pattern, 1), lambda m: F.when(m != "", _amount(F.lit(1.0), m))
    )


def parse_size(description: Column) -> Column:
    """struct(cantidad, unidad) in base units, or null. The stages are tried in order and a
    later one runs only where the earlier ones found nothing."""
    text = F.upper(description)
    size = F.coalesce(_multipack(text), _simple(text), _first(text, BULK), _first(text, WORD))
    with_unit = _let(
        size,
        lambda s: F.struct(s["numero"].alias("numero"), unit_of(unit_clean(s["alias"])).alias("u")),
    )
    return F.when(
        strip(description) != "",
        _let(
            with_unit,
            lambda s: F.when(
                s["u"].isNotNull(),
                F.struct(
                    (s["numero"] * s["u"]["factor"]).alias("cantidad"),
                    s["u"]["unidad"].alias("unidad"),
                ),
            ),
        ),
    )
