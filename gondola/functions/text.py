"""Text normalisation: numbers, codes, names, dates and bands."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from gondola.config import DEFAULTS, Thresholds
from gondola.dims import PROVINCES

NO_CHAIN = "SIN_IDENTIFICAR"
NO_PROVINCE = "Sin dato"

# Spark's trim removes only blanks by default; this is the Unicode white space set.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def to_number(text: Column) -> Column:
    """Price text to double. With both separators the last is the decimal one; a lone kind
    of separator is decimal; whatever does not parse then is null."""
    digits = F.regexp_replace(text, r"[^\d,.\-]", "")
    comma = F.instr(F.reverse(digits), ",")
    dot = F.instr(F.reverse(digits), ".")
    decimal_comma = (comma > 0) & ((dot == 0) | (comma < dot))
    plain = F.when(
        decimal_comma, F.translate(F.replace(digits, F.lit("."), F.lit("")), ",", ".")
    ).otherwise(F.replace(digits, F.lit(","), F.lit("")))
    return plain.try_cast("double")


def plain_number(text: Column) -> Column:
    """Decimal text to double, null unless it is a plain number (Java suffixes are refused)."""
    clean = strip(text)
    return F.when(
        clean.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), clean.try_cast("double")
    )


def ean_norm(code: Column) -> Column:
    """Digits only, without the leading zeros each chain pads differently."""
    return F.regexp_replace(F.regexp_replace(code, r"\D", ""), "^0+", "")


def desc_norm(text: Column) -> Column:
    return F.upper(strip(text))


def _ascii_table() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters whose compatibility decomposition is ASCII, as translate() arguments, and
    the fractions, which decompose to several characters."""
    src, dst, long = [], [], []
    for code in [*range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2100)]:
        char = chr(code)
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            src.append(char)
            dst.append(plain)
        elif len(plain) > 1 and char in "¼½¾":
            long.append((char, plain))
    return "".join(src), "".join(dst), long


_ACCENTED, _PLAIN, _FRACTIONS = _ascii_table()


def to_ascii(text: Column) -> Column:
    """Accents dropped, superscripts to digits; other non-ASCII characters removed."""
    for char, plain in _FRACTIONS:
        text = F.replace(text, F.lit(char), F.lit(plain))
    return F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"[^\x00-\x7f]", "")


def unit_clean(text: Column) -> Column:
    """Unit text as used for look-up: ASCII, lower case, letters, digits and single blanks."""
    kept = F.regexp_replace(F.lower(strip(to_ascii(text))), "[^a-z0-9 ]+", "")
    return F.trim(F.regexp_replace(kept, " +", " "))


def title_case(text: Column) -> Column:
    """Upper case after every non-letter, as in O'Higgins (initcap splits on blanks only)."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))),
        "",
    )


def province_name(code: Column) -> Column:
    """ISO code to name; unknown text in title case; missing to 'Sin dato'."""
    key = F.upper(strip(F.coalesce(code, F.lit("SIN_DATO"))))
    names = F.expr("map(" + ", ".join(f"'{c}', '{n}'" for c, n in PROVINCES.items()) + ")")
    return F.coalesce(
        F.try_element_at(names, key),
        F.when(key == "SIN_DATO", F.lit(NO_PROVINCE)),
        title_case(key),
    )


def chain_name(banner: Column, legal: Column) -> Column:
    return F.upper(strip(F.coalesce(banner, legal, F.lit(NO_CHAIN))))


def date_text(date: Column, with_year: bool = True) -> Column:
    return F.date_format(date, "dd/MM/yyyy" if with_year else "dd/MM")


def gap_band(gap: Column, cfg: Thresholds = DEFAULTS) -> Column:
    return (
        F.when(gap > cfg.gap_high, "alto").when(gap > cfg.gap_medium, "medio").otherwise("bajo")
    )


def json_safe(number: Column) -> Column:
    """NaN and infinities, which strict JSON cannot hold, to null."""
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
