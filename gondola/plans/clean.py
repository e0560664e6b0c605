"""Raw landing to clean, audited, date-partitioned table."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gondola.config import CLEAN_COLUMNS, CLEAN_EXTRAS, DEFAULTS, Thresholds
from gondola.functions.text import desc_norm, ean_norm, to_number
from gondola.operators.enrich import enrich
from gondola.operators.quality import (
    ExcessiveDiscard, annotate_rules, excessive_discards, kept, quality_metrics,
)
from gondola.operators.texts import text_dictionary, unit_dictionary, with_size
from gondola.sources.landing import discover, unplaced
from gondola.sources.raw import read_role
from gondola.sources.shared import intermediate, materialize, spare_disk
from gondola.sources.tables import pending, upsert_quality, write_clean

log = logging.getLogger(__name__)


def typed(productos: DataFrame) -> DataFrame:
    """The raw text columns as values: precio, ean, descripcion. The code is in id_producto;
    productos_ean is a count."""
    return (
        productos.withColumn("precio", to_number(F.col("productos_precio_lista")))
        .withColumn("ean", ean_norm(F.col("id_producto")))
        .withColumn("descripcion", desc_norm(F.col("productos_descripcion")))
    )


def audit(
    productos: DataFrame,
    sucursales: DataFrame | None,
    comercios: DataFrame | None,
    cfg: Thresholds = DEFAULTS,
) -> DataFrame:
    """All rows, annotated with the rule that discards them, sized and enriched."""
    return audit_staged(materialize(typed(productos), "staged"), sucursales, comercios, cfg)


def audit_staged(
    staged: DataFrame,
    sucursales: DataFrame | None,
    comercios: DataFrame | None,
    cfg: Thresholds = DEFAULTS,
    order: Column | None = None,
) -> DataFrame:
    """`audit` of typed rows that are stored: the rules read them several times. Behind the rules
    the order only names a row; `order` says what is kept of it, if not all.

    Medians and branches may be too large to be sent to the rows, which are then moved for either
    join. What is read from their own text or in small dictionaries is left out of these
    moves and added again behind them."""
    texts, unit_texts = text_dictionary(staged), unit_dictionary(staged)
    annotated = annotate_rules(staged.drop("descripcion"), cfg)
    if order is not None:
        annotated = annotated.withColumn("orden", order)
    enriched = enrich(annotated.drop("precio", "ean"), sucursales, comercios)
    return with_size(typed(enriched), texts, unit_texts)


def clean_rows(audited: DataFrame) -> DataFrame:
    extras = [
        F.col(c) if c in audited.columns else F.lit(None).cast("string").alias(c)
        for c in CLEAN_EXTRAS
    ]
    return kept(audited).select(*CLEAN_COLUMNS, *extras)


def clean_days(
    spark: SparkSession,
    landing: str,
    out: str,
    force: bool = False,
    ignore_guardrail: bool = False,
    cfg: Thresholds = DEFAULTS,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """Clean every day of the landing area that `out/precios` lacks (all when forced; of `days`
    only, if given), write it and its quality record, and return the rejected files, those without
    a day folder or a known role among them. All days
    go through one plan; each is replaced as a whole, so a repeated run gives the same tables.

    Days on which a rule discards too much are not written; after the others are, they are
    raised together, unless the guardrail is to be ignored. Intermediate tables are removed."""
    table = f"{out}/precios"
    with intermediate(spark), spare_disk(spark):
        found = discover(spark, landing)
        if days is not None:
            found = found.where(F.col("fecha").isin([date.fromisoformat(str(d)) for d in days]))
        files = materialize(pending(found, table, force), "files")
        read = {role: read_role(spark, role, landing, files) for role in ("productos", "sucursales", "comercio")}
        # Stored with its rejected rows: the guardrail, the clean table and the quality record
        # all read it, and none of them repeats a join. None reads the order, a path with every
        # row, which is left out before rows are moved; what the rules wrote goes with their end.
        with intermediate(spark):
            rows = audit(read["productos"][0], read["sucursales"][0], read["comercio"][0], cfg)
            audited = materialize(rows.drop("orden"), "audited", kept=True)
        _, excessive = excessive_discards(audited, cfg)
        if excessive and not ignore_guardrail:
            passed = audited.where(~F.col("fecha").isin([day for day, _ in excessive]))
        else:
            passed = audited
        write_clean(clean_rows(passed), table)
        upsert_quality(quality_metrics(passed, cfg), f"{out}/calidad")
    for _, message in excessive:
        log.warning(message)
    if excessive and not ignore_guardrail:
        raise ExcessiveDiscard("; ".join(message for _, message in excessive))
    rejects = unplaced(spark, landing)
    for _, rejected in read.values():
        rejects = rejects.union(rejected)
    return rejects
