"""Audited quality rules: every row keeps the name of the rule that discards it."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, functions as F

from gondola.config import DEFAULTS, RULES, Thresholds
from gondola.operators.common import BROADCAST_ROWS, pct
from gondola.operators.quantiles import exact_median
from gondola.sources.shared import materialize

log = logging.getLogger(__name__)

LISTING = ("fecha", "id_comercio", "id_sucursal", "ean")
SAMPLE_COLUMNS = ("id_producto", "productos_descripcion", "productos_precio_lista")
SAMPLE_ROWS = 5
# The largest filter that is sent to the rows: 8 MB.
FILTER_BITS = 1 << 26


class ExcessiveDiscard(RuntimeError):
    """A rule discarded a larger share of the rows than is plausible."""


def _row_rule(cfg: Thresholds) -> Column:
    """The rules that look at one row only."""
    ean, price = F.col("ean"), F.col("precio")
    return (
        F.when(price.isNull() | ean.isNull() | ean.isin("", "nan", "0"), "nulos")
        .when(~F.length(ean).between(cfg.ean_length_min, cfg.ean_length_max), "ean_invalido")
        .when(~price.between(cfg.price_min, cfg.price_max), "precio_fuera_rango")
    )


def _same(left: DataFrame, right: DataFrame, columns) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[f"_{name}"])
    return condition


def repeated_listings(df: DataFrame) -> DataFrame:
    """Keys listed more than once in a day, with the order of the row to keep, the last (an
    action). A plain count of the keys' hashes, a third as wide, finds the rows that may be
    repeated; only these are looked at for their keys and the order."""
    keys = [f"_{c}" for c in LISTING]
    renamed = df.select(*[F.col(c).alias(f"_{c}") for c in LISTING], "orden", F.xxhash64(*LISTING).alias("_hash"))
    repeated = materialize(
        renamed.groupBy("_hash").count().where(F.col("count") > 1).drop("count"), "repeated-keys"
    )
    return renamed.join(repeated, "_hash", "left_semi").groupBy(*keys).agg(
        F.max("orden").alias("_ultimo"), F.count(F.lit(1)).alias("_n")
    ).where("_n > 1").drop("_n")


def _join_few(df: DataFrame, found: DataFrame, columns) -> tuple[DataFrame, bool]:
    """`df` with the columns of `found`, a stored table that few of its rows meet, keys among them,
    and whether `found` is so short that it was sent to the rows (an action).

    A longer one is met by the rows that may have a key in it only: the others, told by one bit
    per hash of a key, are not moved. Both are read from `df`, so pass a stored table."""
    n = found.count()
    if n <= BROADCAST_ROWS:
        return df.join(F.broadcast(found), _same(df, found, columns), "left"), True
    bits = min(FILTER_BITS, 1 << (16 * n).bit_length())

    def place(names) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(bits)) + 1

    at = place([f"_{c}" for c in columns])
    marks = materialize(
        found.groupBy(F.bitmap_bucket_number(at).alias("_tramo"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")),
        "key-bits",
    )
    bit = F.bitmap_bit_position(place(columns))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    told = df.join(F.broadcast(marks), F.bitmap_bucket_number(place(columns)) == F.col("_tramo"), "left").withColumn(
        "_puede", F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    ).drop("_tramo", "_bits")
    near, far = told.where("_puede").drop("_puede"), told.where("NOT _puede").drop("_puede")
    met = near.join(found, _same(near, found, columns), "left")
    return met.unionByName(far, allowMissingColumns=True), False


def _with_last(df: DataFrame, rows: Column) -> tuple[DataFrame, bool]:
    """Adds `_ultimo`, the order of the last row of a repeated listing of `rows` (an action), and
    tells whether the listings are so few that they were sent to the rows."""
    repeated = materialize(repeated_listings(df.where(rows)), "repeated-listings")
    joined, few = _join_few(df, repeated, LISTING)
    return joined.drop(*(f"_{c}" for c in LISTING)), few


def keep_last(df: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """Without the rows that a later one of the same listing replaces (an action). Rows that a rule
    on single rows discards are no listings: they neither replace nor go. `df` is read several
    times, so pass a stored table."""
    rule = _row_rule(cfg)
    joined, _ = _with_last(df, rule.isNull())
    older = rule.isNull() & (F.col("orden") < F.col("_ultimo"))
    return joined.where(~F.coalesce(older, F.lit(False))).drop("_ultimo")


def wide_medians(df: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """_fecha, _ean, _mediana of the EANs and days that hold an outlier (an action).

    Where the highest price is within the allowed ratios of the lowest, every price is within
    them of the median, which lies between. Counts and extremes shrink map-side, so most EANs
    are settled by them, and the median is taken of the others only. Of these, the extremes tell
    again which hold an outlier: rows meet no more medians than there are outliers.
    """
    keys = ["_fecha", "_ean"]
    prices = df.select(F.col("fecha").alias("_fecha"), F.col("ean").alias("_ean"), "precio")
    low, high = F.min("precio"), F.max("precio")
    wide = materialize(
        prices.groupBy(*keys)
        .agg(F.count("precio").alias("n"), low.alias("_low"), high.alias("_high"))
        .where(F.col("n") >= cfg.outlier_min_rows)
        .where(
            (F.try_divide("_high", "_low") > cfg.outlier_ratio_max)
            | (F.try_divide("_low", "_high") < cfg.outlier_ratio_min)
        ),
        "wide-eans",
    )
    rows = prices.join(wide.select(*keys), keys, "left_semi")
    medians = exact_median(rows, keys, "precio", "_mediana", wide.select(*keys, "n")).drop("n")
    extremes = medians.join(wide.drop("n"), keys)
    return extremes.where(_is_outlier(cfg, "_low") | _is_outlier(cfg, "_high")).drop("_low", "_high")


def _is_outlier(cfg: Thresholds, price: str = "precio") -> Column:
    ratio = F.try_divide(price, "_mediana")
    return F.coalesce(~ratio.between(cfg.outlier_ratio_min, cfg.outlier_ratio_max), F.lit(False))


def outlier_prices(df: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """Rows whose price is too far from that day's median of their EAN (an action). What the
    medians read twice is written first, so that the joins behind `df` are made twice in all."""
    prices = materialize(df.select("fecha", "ean", "precio"), "prices")
    medians = materialize(wide_medians(prices, cfg), "wide-medians")
    joined = df.join(medians, _same(df, medians, ("fecha", "ean")))
    return joined.where(_is_outlier(cfg)).drop(*medians.columns)


def annotate_rules(df: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """Adds `descarte`, the first rule that discards the row, null for kept rows.

    `df` has fecha, id_comercio, id_sucursal, ean, precio and `orden`, the position in the
    source. It is read several times, so pass a stored table. The keys that the two group
    rules have to look at are few; they are found by aggregation, which shrinks a group of
    copies before the shuffle, written, and joined back: broadcast while they are few, else
    a shuffled join of the rows that may meet them, whose large partitions adaptive execution splits.
    """
    df = df.withColumn("descarte", _row_rule(cfg))
    df, few = _with_last(df, F.col("descarte").isNull())
    older = F.col("descarte").isNull() & (F.col("orden") < F.col("_ultimo"))
    df = df.withColumn("descarte", F.when(older, "duplicados").otherwise(F.col("descarte"))).drop("_ultimo")
    if not few:  # Rows were moved: they are written, not moved again for every reading below.
        df = materialize(df, "without-copies")

    medians = materialize(
        wide_medians(df.where(F.col("descarte").isNull()), cfg), "wide-medians"
    )
    df, _ = _join_few(df, medians, ("fecha", "ean"))
    outlier = F.col("descarte").isNull() & _is_outlier(cfg)
    df = df.withColumn("descarte", F.when(outlier, "outliers").otherwise(F.col("descarte")))
    return df.drop(*medians.columns)


def kept(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("descarte").isNull()).drop("descarte")


def rule_counts(annotated: DataFrame) -> DataFrame:
    """Per day and rule: rows that reached the rule and rows it discarded."""
    totals = annotated.groupBy("fecha").agg(
        F.count(F.lit(1)).alias("_filas"),
        *[F.count_if(F.col("descarte") == rule).alias(rule) for rule in RULES],
    )
    entries, reached = [], F.col("_filas")
    for rule in RULES:
        entries.append(
            F.struct(
                F.lit(rule).alias("regla"), reached.alias("llegan"), F.col(rule).alias("descarta")
            )
        )
        reached = reached - F.col(rule)
    return totals.select("fecha", F.inline(F.array(*entries)))


def excessive_discards(
    annotated: DataFrame, cfg: Thresholds = DEFAULTS
) -> tuple[DataFrame, list[tuple[object, str]]]:
    """The rule counts, and of each day where a rule discards too much of what reached it, the
    day and a message with the first such rule and examples (an action). A day is a partition
    of the tables, so there are few."""
    counts = materialize(rule_counts(annotated), "rule-counts")
    order = F.array_position(F.array(*map(F.lit, RULES)), F.col("regla"))
    worst = (
        counts.where(F.col("descarta") > cfg.max_discard_share * F.col("llegan"))
        .groupBy("fecha").agg(F.min_by(F.struct("*"), order).alias("r")).select("r.*").orderBy("fecha").collect()
    )
    shown = [c for c in SAMPLE_COLUMNS if c in annotated.columns]
    messages = []
    for row in worst:
        sample = (
            annotated.where((F.col("fecha") == row["fecha"]) & (F.col("descarte") == row["regla"]))
            .select(*shown).limit(SAMPLE_ROWS).collect() if shown else []
        )
        messages.append((row["fecha"], (
            f"rule '{row['regla']}' discards {row['descarta']:,} of {row['llegan']:,} rows "
            f"of {row['fecha']}; examples: {[tuple(r) for r in sample]}"
        )))
    return counts, messages


def enforce_guardrail(
    annotated: DataFrame, cfg: Thresholds = DEFAULTS, ignore: bool = False
) -> DataFrame:
    """Fail, showing examples, if a rule discards too much of what reached it (an action).
    Returns the rule counts. With `ignore` the finding is only logged."""
    counts, messages = excessive_discards(annotated, cfg)
    for _, message in messages:
        if not ignore:
            raise ExcessiveDiscard(message)
        log.warning(message)
    return counts


def size_agreement(cfg: Thresholds = DEFAULTS) -> Column:
    """Whether the two sources of the package size agree; null where they cannot be compared."""
    ratio = F.try_divide("cantidad_desc", "cantidad_pres")
    return F.when(
        F.col("cantidad_desc").isNotNull() & F.col("cantidad_pres").isNotNull()
        & (F.col("unidad_desc") == F.col("unidad_pres")),
        ratio.between(cfg.agreement_min, cfg.agreement_max),
    )


def quality_metrics(annotated: DataFrame, cfg: Thresholds = DEFAULTS) -> DataFrame:
    """One row per day: raw and final rows, discards per rule, how sizes were resolved (over
    the raw rows) and what the kept rows cover. `annotated` is sized and enriched."""
    agrees = size_agreement(cfg)
    rows = F.count(F.lit(1))
    daily = annotated.groupBy("fecha").agg(
        rows.alias("filas_crudas"),
        F.round(pct(F.count_if(~agrees), F.count(agrees)), 2).alias("pct_fuentes_discrepan"),
        F.round(pct(F.count("cantidad_desc"), rows), 2).alias("pct_tamano_desc"),
        F.round(pct(rows - F.count("cantidad_base"), rows), 2).alias("pct_sin_tamano"),
        *[F.count_if(F.col("descarte") == rule).alias(f"desc_{rule}") for rule in RULES],
        F.count_if(F.col("descarte").isNull()).alias("filas_finales"),
    ).withColumn(
        "pct_descartado",
        F.round(100.0 * (1 - F.try_divide(F.col("filas_finales"), F.col("filas_crudas"))), 2),
    )
    # Distinct counts one column group at a time: each is reduced map-side, none is expanded.
    final = kept(annotated)
    eans = final.select("fecha", "ean").distinct().groupBy("fecha").agg(F.count("ean").alias("eans_unicos"))
    branches = (
        final.select("fecha", "id_comercio", "id_sucursal", "cadena").distinct()
        .groupBy("fecha")
        .agg(
            F.countDistinct(F.struct("id_comercio", "id_sucursal")).alias("sucursales"),
            F.countDistinct("cadena").alias("cadenas"),
        )
    )
    return daily.join(eans, "fecha", "left").join(branches, "fecha", "left").fillna(
        0, ["eans_unicos", "sucursales", "cadenas"]
    )
