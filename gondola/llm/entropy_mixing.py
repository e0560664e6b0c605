"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of times that the mix takes it. Of all rates between 0
and `MOST` whose words add up to each source's target, entropy balancing picks those closest to
one in relative entropy. They are exponentially tilted: a document of x words in source s has
the rate min(MOST, exp(t_s * x / m_s)), m_s being the mean of x over the source's words. The
tilts t_s maximise the dual, a concave function whose gradient is target less words taken; each
is found by Newton steps, all sources at once, one distributed aggregation per step. A step that
leaves the bracket known so far is replaced by a bisection, so that every source converges.

A rate depends on source and size only, so the steps run over a table of (source, size, count).
A source of W words has at most sqrt(2 W) sizes, however many documents or copies it has. Terms
are summed as decimals: the order of rows changes no bit of the tilts, and reruns agree.

Rates become copies by error diffusion from the largest size of a source to the smallest: each
size takes the number of copies that brings the words taken so far nearest to the words wanted
so far. The copies of a size are spread evenly over its documents; those that get one more than
the others are the first by hash. Sizes with many documents are dealt into buckets by that
hash, each with its own part of the copies, so that no task ranks a whole hot group.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gondola.sources.shared import materialize

MOST = 3
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
# A source has converged when its words are this near to its target, as a share of it.
TOLERANCE = 1e-9
MAX_STEPS = 200
# Documents of one size and source that a task ranks together.
BUCKET = 1 << 16


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(keys: DataFrame, column: str) -> DataFrame:
    """`keys` with `rank`, the place of its distinct values in ascending order, null last. Parts
    of the order are numbered on their own and moved by the sizes of the parts before them,
    one number per part, so that no task holds all keys."""
    ordered = keys.repartitionByRange(F.col(column).asc_nulls_last()).sortWithinPartitions(F.col(column).asc_nulls_last())
    placed = materialize(
        ordered.withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "ranked",
    )
    before, starts = 0, {}
    for part, n in placed.groupBy("part").count().orderBy("part").collect():
        starts[part], before = before, before + n
    if not starts:
        return placed.select(*keys.columns, F.col("place").alias("rank"))
    start = F.element_at(F.create_map(*(F.lit(x).cast("long") for pair in starts.items() for x in pair)), F.col("part").cast("long"))
    return placed.select(*keys.columns, (start + F.col("place")).alias("rank"))


def shared_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size) with `target`: all words shared by weight, the weights repeating over
    the sources in ascending order, null last. A target stops at `most` times its source's
    size and its excess is shared again by weight, until none is above."""
    numbered = ranked(sources, "source")
    listed = F.array(*(F.lit(float(w)) for w in weights))
    weighed = materialize(
        numbered.select("source", "source_size", F.get(listed, F.pmod("rank", F.lit(len(weights))).cast("int")).alias("weight")),
        "weighed",
    )
    limit = most * F.col("source_size").cast("double")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    stopped = -1
    while True:
        above = F.col("weight") * share > limit
        n, words, weight = weighed.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == stopped or not weight:
            break
        stopped, share = n, (total - most * words) / weight
    return weighed.select("source", "source_size", F.least(F.col("weight") * share, limit).alias("target"))


def _exact(x: Column) -> Column:
    return F.sum(x.cast("decimal(38,6)")).cast("double")


def tilts(sizes: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(source, mean, tilt): the dual's solution, by Newton steps over the table of
    (source, size, n). A source whose target is nothing, or all that `most` allows, has an
    infinite tilt.
    An action; the state of the sources, a row each, is written after every step."""
    words = F.col("n") * F.col("size")
    scale = sizes.groupBy("source").agg((_exact(words.cast("double") * F.col("size")) / F.sum(words)).alias("mean"))
    full, none = F.col("target") >= most * F.col("source_size"), F.col("target") <= 0
    state = materialize(
        _join(targets.where("source_size > 0"), scale).select(
            "source", "target", "mean",
            F.when(full, F.lit(math.inf)).when(none, F.lit(-math.inf)).otherwise(F.lit(0.0)).alias("tilt"),
            F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
            (full | none).alias("done"),
        ),
        "tilts",
    )
    for _ in range(MAX_STEPS):
        open_ = state.where("NOT done")
        if open_.isEmpty():
            break
        x = F.col("size") / F.col("mean")
        raw = F.exp(F.col("tilt") * x)
        at = _join(sizes, open_.select("source", "mean", "tilt")).groupBy("source").agg(
            _exact(words * F.least(raw, F.lit(float(most)))).alias("taken"),
            _exact(F.when(raw < most, words * raw * x).otherwise(0)).alias("slope"),
        )
        state = materialize(state.where("done").unionByName(_step(_join(open_, at))), "tilts")
    return state.select("source", "mean", "tilt")


def _join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by source, a null source equal to itself."""
    other = right.withColumnRenamed("source", "_source")
    return left.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _step(at: DataFrame) -> DataFrame:
    """One safeguarded Newton step. The words taken grow with the tilt."""
    tilt, gap = F.col("tilt"), F.col("taken") - F.col("target")
    at = at.withColumn("low", F.when(gap < 0, tilt).otherwise(F.col("low")))
    at = at.withColumn("high", F.when(gap > 0, tilt).otherwise(F.col("high")))
    newton = tilt - gap / F.nullif(F.col("slope"), F.lit(0.0))
    inside = (newton > F.coalesce("low", F.lit(-math.inf))) & (newton < F.coalesce("high", F.lit(math.inf)))
    beyond = F.when(F.col("low").isNull(), F.col("high") - 1 - F.abs("high")).when(
        F.col("high").isNull(), F.col("low") + 1 + F.abs("low")
    ).otherwise((F.col("low") + F.col("high")) / 2)
    near = F.abs(gap) <= TOLERANCE * F.col("target")
    closed = F.coalesce(F.col("high") - F.col("low") <= 1e-14 * (F.abs("low") + F.abs("high")), F.lit(False))
    return at.select(
        "source", "target", "mean",
        F.when(near | closed, tilt).when(inside, newton).otherwise(beyond).alias("tilt"),
        "low", "high", (near | closed).alias("done"),
    )


def diffuse(sizes: list[int], counts: list[int], rates: list[float], most: int) -> list[int]:
    """Copies in all of each size, the sizes descending: the number, at most `most` for each
    document, that brings the words taken nearest to the words wanted so far."""
    copies, owed = [], 0.0
    for size, n, rate in zip(sizes, counts, rates):
        owed += rate * size * n
        taken = min(max(math.floor(owed / size + 0.5), 0), most * n)
        owed -= taken * size
        copies.append(taken)
    return copies


def _diffused(most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False)
        rows["copies"] = diffuse(rows["size"].tolist(), rows["n"].tolist(), rows["rate"].tolist(), most)
        return rows

    return run


def _dealt(narrow: DataFrame, spread: DataFrame, bucket: int) -> DataFrame:
    """`narrow` with rate and copies of each document. Documents of a size get equal copies, and
    the first by hash one more, as many as the size's copies leave over; in a size of many
    documents, each bucket has its share of those."""
    n, extra = F.col("n"), F.pmod("copies", "n")
    plan = spread.select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), "n", "rate",
        F.expr("copies div n").alias("least"), extra.alias("extra"),
        F.ceil(n / bucket).cast("long").alias("buckets"),
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    joined = narrow.join(plan, same, "left").drop("_source", "_size")
    joined = joined.withColumn("bucket", F.pmod("hash", F.coalesce("buckets", F.lit(1))))
    uneven = F.coalesce(F.col("extra") > 0, F.lit(False))
    group = ["source", "size", "bucket"]
    up_to = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    share = "cast(cast({} as decimal(19,0)) * cast(extra as decimal(19,0)) div n as long)"
    quotas = (
        joined.where(uneven & (F.col("buckets") > 1)).groupBy(*group, "n", "extra").agg(F.count("*").alias("held"))
        .withColumn("upto", F.sum("held").over(up_to))
        .withColumn("quota", F.expr(f"{share.format('upto')} - {share.format('upto - held')}"))
        .select(F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("bucket").alias("_bucket"), "quota")
    )
    first = F.row_number().over(Window.partitionBy(*group).orderBy("hash", "doc_id"))
    chosen = (
        joined.where(uneven).withColumn("place", first)
        .join(quotas, same & (F.col("bucket") == F.col("_bucket")), "left")
        .withColumn("more", F.when(F.col("place") <= F.coalesce("quota", "extra"), 1).otherwise(0))
    )
    both = chosen.select(*joined.columns, "more").unionByName(joined.where(~uneven).withColumn("more", F.lit(0)))
    return both.select(
        "doc_id", "source", "size", F.coalesce("rate", F.lit(1.0)).alias("rate"),
        (F.coalesce("least", F.lit(0)) + F.col("more")).alias("copies"),
    )


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST,
    targets: DataFrame | None = None, bucket: int = BUCKET,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, and taken,
    the words that the mix takes (copies times size). Reads doc_id, text and source only.

    The sources share all words by `weights`, or have the given `targets` (source, target, one
    row each; a target is held between 0 and `most` times its source's size, and sources
    without one are left out of the mix). A null source is one of its own, after the others.
    Null texts, and texts without words, have size 0, rate 1 and no copies, since they add no
    word; a source of such has the target 0. Rows with the same doc_id are documents each.
    Where a size's copies do not divide evenly, a hash of doc_id and text decides; rows that
    agree in both are alike. An empty table gives no rows. An action."""
    narrow = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("hash"),
        ),
        "sizes",
    )
    every = materialize(narrow.groupBy("source", "size").agg(F.count("*").alias("n")), "size-counts")
    found = every.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    if targets is None:
        wanted = shared_targets(found, weights, most)
    else:
        given = targets.select("source", F.col("target").cast("double").alias("target"))
        held = F.least(F.greatest(F.coalesce("target", F.lit(0.0)), F.lit(0.0)), most * F.col("source_size"))
        wanted = _join(found, given, "left").withColumn("target", held)
    wanted = materialize(wanted, "targets")
    sizes = every.where("size > 0")
    rate = F.least(F.exp(F.col("tilt") * F.col("size") / F.col("mean")), F.lit(float(most)))
    rated = _join(sizes, tilts(sizes, wanted, most)).select("source", "size", "n", rate.alias("rate"))
    spread = materialize(
        rated.groupBy("source").applyInPandas(
            _diffused(most), "source string, size long, n long, rate double, copies long"
        ),
        "copies",
    )
    return _join(_dealt(narrow, spread, bucket), wanted).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
