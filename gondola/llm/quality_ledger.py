"""Quality rules as a ledger of bits.

`ledger` evaluates every rule once per document and keeps the measurements and one number whose
bit i says that rule i failed. Versioned policies are masks over those bits: applying another
policy, or counting what each rule of it costs (`ablation`), reads the ledger and no text.
Only Spark's own functions are used.

A word is a maximal run of other characters than space and \\t to \\r. Repeated windows are found
by sorting (hash, position) within a row, so the work per document is n log n at any length;
two different windows of one document share a 64-bit hash with negligible chance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals",
    "n_exclaims",
)


def _count(text: Column, others: str) -> Column:
    """Characters left when runs of others are removed."""
    return F.length(F.regexp_replace(text, others, ""))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the measurements, all long. A null text has no words."""
    words, keys, order, at = "_words", "_keys", "_order", "_at"
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = F.size(words).cast("long")
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumn(words, F.array_remove(F.split(body, f"{SPACE}+", -1), "")).withColumn("_lines", lines)
    # One hash per 3-word window, then (hash, position) sorted, so that equal windows meet.
    hashed = split.withColumn(
        keys,
        F.slice(
            F.transform(
                words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
            ),
            1, F.greatest(F.size(words) - 2, F.lit(0)),
        ),
    )
    # Documents without a repeated window need no sorting.
    sorted_keys = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    ordered = hashed.withColumn(
        order,
        F.when(F.size(F.array_distinct(keys)) < F.size(keys), sorted_keys),
    )
    repeated = F.filter(
        order,
        lambda x, j: (x["k"] == F.get(order, j - 1)["k"]) | (x["k"] == F.get(order, j + 1)["k"]),
    )
    placed = ordered.withColumn(at, F.sort_array(F.transform(repeated, lambda x: x["i"])))
    # A window at p covers p to p + 2; the next one takes over where it starts.
    covered = F.aggregate(
        F.transform(at, lambda p, j: F.least(F.coalesce(F.get(at, j + 1) - p, F.lit(3)), F.lit(3))),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    return placed.withColumns(
        {
            "n_words": n,
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": _count(body, r"[^#*$%&|<>]+").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            "n_capitals": _count(body, "[^A-Z]+").cast("long"),
            "n_exclaims": _count(body, "[^!]+").cast("long"),
        }
    ).drop(words, keys, order, at, "_lines")


@dataclass(frozen=True)
class Rule:
    """A rule fails where `failed` holds; its bit is its place in the list, which only grows."""

    name: str
    failed: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("repeated_lines", "n_dup_lines >= 3 AND 4 * n_dup_lines > n_words / 10"),
    Rule("capitals", "2 * n_capitals > word_chars"),
    Rule("exclaims", "2 * n_exclaims > n_words"),
)
BASE = ("few_words", "repeated_windows")
# Every policy ever used stays here: name and version to the rules that reject.
POLICIES = {
    ("base", 1): BASE,
    ("prose", 1): (*BASE, "symbols", "short_words", "long_words", "capitals", "exclaims"),
}
DEFAULT_POLICY = ("prose", 1)


def mask(names, rules=RULES) -> int:
    order = {rule.name: 1 << k for k, rule in enumerate(rules)}
    return sum(order[name] for name in names)


def ledger(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The documents with the measurements and `failed_bits`; other columns stay as they are.

    Columns of the documents that have the name of a measurement are replaced. Null and empty
    texts measure zero everywhere and fail the rule on few words. Repeated rows are measured
    each; an empty table gives no rows."""
    bits = sum(
        (F.when(F.expr(rule.failed), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, rule in enumerate(rules)),
        F.lit(0).cast("long"),
    )
    return measured(docs, text).withColumn("failed_bits", bits)


def rejected_by(names, bits: str = "failed_bits", rules=RULES) -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask(names, rules)).cast("long")) != 0


def apply_policy(ledger: DataFrame, policy: tuple[str, int] = DEFAULT_POLICY) -> DataFrame:
    """The ledger with the policy's verdict in `kept`."""
    return ledger.withColumn("kept", ~rejected_by(POLICIES[policy]))


def kept_rows(docs: DataFrame, policy: tuple[str, int] = DEFAULT_POLICY, text: str = "text") -> DataFrame:
    """The documents that the policy keeps, without the ledger's columns. The verdict passes
    through a generator, below which Spark pushes no filter: pushed into the measurements, it
    would have them evaluated again within each other."""
    whole = docs.select(F.col(text).alias("text"), F.struct("*").alias("row"))
    verdict = apply_policy(ledger(whole), policy).select("row", F.explode(F.array("kept")).alias("kept"))
    return verdict.where("kept").select("row.*")


def ablation(ledger: DataFrame, policy: tuple[str, int] = DEFAULT_POLICY, rules=RULES) -> DataFrame:
    """Per rule of the policy: documents it fails, documents that it alone rejects (which
    leaving it out would keep), and the policy's rejections without it. One pass: the bits are
    counted by value first, of which there are at most 2^rules."""
    names = POLICIES[policy]
    whole = mask(names, rules)
    counts = ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).count()
    per_rule = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(mask([name], rules)).cast("long").alias("bit")) for name in names
    )))
    one = counts.select("bits", "count", per_rule.alias("r")).select("bits", "count", "r.*")
    has = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    hit = F.col("bits") != 0
    return one.groupBy("rule").agg(
        F.sum(F.when(has, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("count")).otherwise(0)).alias("n_alone"),
        F.sum(F.when(hit & ~alone, F.col("count")).otherwise(0)).alias("n_rejected_without"),
    )
