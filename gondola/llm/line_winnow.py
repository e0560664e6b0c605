"""Repeated runs of lines, found by winnowing over line hashes. Spark's own functions only.

Of every window of `SPAN` consecutive lines with a word, the line of the smallest hash is a
fingerprint (the last one on a tie), and so is every line of at least `LONG_WORDS` words. Runs
of `SPAN` lines that two places share thus share a fingerprint, however short they are.
Fingerprints that occur at one place only are dropped, which leaves little of a corpus. The
windows of the others are matched by their content with its first place. Each match is extended
line by line both ways, as far as the lines before and after match the same document at the
same distance: to the whole shared run.

A place is (doc_id, hash of the text, line number) in this order; of a shared run, the later
place is deleted. Words are counted in the extended run: its windows of `SPAN` lines and
`MIN_WORDS` words go, and its lines of `LONG_WORDS` words; with `whole_runs`, all of a run of
`MIN_WORDS` words goes, however short its lines are. Neighbouring windows may have their first
places in different documents, and a third share the run of both. Therefore, with `whole_runs`,
windows lengthened until they have `MIN_WORDS` words are matched as well. Content is compared by
128 bits of hash. One content may hold any share of all places: it is aggregated before the
shuffle, and joined, not gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gondola.llm.names import quoted
from gondola.sources.shared import materialize

SPAN = 2
MIN_WORDS = 10
LONG_WORDS = 50
SPACE = r"[\x20\x09-\x0D]+"


def windows(
    docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS,
    whole_runs: bool = False,
) -> DataFrame:
    """(doc_id, text_hash, first, words, print, at, content): every window with its first line and
    the number of words of each of its lines, its fingerprint, the fingerprint's line, and, from
    other hashes of the same lines, its content. Only lines with a word are numbered. Windows of
    `span` lines may have any number of words.

    With `whole_runs`, the shortest window of `min_words` from every line on and the shortest
    one up to every line are among them. A run of that many words holds one of either kind for
    each of its lines, so that these windows make up any shared run to its last line."""

    def window(of):
        smallest = F.array_min(F.transform(of, lambda x: x["h"]))
        return F.struct(
            F.get(of, F.lit(0))["line"].alias("first"),
            F.transform(of, lambda x: x["words"]).alias("words"),
            smallest.alias("print"),
            F.array_max(F.transform(F.filter(of, lambda x: x["h"] == smallest), lambda x: x["line"])).alias("at"),
            F.xxhash64(F.transform(of, lambda x: x["g"])).alias("content"),
        )

    hashed = F.transform(
        F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1),
        lambda s: F.struct(
            F.xxhash64(s).alias("h"), F.xxhash64(s, F.lit(1)).alias("g"),
            F.size(F.array_remove(F.split(s, SPACE, -1), "")).alias("words"),
        ),
    )
    numbered = F.transform(
        F.filter(hashed, lambda x: x["words"] > 0),
        lambda x, i: F.struct(i.alias("line"), x["h"].alias("h"), x["g"].alias("g"), x["words"].alias("words")),
    )
    with_words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), numbered.alias("all"))
    runs = F.filter(
        F.transform("all", lambda x, i: F.when(i + span <= F.size("all"), window(F.slice("all", i + 1, span)))),
        lambda w: w.isNotNull(),
    )
    single = F.transform(F.filter("all", lambda x: x["words"] >= long_words), lambda x: window(F.array(x)))
    both = F.concat(runs, single) if span > 1 else runs
    if whole_runs:
        both = F.concat(both, F.transform(_longer("all", span, min_words), lambda r: window(F.slice("all", r["start"], r["size"]))))
    return with_words.select("doc_id", "text_hash", F.explode(both).alias("w")).select(
        "doc_id", "text_hash", "w.first", "w.words", "w.print", "w.at", "w.content"
    )


def _longer(lines: str, span: int, min_words: int):
    """(start, size) of the shortest runs of `min_words` words that have more than `span` lines,
    from every line on and up to every line, each once; start counts from 1."""
    most = max(span, min_words)  # every line has a word

    def words(of):
        return F.aggregate(of, F.lit(0), lambda total, x: total + x["words"])

    def size(of):
        state = F.struct(F.lit(0).alias("size"), F.lit(0).alias("words"))
        step = lambda s, x: F.when(s["words"] >= min_words, s).otherwise(
            F.struct((s["size"] + 1).alias("size"), (s["words"] + x["words"]).alias("words"))
        )
        return F.aggregate(of, state, step, lambda s: F.when(s["words"] >= min_words, s["size"]))

    def short(start):
        return words(F.slice(lines, start, span)) < min_words

    def onward(x, i):
        return F.struct((i + 1).alias("start"), F.when(short(i + 1), size(F.slice(lines, i + 1, most))).alias("size"))

    def upto(x, i):
        before = F.reverse(F.slice(lines, F.greatest(i + 2 - most, F.lit(1)), F.least(i + 1, F.lit(most))))
        found = F.when(short(F.greatest(i + 2 - span, F.lit(1))), size(before))
        return F.struct((i + 2 - found).alias("start"), found.alias("size"))

    first = F.filter(F.transform(lines, onward), lambda r: r["size"] > span)
    # One that falls short without its last line is the shortest from its first line on, too.
    last = F.filter(
        F.filter(F.transform(lines, upto), lambda r: r["size"] > span),
        lambda r: words(F.slice(lines, r["start"], r["size"] - 1)) >= min_words,
    )
    return F.concat(first, last)


def matches(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id, text_hash, first, words, origin): every window whose content stands at an earlier
    place, and the first such place. An action: the fingerprints at two places or more and their
    windows are written.

    Windows are made twice, for the count of fingerprints and for the join: what the first needs
    is two numbers a window, and a stored table of all windows would be larger than both."""
    found = windows(docs, **limits)
    place = F.xxhash64("doc_id", "text_hash", "at")
    prints = (
        found.select("print", place.alias("place")).groupBy("print")
        .agg(F.min("place").alias("least"), F.max("place").alias("most")).where("least <> most").select("print")
    )
    shared = found.drop("at").join(materialize(prints, "shared-prints"), "print", "left_semi")
    shared = materialize(shared, "shared-windows").withColumn("place", F.struct("doc_id", "text_hash", "first"))
    key = ["print", "content"]
    origin = shared.groupBy(*key).agg(F.min("place").alias("origin"), F.max("place").alias("latest"))
    return (
        shared.join(origin.where("origin <> latest"), key).where("place > origin")
        .select("doc_id", "text_hash", "first", "words", "origin")
    )


def extended(matched: DataFrame) -> DataFrame:
    """(doc_id, text_hash, first, words, origin): the matches extended line by line both ways to
    whole shared runs, each with the place it repeats. Lines extend a match if they follow or
    precede it without a gap and match the same document at the same distance."""
    diagonal = ["doc_id", "text_hash", "origin_doc", "origin_hash", "distance"]
    lines = (
        matched.select(
            "doc_id", "text_hash", F.col("origin.doc_id").alias("origin_doc"), F.col("origin.text_hash").alias("origin_hash"),
            (F.col("first") - F.col("origin.first")).alias("distance"), "first", "words",
        )
        .repartition("doc_id", "text_hash")  # lines are not moved again, neither here nor to be put together by text
        .select(*diagonal, "first", F.posexplode("words").alias("k", "words"))
        .select(*diagonal, (F.col("first") + F.col("k")).alias("line"), "words").distinct()
    )
    gapless = F.col("line") - F.row_number().over(Window.partitionBy(*diagonal).orderBy("line"))
    runs = lines.withColumn("run", gapless).groupBy(*diagonal, "run").agg(
        F.min("line").alias("first"), F.array_sort(F.collect_list(F.struct("line", "words"))).alias("lines")
    )
    origin = F.struct(
        F.col("origin_doc").alias("doc_id"), F.col("origin_hash").alias("text_hash"),
        (F.col("first") - F.col("distance")).alias("first"),
    )
    return runs.select("doc_id", "text_hash", "first", F.col("lines.words").alias("words"), origin.alias("origin"))


def _places(words: str, span: int, min_words: int, long_words: int, whole_runs: bool):
    """The lines of an extended run that go, counted from 0."""

    def total(of):
        return F.aggregate(of, F.lit(0), lambda x, y: x + y)

    size = F.size(words)
    every = F.sequence(F.lit(0), size - 1)
    least = long_words if span > 1 else min_words
    single = F.filter(every, lambda k: F.get(words, k) >= least)
    if whole_runs:
        return F.when((size >= span) & (total(F.col(words)) >= min_words), every).otherwise(single)
    starts = F.filter(every, lambda k: (k + span <= size) & (total(F.slice(words, k + 1, span)) >= min_words))
    return F.concat(single, F.flatten(F.transform(starts, lambda k: F.sequence(k, k + span - 1))))


def repeated_lines(
    docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS,
    whole_runs: bool = False,
) -> DataFrame:
    """(doc_id, text_hash, removed): the lines to delete, ascending, of every document that has
    any, numbered among its lines with a word. An action, see `matches`."""
    limits = {"span": span, "min_words": min_words, "long_words": long_words, "whole_runs": whole_runs}
    runs = extended(matches(docs, **limits))
    later = runs.select("doc_id", "text_hash", "first", F.explode(_places("words", **limits)).alias("k"))
    line = F.col("first") + F.col("k")
    return later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(line)).alias("removed"))


def dedup_lines(docs: DataFrame, **limits) -> DataFrame:
    """The documents without later repeated runs, and `n_removed`, the number of lines deleted.

    A document stays a row when all its lines go (its text is then empty); a null text stays
    null, documents without repeats keep their text as it is. Rows that agree in doc_id and text
    are one place: their lines are kept or deleted alike. A null doc_id comes before all others.
    An empty table gives no rows. Columns of the documents named n_removed are replaced."""
    others = [quoted(c) for c in docs.columns if c.lower() not in ("text", "n_removed")]
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.struct(*others).alias("row"))
    removed = repeated_lines(docs, **limits).withColumnRenamed("doc_id", "id")
    joined = marked.join(
        removed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left"
    )
    # Places of the lines with a word among all lines, then of those that go.
    split = joined.withColumn("lines", F.when(F.col("removed").isNotNull(), F.split("text", "\n", -1)))
    numbered = F.transform("lines", lambda s, i: F.struct(i.alias("i"), s.rlike(r"[^\x20\x09-\x0D]").alias("word")))
    placed = split.withColumn("full", F.transform(F.filter(numbered, lambda x: x["word"]), lambda x: x["i"]))
    gone = placed.withColumn("gone", F.transform("removed", lambda k: F.get("full", k)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    made = {
        "text": F.when(F.col("removed").isNull(), F.col("text")).otherwise(text),
        "n_removed": F.coalesce(F.size("removed"), F.lit(0)).cast("long"),
    }
    names = [*(c for c in docs.columns if c.lower() != "n_removed"), "n_removed"]
    return gone.select(*((made[c.lower()] if c.lower() in made else F.col("row")[c]).alias(c) for c in names))
