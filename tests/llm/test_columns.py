"""Documents with extra columns of odd or clashing names."""

import pytest

from gondola.llm import (
    chunk_dedup, cost_packing, entropy_mixing, line_winnow, quality_ledger, simhash_index, token_alignment, weak_pii,
    winnow_contamination,
)
from helpers import docs

ODD = ("spans", "a.b", "N_Removed", "_words", "row", "hash", "id", "found", "count", "source_size", "n`x")
KEEPING = {
    "lines": line_winnow.dedup_lines,
    "substrings": chunk_dedup.dedup_substrings,
    "near": simhash_index.first_of_group,
    "contamination": lambda d: winnow_contamination.annotate(d, d.sparkSession.createDataFrame([("i", "x y")], "item_id string, text string")),
    "quality": lambda d: quality_ledger.kept_rows(d),
}
MAKING = {
    "pack": cost_packing.pack,
    "near_duplicates": simhash_index.near_duplicates,
    "mix": entropy_mixing.mix,
    "align": lambda d: token_alignment.align(d)[0],
    "personal": lambda d: weak_pii.detect(d)[0],
}


def frame(spark):
    texts = ["one two three " * 30, "four five\n" * 30, None]
    return docs(spark, texts, [1, 2, None]).selectExpr("*", *(f"'{k}' AS `{c.replace('`', '``')}`" for k, c in enumerate(ODD)))


@pytest.mark.parametrize("name", KEEPING)
def test_extra_columns_stay(spark, name):
    given = frame(spark)
    rows = KEEPING[name](given).collect()
    made = {"lines": {"n_removed"}, "substrings": {"n_removed"}}.get(name, set())
    for row in rows:
        values = row.asDict()
        for k, c in enumerate(ODD):
            if c.lower() not in made:
                assert values[c] == str(k)
    assert name == "quality" or len(rows) == 3


@pytest.mark.parametrize("name", MAKING)
def test_extra_columns_do_no_harm(spark, name):
    assert MAKING[name](frame(spark)).count() >= 3
