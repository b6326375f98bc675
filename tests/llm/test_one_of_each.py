"""The near-dedup stage keeps one row of each class, whatever the ids."""

from collections import Counter

import pytest

from tidepanel.llm import neardup

LONG = " ".join(f"word{i}" for i in range(60))
NEAR = LONG.replace("word59", "changed")


def stay(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    out = neardup.one_of_each(df)
    assert out.columns == df.columns
    return Counter((r["doc_id"], r["text"]) for r in out.collect())


@pytest.mark.parametrize(
    "rows,want",
    [
        ([(1, LONG), (None, LONG), (None, LONG), (2, LONG), (1, LONG)], [(1, LONG)]),
        ([(None, LONG), (None, LONG), (None, NEAR)], 1),
        ([(3, NEAR), (4, LONG), (5, "something else altogether that nobody wrote before"), (3, NEAR)], [(3, NEAR), (5, "something else altogether that nobody wrote before")]),
        ([(1, ""), (2, ""), (2, ""), (None, None), (3, " \n")], [(1, ""), (2, ""), (2, ""), (None, None), (3, " \n")]),
        ([(7, LONG)], [(7, LONG)]),
    ],
)
def test_one_row_of_each_class(spark, rows, want):
    got = stay(spark, rows)
    assert sum(got.values()) == want if isinstance(want, int) else got == Counter(want)
