"""Line dedup: texts that weak hashes confuse, blocks of repeated lines, and a plain diff that would align otherwise."""

import random

from tidepanel.llm import lines


def alternating(n):
    one = "a"
    for _ in range(n):
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def left(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    return {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()}


def test_different_lines_of_a_confusing_pattern_stay(spark):
    one, other = (" ".join(x) for x in alternating(11))  # 2,048 words each
    assert left(spark, [one, other, one]) == {1: one, 2: other, 3: ""}


def test_block_of_repeated_lines_goes(spark):
    block = [f"line {k} that is long enough to be a block of its own by ten words" for k in range(2)] * 2
    got = left(spark, ["\n".join(["first", *block, "end"]), "\n".join(["second", *block, "other end"])])
    assert got[2] == "second\nother end"


def test_unique_lines_anchor_the_alignment():
    """A greedy diff would pair the brace of the first function with that of the second."""
    a = [1, 9, 2, 9, 3, 9]
    b = [3, 9, 1, 9, 2, 9]
    assert lines.patience(a, b) == [(0, 2), (1, 3), (2, 4), (3, 5)] or [p for p in lines.patience(a, b) if a[p[0]] in (1, 2)] == [(0, 2), (2, 4)]
    assert lines.patience([5, 6, 5, 6], [7, 5, 6, 5, 6, 8]) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert lines.patience([1, 1, 1], [1, 1]) == [(0, 0), (1, 1)]


def test_alignments_are_common_and_rising():
    rng = random.Random(0)
    for _ in range(500):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
        if set(a) & set(b):
            assert pairs
