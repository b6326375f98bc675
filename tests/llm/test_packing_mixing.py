"""Ids as the tokenizers file gives them, plans against plain best fit, and mixed rows against the mix."""

import bisect
import collections

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidepanel.llm import mixing, packing, repeats

SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def reference_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{packing.TOKENIZER}.json"))
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def alternating(n):
    """Words that a polynomial hash modulo 2^64 can't tell apart."""
    one = "a"
    for _ in range(n):
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_ids_are_those_of_the_tokenizers_file(spark, sf, reference_ids):
    texts = [t for (t,) in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += ["", None, SPECIAL, f"a{SPECIAL}b", f"{SPECIAL}{SPECIAL} x ", f"don{SPECIAL}'t", "<|endoftext", " ".join(alternating(11)), "it's  we'll\n\n x"]
    ids, first = packing.Encoder().encode_marked(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [reference_ids(t) for t in texts]


def best_fit(lengths, size):
    """Number of sequences of best fit, longest first, piece by piece."""
    rooms, used = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at == len(rooms):
            used += 1
            rest = size - length
        else:
            rest = rooms.pop(at) - length
        if rest:
            bisect.insort(rooms, rest)
    return used


@pytest.mark.parametrize("kind", ["uniform", "high", "lognormal", "few", "full"])
def test_never_more_sequences_than_best_fit(kind):
    rng = np.random.default_rng(4)
    lengths = {
        "uniform": rng.integers(1, 2049, 5000), "high": rng.integers(385, 2049, 5000),
        "lognormal": np.clip(rng.lognormal(6.5, 0.8, 5000), 1, 2048).astype(int), "few": np.array([1200, 900, 800, 700, 300, 300]),
        "full": np.full(300, 2048),
    }[kind]
    counts = np.bincount(lengths, minlength=packing.SIZE + 1)
    runs = packing.best_plan(counts)
    assert packing.sequences(runs) <= best_fit(lengths.tolist(), packing.SIZE)
    bins, placed = collections.defaultdict(list), collections.Counter()
    for length, first, ranks, sequence, wide, offset in runs:
        placed[length] += ranks
        for i in range(ranks):
            bins[sequence + i % wide].append((offset + i // wide * length, length))
    assert placed == collections.Counter(lengths.tolist())
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SIZE
    assert len(bins) == packing.sequences(runs)


@pytest.mark.parametrize("parts", [1, 5])
def test_mixed_rows_are_what_the_mix_takes(spark, parts):
    """Repeated rows, some amid which a source ends, null ids and sources, empty texts and clashing columns."""
    rows = [(i, f"word {i} " * (i % 7), "abc"[i % 3] if i % 10 else None, i) for i in range(120)]
    rows += [(7, "same text again " * 5, "b", k) for k in range(60)] + [(None, "no id", "c", 1)] * 3 + [(5, None, "a", 2), (6, "", "a", 3)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _at long").withColumns({"_cut": F.lit(1), "_number": F.lit("x"), "key": F.lit(0)})
    df = df.repartition(parts)
    taken = collections.Counter()
    for r in mixing.mix(df).collect():
        taken[r["doc_id"], r["source"], r["_print"]] += r["times"]
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    got = collections.Counter(
        (r["doc_id"], r["source"], r["p"]) for r in out.withColumn("p", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    )
    assert got == +taken
    each = collections.Counter((r["doc_id"], r["_at"]) for r in out.where("doc_id = 7 AND source = 'b' AND text LIKE 'same%'").collect())
    assert max(each.values()) - min([*each.values(), *([0] * (60 - len(each)))][: 60]) <= 1  # copies differ by one time at most
    assert mixing.mixed_rows(df.limit(0)).count() == 0


def test_a_source_that_ends_amid_repeated_rows(spark):
    rows = [(1, "one two three four", "a")] * 50 + [(2, "w " * 350, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    times = [r["times"] for r in mixing.mix(df).where("source = 'a'").collect()]
    assert len(set(times)) == 2  # some of the equal rows are taken once more, others aren't
    assert mixing.mixed_rows(df).where("source = 'a'").count() == sum(times)


def test_mixing_moves_no_text(spark, sf):
    plan = mixing.mixed_rows(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_shared_names_come_back_packed():
    """A row per group and bucket, however many documents there are; every name of every document comes back."""
    rng = np.random.default_rng(0)
    name = rng.integers(0, 50, 4000).astype(np.uint64)
    ids, prints = rng.integers(0, 900, 4000), rng.integers(-5, 5, 4000)
    pairs = np.unique(np.stack([name.view(np.int64), ids, prints], 1), axis=0)
    name, ids, prints = pairs[:, 0].view(np.uint64), pairs[:, 1], pairs[:, 2]
    table = pa.table({c: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for c, v in (("name", name), ("id", ids), ("print", prints))})
    packed = repeats._shared(table, 8)
    assert packed.num_rows <= 8
    got = {(i, p): sorted(np.frombuffer(n, "<u4").tolist()) for i, p, n in zip(*repeats._of_documents(packed).to_pydict().values())}
    want = collections.defaultdict(list)
    for n, i, p in zip(name.tolist(), ids.tolist(), prints.tolist()):
        want[i, p].append(n)
    assert got == {k: sorted(v) for k, v in want.items()}


def test_names_of_documents_travel_slim():
    """Half an id, half a name and half a hash of the text for each entry, and upper halves that are all alike."""
    rng = np.random.default_rng(0)
    texts = ["".join(chr(c) for c in rng.integers(97, 123, 300)) for _ in range(50)]
    ids = [7, None, -3, 1 << 40, *range(46)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "p": rng.integers(-1 << 62, 1 << 62, 50), "text": texts})
    table = pa.Table.from_batches(list(repeats._named([batch], 4)))
    size = {c: sum(map(len, table.column(c).to_pylist())) for c in table.column_names if c != "part"}
    n = size["tag"] // 4
    assert sum(size.values()) == 16 * n and n > 50 * 10
    wide = repeats._wide(table, "name", "<u8")
    assert set(np.frombuffer(wide["id"][0].as_py(), "<i8").tolist()) == {repeats.NO_ID if i is None else i for i in ids}


def test_repeats_of_odd_ids(spark):
    """Ids that are negative, null, beyond 32 bits or held by different texts; documents longer than 65,536 bytes."""
    rng = np.random.default_rng(1)
    text = lambda n: "".join(chr(c) for c in rng.integers(97, 123, n))
    a, b, c = text(60), text(70), text(80)
    rows = [(-5, a), (1, b + "x"), (1, a + b), (1 << 40, text(70_000) + a + c), ((1 << 40) + 1, c + "y" + b), (None, b), (None, a + "!" + c), (9, "aa" * 40_000), (3, "aa" * 40)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # of rows with one id none is the smaller: b is first met in two rows of id 1, and in both it stays
    want = {(-5, 60): 0, (1, 71): 0, (1, 130): 60, (1 << 40, 70_140): 60, ((1 << 40) + 1, 151): 150, (None, 70): 70, (None, 141): 140, (9, 80_000): 80_000, (3, 80): 0}
    assert {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in got} == want
