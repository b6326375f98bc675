"""Filters of near-duplicate pairs: what they pass over is no link; texts are sampled in small chunks."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidepanel.llm import neardup


def _batch(texts, **more):
    return pa.RecordBatch.from_pydict({"node": [str(i).encode() for i in range(len(texts))], "text": texts, **more})


def _texts(rng, groups, size, length, changed):
    """Groups of texts that differ from one base text in single words."""
    out = []
    for g in range(groups):
        base = [f"w{g}x{i}" for i in range(length)]
        for _ in range(size):
            words = list(base)
            for at in rng.choice(length, rng.integers(0, changed + 1), replace=False):
                words[at] = f"n{rng.integers(1 << 40)}"
            out.append(" ".join(words[: rng.integers(length - 8, length + 1)]))
    return out


def test_rarest_shingles_lead_to_all_similar_texts(spark):
    rng = np.random.default_rng(3)
    texts = _texts(rng, 3, 25, 60, 5) + ["a b c d e f g h", "b c d e f g h", "a b c d e f g h i", "a b c d e f g"]  # 4 of 5 shingles shared
    weights = SimpleNamespace(value=(1 + rng.random(neardup.BUCKETS)).astype(np.float32))
    h, w, first = neardup.weighted(*neardup._shingles(_batch(texts)), weights.value)
    own = [(h[a:b], w[a:b]) for a, b in zip(first[:-1], first[1:])]
    alike = {(i, j) for i in range(len(texts)) for j in range(i) if neardup.similar(own[i], own[j], 0.8)}
    (short,) = neardup._short([_batch(texts)], weights, 0.8)
    rows = spark.createDataFrame(pa.Table.from_batches([short]))
    rows = rows.withColumn("node", F.col("node").cast("string").cast("int"))
    other = rows.select([F.col(c).alias(f"{c}2") for c in rows.columns])
    got = {(r["node"], r["node2"]) for r in rows.join(other, F.col("node") > F.col("node2")).where(neardup._may_reach(0.8)).collect()}
    assert (77, 75) in alike  # 4 of 5 shingles
    assert alike and alike <= got
    assert len(got) < 0.8 * len(texts) * (len(texts) - 1) / 2


def test_texts_apart_give_few_pairs(spark, monkeypatch):
    """Texts of one bucket that are less similar than the threshold are no pairs to compare, however many there are."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(120):
        words = list(base)
        for at in rng.choice(200, 7, replace=False):
            words[at] = f"n{k}x{at}"
        texts.append(" ".join(words))
    counts, links = [], neardup._links

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(neardup, "_links", counted)
    out = neardup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(out) == len(texts)
    assert counts[1] < 1000  # of 7140 pairs


def test_texts_are_sampled_in_small_chunks(monkeypatch):
    texts = [f"{i} " + "some words that are repeated in a text of no great length " * 20 for i in range(1500)]  # 1.8 MB
    sizes, sampled = [], neardup.Sampler.__call__
    monkeypatch.setattr(neardup.Sampler, "__call__", lambda s, h, w, f: sizes.append(len(h)) or sampled(s, h, w, f))
    weights = SimpleNamespace(value=np.ones(neardup.BUCKETS, np.float32))
    assert sum(b.num_rows for b in neardup._banded([_batch(texts)], weights)) == len(texts)
    assert len(sizes) > 10 and max(sizes) <= neardup.CHUNK
