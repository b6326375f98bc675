"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters and digits, A-Z lowered. Features are single words, pairs, and pairs around one word, hashed
into ``SPACE`` coordinates, present or not. Learning rates are per coordinate and the L1 penalty leaves few weights other
than zero, so the model is a short list whose size is bounded by ``SPACE`` and is broadcast. It is fitted in one task on
at most ``FIT_ROWS`` labelled rows, those with the smallest hashes of doc_id; scoring covers every document, whole.
Labels that are null or belong to no document teach nothing; without any label of one kind every score is the base rate.
Null and empty texts get the score of no features; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.llm.common import byte_classes, flat, mixed, pieces, read, word_hashes

SPACE = 1 << 20
FIT_ROWS = 20_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0
FOLDS = 5
_TABLE = byte_classes(letters_only=True)


def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates of each row end to end, and each row's first."""
    h, first = word_hashes(*flat(batch.column("text")), _TABLE)
    row = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(first))
    rows, ids = [row], [h]
    for gap, salt in ((1, 0x1F83D9ABFB41BD6B), (2, 0x5BE0CD19137E2179)):
        near = row[gap:] == row[:-gap]
        ids.append(mixed(h[:-gap][near] * np.uint64(salt) + h[gap:][near]))
        rows.append(row[gap:][near])
    key = np.concatenate(rows) * SPACE + (np.concatenate(ids) >> np.uint64(44)).astype(np.int64)
    key = np.unique(key)
    return key % SPACE, np.searchsorted(key // SPACE, np.arange(batch.num_rows + 1))


class Ftrl:
    """Follow the regularised leader, proximal: weights are derived from the sums z and n when they are needed."""

    def __init__(self, rate: float) -> None:
        self.z, self.n = np.zeros(SPACE), np.zeros(SPACE)
        self.bias = float(np.log(rate / (1 - rate)))

    def weights(self, ids: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        shrunk = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, shrunk)

    def learn(self, ids: np.ndarray, label: float) -> None:
        w = self.weights(ids)
        p = 1 / (1 + np.exp(-np.clip(self.bias + w.sum(), -30, 30)))
        g = p - label
        n = self.n[ids]
        self.z[ids] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[ids] += g * g


def _fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights that aren't zero, and the bias as coordinate -1, from all labelled rows."""
    rows: list[np.ndarray] = []
    order: list[tuple[int, int]] = []
    labels: list[int] = []
    for batch in pieces(batches):
        ids, first = features(batch)
        rows += [ids[first[i] : first[i + 1]].astype(np.int32) for i in range(batch.num_rows)]
        labels += batch.column("toxic").to_pylist()
        order += [(h, i) for i, h in enumerate(batch.column("turn").to_pylist(), len(order))]
    order.sort()
    rate = min(max(float(np.mean(labels)) if labels else 0.5, 1e-3), 1 - 1e-3)
    model = Ftrl(rate)
    for _ in range(EPOCHS):
        for _, i in order:
            model.learn(rows[i], labels[i])
    w = model.weights(slice(None))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), pa.array(np.append(w[at], model.bias))], names=["id", "weight"]
    )


def fit(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates, weights and bias from (doc_id, text, toxic); at most ``SPACE`` numbers reach the driver."""
    turn = F.xxhash64(F.col("doc_id"))
    known = labelled.where("toxic IS NOT NULL")
    found = (
        known.select(turn.alias("turn"), "text", F.col("toxic").cast("int").alias("toxic"))
        .repartition(1).mapInArrow(_fitted, "id bigint, weight double").collect()
    )
    table = {r["id"]: r["weight"] for r in found}
    bias = table.pop(-1, 0.0)
    ids = np.array(sorted(table), np.int64)
    return ids, np.array([table[i] for i in ids.tolist()]), bias


def _scored(batches: Iterable[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    ids, weights, bias = model.value
    dense = np.zeros(SPACE, np.float32)
    dense[ids] = weights
    for batch in pieces(batches):
        at, first = features(batch)
        upto = np.concatenate([[0.0], np.cumsum(dense[at], dtype=np.float64)])
        x = np.clip(bias + upto[first[1:]] - upto[first[:-1]], -30, 30)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(1 / (1 + np.exp(-x)))], names=["doc_id", "held_out", "score"]
        )


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Texts and labels of the ``rows`` labelled ids, outside the held-out fold, with the smallest hashes."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most ``rows`` pairs of numbers.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def scores(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """One row per row: doc_id, held_out, score, predicted."""
    plain = docs.select("doc_id", F.col(text).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(plain, labels)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = plain.withColumn("held_out", fold(F.col("doc_id")) == 0).select("doc_id", "held_out", "text")
    scored = out.mapInArrow(partial(_scored, model=model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
