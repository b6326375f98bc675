"""Exact dedup over a minimal perfect hash of the distinct digests seen before.

History is hashed into shards of about ``SHARD`` digests; each shard gets a minimal perfect hash by displacement: keys of
a bucket share two displacements that put them into free slots, so n digests fill slots 0..n-1. A slot holds the whole
digest and the locator (doc_id) of the winner. A lookup computes one slot and compares all 32 bytes: equal means member.
Digests that are no members group among themselves. The largest doc_id of a group stays. Nulls count as empty texts,
null ids lose against any other, rows that share the winning id all stay, an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.llm.common import lower_ascii, read, stored

SHARD = 4096
PER_BUCKET = 3
TRIES = 1 << 16
PRIME = 4294967291  # the largest below 2^32


def digest(text: Column) -> Column:
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))), 256)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("text_sha256"))


def _part(k: int) -> Column:
    """The k-th 32 bits of a digest."""
    return F.conv(F.substring("text_sha256", 8 * k + 1, 8), 16, 10).cast("long")


def displaced(bucket: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements (p, q) per key, equal within a bucket: ((a + p*b) mod PRIME + q) mod n are 0..n-1 in some order."""
    n = len(bucket)
    free = np.ones(n, bool)
    p, q = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(bucket, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
    step = np.arange(min(n, 256))
    for keys in sorted(groups, key=len, reverse=True):
        for t in range(TRIES):
            at = ((a[keys] + t * b[keys]) % PRIME)[:, None] + step + t
            at %= n
            if len(keys) == 1:
                p[keys], q[keys] = t, (np.argmax(free) - at[0, 0] + t) % n
                break
            good = free[at].all(0) & (np.diff(np.sort(at, 0), axis=0) > 0).all(0)
            if good.any():
                p[keys], q[keys] = t, (np.argmax(good) + t) % n
                break
        else:
            raise ValueError("no displacement found for a bucket")
        free[((a[keys] + p[keys] * b[keys]) % PRIME + q[keys]) % n] = False
    return p, q


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    n = len(pdf)
    parts = [pdf.text_sha256.str.slice(8 * k, 8 * k + 8).map(lambda x: int(x, 16)).to_numpy(np.int64) for k in (1, 2, 3)]
    bucket = parts[0] % (n // PER_BUCKET + 1)
    p, q = displaced(bucket, parts[1], parts[2])
    slot = ((parts[1] + p * parts[2]) % PRIME + q) % n
    return pd.DataFrame({
        "shard": pdf.shard, "n": n, "bucket": bucket, "p": p, "q": q, "slot": slot, "digest": pdf.text_sha256, "winner": pdf.winner,
    })


def build(history: DataFrame) -> tuple[DataFrame, int]:
    """Index of the distinct digests of ``digests`` rows (one row per slot), and the number of shards."""
    distinct = stored(history.groupBy("text_sha256").agg(F.max("doc_id").alias("winner")))
    shards = max(1, -(-distinct.count() // SHARD))
    keyed = distinct.withColumn("shard", _part(0) % shards)
    schema = "shard long, n long, bucket long, p long, q long, slot long, digest string, winner long"
    return stored(keyed.groupBy("shard").applyInPandas(_shard, schema)), shards


def lookup(rows: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Add shard, slot, winner (null for nonmembers) and member to ``digests`` rows."""
    sizes = index.select("shard", "n").distinct()
    seeds = index.select("shard", "bucket", "p", "q").distinct()
    at = rows.withColumn("shard", _part(0) % shards).join(sizes, "shard", "left")
    at = at.withColumn("bucket", _part(1) % (F.floor(F.col("n") / PER_BUCKET) + 1)).join(seeds, ["shard", "bucket"], "left")
    at = at.withColumn("slot", ((_part(2) + F.col("p") * _part(3)) % PRIME + F.col("q")) % F.col("n"))
    found = at.join(index.select("shard", "slot", "digest", "winner"), ["shard", "slot"], "left")
    member = F.coalesce(F.col("digest") == F.col("text_sha256"), F.lit(False))
    return found.select(
        "doc_id", "text_sha256", F.when(member, F.col("shard")).alias("shard"), F.when(member, F.col("slot")).alias("slot"),
        F.when(member, F.col("winner")).alias("winner"), member.alias("member"),
    )


def exact_dedup(docs: DataFrame, history: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, member (its text is in ``history``)."""
    index, shards = build(digests(history, doc_id, text))
    rows = stored(lookup(digests(docs, doc_id, text), index, shards))
    count = F.count(F.lit(1)).alias("group_size")
    members = rows.where("member").groupBy("shard", "slot").agg(
        F.greatest(F.max("doc_id"), F.max("winner")).alias("keep_id"), count
    )
    others = rows.where("not member").groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), count)
    joined = (
        rows.where("member").join(members, ["shard", "slot"])
        .select("doc_id", "keep_id", "group_size", "text_sha256", "member")
        .unionByName(
            rows.where("not member").join(others, "text_sha256")
            .select("doc_id", "keep_id", "group_size", "text_sha256", "member")
        )
    )
    return joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History is the older half of the id range; all documents are looked up in it, or grouped beside it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    cut = 0 if low is None else (low + high) // 2
    return exact_dedup(docs, docs.where(F.col("doc_id") <= cut))
