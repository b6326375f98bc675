"""Shared helpers: tables, numpy views of Arrow text, vectorised word hashes, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.session import materialise, ship

SPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHUNK_BYTES = 2 << 20
ODD = 0x9E3779B97F4A7C15


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame doesn't have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def words(text: Column) -> Column:
    """Words of a text, split at ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read back; shuffle files of the write are given up as soon as it is done."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        return materialise(df, *partition_by)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of text, or a single longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and where each row starts (nulls are empty)."""
    values = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_classes(letters_only: bool) -> np.ndarray:
    """Per byte: 0 between words, else the byte that is hashed (A-Z lowered). UTF-8 continuation bytes count as letters."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[32, 9, 10, 11, 12, 13]] = 0
    if letters_only:
        table[[b for b in range(128) if not chr(b).isalnum()]] = 0
    else:
        table[0] = 255  # a NUL in a word
    return table


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, cut at row boundaries."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    inner = offsets[:-1][offsets[:-1] < len(mask)]
    before[inner] = False
    after = np.empty_like(mask)
    after[-1], after[:-1] = False, mask[1:]
    after[inner[inner > 0] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int = 0xD6E8FEB86659FD93) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.cumprod(table, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of the bytes modulo 2^64; one entry more than bytes."""
    up, _ = _POWERS.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= up[:-1]
    np.cumsum(terms, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of bytes [start, end): equal bytes give equal hashes wherever they stand."""
    _, down = _POWERS.upto(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(ODD))


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each row the index of its first word (one entry more than rows)."""
    kept = table[data]
    starts, ends = runs(kept != 0, offsets)
    return span_hash(prefix_hash(kept), starts, ends), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words per row (a shorter row: one of all its words), and each row's first."""
    counts = np.diff(first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), made)
    begin = np.cumsum(made) - made
    at = first[:-1][row] + np.arange(len(row)) - begin[row]
    end = first[1:][row]
    out = np.zeros(len(row), np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for k in range(size):
        out = out * np.uint64(0x9DDFEA08EB382D69) + np.where(at + k < end, padded[at + k], np.uint64(0))
    return mixed(out), np.concatenate([[0], np.cumsum(made)])


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of the links; root is the least node of its component.

    Large-star and small-star steps in turn until nothing changes: each is a grouped minimum with map-side combine and a
    join, so no component and no hub is gathered anywhere; what is stored per round is at most one row per link.
    """
    edges = stored(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), "m")
        after = stored(small.select("u", F.col("m").alias("v")).where("u <> v").distinct())
        if _print(after) == _print(edges):
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = after


def _print(edges: DataFrame) -> tuple:
    """Size and checksum of a set of edges: two numbers, whatever its size."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]
