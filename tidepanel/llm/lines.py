"""Line dedup by pairwise alignment.

Documents overlap when they share a window: consecutive lines, from some line on, with ``MIN_WORDS`` words or more. Such
windows are rare where single short lines are not. Every document is aligned with the first document of each of its
windows, never with all others, so a window shared by a third of the corpus costs one pair per document and nothing is
cut off. Patience diff aligns lines that occur once on both sides, in their longest common order, and works inwards; where
every line is repeated, the first occurrences are aligned, the second ones, and so on. Aligned blocks with ``MIN_WORDS`` words or more are deleted from the later document.

Documents are ordered by (doc_id, digest of the text), null ids first; rows equal in both are one document and stay.
Lines are compared without the white space around them; lines without words are kept and never compared. Null and empty
texts have no lines and stay as they are; an empty table gives none.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.llm.common import byte_classes, flat, free_name, pieces, prefix_hash, read, runs, span_hash, stored

MIN_WORDS = 10
_TABLE = byte_classes(letters_only=False)


def _bounds(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each line the line behind its window, or -1 when its document ends before."""
    upto = np.concatenate([[0], np.cumsum(words)])
    end = np.searchsorted(upto, upto[:-1] + MIN_WORDS)
    last = np.repeat(first[1:], np.diff(first))
    return np.where(end <= last, end, -1)


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A cryptographic digest of each line's bytes: lines are deleted for being equal, and no text can make two collide."""
    raw = data.tobytes()
    lines = (blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(starts.tolist(), ends.tolist()))
    return np.frombuffer(b"".join(lines), "<u8").astype(np.uint64)


def _lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: hashes, word counts and positions of its lines with words, and the windows that start at them."""
    for batch in pieces(batches):
        data, offsets = flat(batch.column("text"))
        starts, ends = runs(_TABLE[data] != 0, offsets)
        breaks = np.flatnonzero(data == 10)
        doc = np.searchsorted(offsets, starts, "right") - 1
        line = np.searchsorted(breaks, starts) + doc  # a new text is a new line
        at = np.flatnonzero(np.diff(line, prepend=-1))
        words = np.diff(np.append(at, len(line)))
        hashes = _digests(data, starts[at], ends[np.append(at[1:], len(line)) - 1] if len(at) else at)
        position = np.searchsorted(breaks, starts[at]) - np.searchsorted(breaks, offsets[doc[at]])
        first = np.searchsorted(doc[at], np.arange(batch.num_rows + 1))
        end = _bounds(words, first)
        whole = np.flatnonzero(end >= 0)
        keys = span_hash(prefix_hash(hashes), whole, end[whole])
        many = pa.array(first, pa.int32())
        as_list = lambda a, kind: pa.ListArray.from_arrays(many, pa.array(a, kind))
        windows = pa.ListArray.from_arrays(pa.array(np.searchsorted(whole, first), pa.int32()), pa.array(keys.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), as_list(hashes.view(np.int64), pa.int64()), as_list(words, pa.int32()),
             as_list(position, pa.int32()), windows],
            names=["doc", "lines", "words", "at", "windows"],
        )


def _rising(seconds: list[int]) -> list[int]:
    """Indices of a longest rising run of ``seconds`` (patience sorting)."""
    tops: list[int] = []
    top_at: list[int] = []
    before = [-1] * len(seconds)
    for i, x in enumerate(seconds):
        k = bisect_left(tops, x)
        before[i] = top_at[k - 1] if k else -1
        tops[k : k + 1] = [x]
        top_at[k : k + 1] = [i]
    out = []
    i = top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _numbered(lines: list[int]) -> list[tuple[int, int]]:
    """Every line with the number of equal ones before it."""
    seen: Counter = Counter()
    out = []
    for x in lines:
        out.append((x, seen[x]))
        seen[x] += 1
    return out


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (i, j) of two sequences of line hashes, rising in both.

    Anchors are lines that occur once on both sides; where there are none, the n-th occurrences of a line on either side.
    """
    out: list[tuple[int, int]] = []
    open_ = [(0, len(a), 0, len(b))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and in_b.get(x) == 1}
        pairs = [(where[x], j) for j, x in enumerate(b[b0:b1], b0) if x in where]
        if not pairs:
            nth = {x: i for i, x in enumerate(_numbered(a[a0:a1]), a0)}
            pairs = [(nth[x], j) for j, x in enumerate(_numbered(b[b0:b1]), b0) if x in nth]
        anchors = [pairs[k] for k in _rising([i for i, _ in pairs])]
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        open_ += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


def common_blocks(a: list[int], b: list[int], words_b: list[int]) -> list[int]:
    """Lines of ``b`` in aligned blocks (consecutive on both sides) that have enough words."""
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words_b[k] for k in block) >= MIN_WORDS:
                out += block
            block = []
        block.append(j)
        last = (i, j)
    return out


def _aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lines_a", "lines", "words", "at")]
        gone = [[at[k] for k in common_blocks(a, b, words)] for a, b, words, at in zip(*columns)]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(gone, pa.list_(pa.int32()))], names=["doc", "gone"])


def _keyed(docs: DataFrame, text: str, name: str) -> DataFrame:
    return docs.withColumn(name, F.struct(F.col("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("p")))


def removals(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc (doc_id, p) and the \\n-split positions of its lines that go, for documents that lose any."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    doc = f"doc struct<doc_id:{kind},p:bigint>"
    rows = _keyed(docs.select("doc_id", F.col(text).alias("text")), "text", "doc").select("doc", "text")
    schema = f"{doc}, lines array<bigint>, words array<int>, at array<int>, windows array<bigint>"
    lines = stored(rows.mapInArrow(_lines, schema))
    holds = lines.select("doc", F.explode("windows").alias("window"))
    first = holds.groupBy("window").agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).where("owner < last")
    pairs = stored(holds.join(first.drop("last"), "window").where("owner < doc").select("doc", "owner").distinct())
    one = lines.drop("windows").dropDuplicates(["doc"])
    later = pairs.join(one, "doc")
    both = later.join(one.select(F.col("doc").alias("owner"), F.col("lines").alias("lines_a")), "owner")
    gone = both.select("doc", "lines_a", "lines", "words", "at").mapInArrow(_aligned, f"{doc}, gone array<int>")
    return stored(gone.where(F.size("gone") > 0).groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone")))


def without_lines(text, gone):
    """The text without the lines at the positions ``gone`` (null: as it is)."""
    lines = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.when(gone.isNull(), text).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))


def dedup_lines(docs: DataFrame, text: str = "text", removed: str | None = None) -> DataFrame:
    """The rows with what is left of their text; ``removed`` names a column for the number of lines that went."""
    doc, gone = free_name(docs, "_doc"), free_name(docs, "_gone")
    cut = removals(docs, text).select(F.col("doc").alias(doc), F.col("gone").alias(gone))
    joined = _keyed(docs, text, doc)
    key = lambda df: [df[f"{doc}.doc_id"], df[f"{doc}.p"]]
    on = [a.eqNullSafe(b) for a, b in zip(key(joined), key(cut))]
    both = joined.join(cut.hint("merge"), on[0] & on[1], "left")  # what goes grows with the corpus: never a broadcast
    count = [F.coalesce(F.size(cut[gone]), F.lit(0)).cast("long").alias(removed)] if removed else []
    return both.select(
        *[without_lines(joined[text], cut[gone]).alias(c) if c == text else joined[f"`{c}`"] for c in docs.columns], *count
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs, removed="n_removed")
    worded = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return out.select(
        "doc_id", F.size(worded).cast("long").alias("n_left"), "n_removed",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars_left"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
