"""Removal of repeated byte strings with longest-previous-factor arrays.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller doc_id.

1. Every ``LENGTH``-byte window is named by the least hash of its ``GRAM``-byte strings, so equal windows have equal names
   and neighbours mostly share one. Names are counted over all documents; a name that only one document has can't belong
   to a repeated window, and its windows are done. Shared names go back to their documents packed, a row per group of names
   and bucket of documents.
2. The windows left travel as short segments to the task of their name. Equal segments met in one task are settled there:
   all but the one of the smallest doc_id go. Each task sorts the suffixes of its segments, takes for every suffix the
   previous and next smaller document in suffix order, and the longer of the two common prefixes is its longest previous
   factor, cut at ``LENGTH``.
3. Removed spans are united per document.

Null texts are empty; rows that share doc_id and text are one document; null ids count as larger than all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.llm.common import flat, mixed, pieces, prefix_hash, read, runs, span_hash, stored

LENGTH, GRAM = 50, 24
PART_BYTES = 4 << 20  # of text per group of names
CHUNK = 1 << 17  # bytes of text hashed at a time: the arrays made of them stay in a core's cache
FLUSH = 500_000  # names, or a quarter of the segment bytes, that a task holds before it passes them on
NO_ID = np.iinfo(np.int64).max


def names(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one name: name, first window, window behind the last, row."""
    n = len(data) - LENGTH + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return np.zeros(0, np.uint64), empty, empty, empty
    prefix = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    low = span_hash(prefix, at, at + GRAM)
    for step in (1, 2, 4, 8):
        low = np.minimum(low[:-step], low[step:])
    wide = LENGTH - GRAM + 1  # grams in a window; low now covers 16
    low = np.minimum(low[: len(low) - (wide - 16)], low[wide - 16 :])[:n]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    fits = np.arange(n) + LENGTH <= offsets[1:][row]
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1]) | (fits[1:] != fits[:-1])
    first = np.flatnonzero(new)
    behind = np.append(first[1:], n)
    good = fits[first]
    return low[first][good], first[good], behind[good], row[first][good]


def _tags(name: np.ndarray) -> np.ndarray:
    """32 bits of a name that don't follow from its group. They only say which windows travel on, where all bytes are
    compared, so two names that share them cost a segment and no result."""
    return (mixed(name) >> np.uint64(32)).astype("<u4")


def _halves(column: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Lower and upper half of integers as two columns: the upper ones are mostly alike and so shrink to nothing when moved."""
    half = np.ascontiguousarray(values).view(f"<u{values.itemsize // 2}").reshape(-1, 2)
    return {column: half[:, 0], f"{column}_high": half[:, 1]}


def _whole(low: np.ndarray, high: np.ndarray, kind: str) -> np.ndarray:
    return np.column_stack([low, high]).view(kind).ravel()


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False), batch.column("p").to_numpy()


def _packed(part: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each group of names: its entries' columns as bytes."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    at = np.flatnonzero(np.diff(part, prepend=-2))
    cut = np.append(at, len(part))
    out = [pa.array(part[at].astype(np.int32))]
    for values in columns.values():
        values = np.ascontiguousarray(values[order])
        width = values.itemsize
        out.append(pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer((cut * width).astype(np.int64)), pa.py_buffer(values)]))
    return pa.RecordBatch.from_arrays([out[0], *[x.cast(pa.binary()) for x in out[1:]]], names=["part", *columns])


def _named(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Distinct (name, document) pairs, packed by group of names. Documents are told apart by id and 32 bits of their text's
    hash: rows with one id that agree in these get each other's names, which flags no window that its own wouldn't."""
    held: list[tuple[np.ndarray, ...]] = []
    n = 0

    def passed() -> pa.RecordBatch:
        name, ids, prints = (np.concatenate(x) for x in zip(*held))
        return _packed((name % np.uint64(parts)).astype(np.int64), {"tag": _tags(name), **_halves("id", ids), "print": prints})

    for batch in pieces(batches, limit=CHUNK):
        ids, prints = _ids(batch)
        name, _, _, row = names(*flat(batch.column("text")))
        order = np.lexsort((name, row))
        name, row = name[order], row[order]
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
        if new.any():
            held.append((name[new], ids[row[new]], prints[row[new]].astype("<u4")))
            n += int(new.sum())
        if n >= FLUSH:
            yield passed()
            held, n = [], 0
    if n:
        yield passed()


def _joined(table: pa.Table, **kinds: str) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in kinds.items()]


def _wide(table: pa.Table, name: str, kind: str, print_: str = "print") -> pa.Table:
    """Entries with whole ids again, as one row; a tag stands for the name."""
    tag, low, high, prints = _joined(table, tag="<u4", id="<u4", id_high="<u4", print="<u4")
    columns = {name: tag.astype(kind), "id": _whole(low, high, "<i8"), print_: prints.astype("<i8")}
    return pa.table({c: pa.array([values.tobytes()], pa.binary()) for c, values in columns.items()})


def _slim(table: pa.Table) -> pa.Table:
    """The rows of ``_shared`` as they travel: 4 bytes of tag, print and half an id for each entry."""
    rows = []
    for part, ids, prints, tags in zip(*(table.column(c).to_pylist() for c in ("part", "id", "p", "names"))):
        halves = [x.tobytes() for x in _halves("id", np.frombuffer(ids, "<i8")).values()]
        rows.append((part, *halves, np.frombuffer(prints, "<i8").astype("<u4").tobytes(), tags))
    kinds = {"part": pa.int32(), "id": pa.binary(), "id_high": pa.binary(), "print": pa.binary(), "tag": pa.binary()}
    return pa.table({c: pa.array([r[k] for r in rows], kind) for k, (c, kind) in enumerate(kinds.items())})


def _shared(table: pa.Table, parts: int) -> pa.Table:
    """Names of the group that documents with different ids have, their low 32 bits, packed by bucket of documents.

    They only say which windows travel on, where all bytes are compared, so one too many costs a segment and no result.
    """
    name, ids, prints = _joined(table, name="<u8", id="<i8", print="<i8")
    order = np.lexsort((ids, name))
    name, ids, prints = name[order], ids[order], prints[order]
    at = np.flatnonzero(np.diff(name, prepend=name[0] + np.uint64(1)))
    size = np.diff(np.append(at, len(name)))
    last = at + size - 1
    many = np.repeat(ids[at] != ids[last], size)
    name, ids, prints = name[many], ids[many], prints[many]
    bucket = mixed(mixed(ids.view(np.uint64)) ^ prints.view(np.uint64)) % np.uint64(parts)
    return pa.Table.from_batches([_packed(bucket.astype(np.int64), {"id": ids, "p": prints, "names": name.astype("<u4")})])


def _of_documents(table: pa.Table) -> pa.Table:
    """One row for each document of a bucket: its shared names, from all groups."""
    ids, prints, name = _joined(table, id="<i8", p="<i8", names="<u4")
    order = np.lexsort((prints, ids))
    name, ids, prints = name[order], ids[order], prints[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])
    at = np.flatnonzero(new)
    cut = np.append(at, len(ids)) * 4
    blobs = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(name)])
    return pa.table({"id": ids[at], "p": prints[at], "names": blobs.cast(pa.binary())})


def _segments(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Segments of windows with shared names, packed by group; spans settled within the task have part -1."""
    held: list[tuple[np.ndarray, ...]] = []
    n = 0

    def passed() -> Iterator[pa.RecordBatch]:
        name, ids, prints, start, length = (np.concatenate(x) for x in list(zip(*held))[:5])
        body = np.concatenate([x[5] for x in held])
        begin = np.cumsum(length) - length
        same = span_hash(prefix_hash(body), begin, begin + length)
        order = np.lexsort((ids, same))
        new = np.ones(len(order), bool)
        new[1:] = same[order][1:] != same[order][:-1]
        leader = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = np.zeros(len(order), bool)
        later[order] = ids[order] > ids[leader]
        if later.any():
            gone = np.flatnonzero(later)
            yield _packed(np.full(len(gone), -1), {
                **_halves("id", ids[gone]), "print": prints[gone], **_halves("start", start[gone]),
                **_halves("length", length[gone].astype("<i4")), "body": np.zeros(len(gone), np.uint8),
            })
        keep = np.flatnonzero(~later)
        if not len(keep):
            return
        part = (name[keep] % np.uint64(parts)).astype(np.int64)
        keep = keep[np.argsort(part, kind="stable")]
        part = np.sort(part, kind="stable")
        size = length[keep]
        at = np.repeat(begin[keep] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        batch = _packed(part, {
            **_halves("id", ids[keep]), "print": prints[keep], **_halves("start", start[keep]), **_halves("length", size.astype("<i4"))
        })
        bodies = _packed(np.repeat(part, size), {"body": body[at]})
        yield pa.RecordBatch.from_arrays([*batch.columns, bodies.column("body")], names=[*batch.schema.names, "body"])

    for batch in pieces(batches, limit=CHUNK):
        ids, prints = _ids(batch)
        data, offsets = flat(batch.column("text"))
        name, first, behind, row = names(data, offsets)
        packed, at = flat(batch.column("names"))
        owner = np.repeat(np.arange(batch.num_rows, dtype=np.uint64), np.diff(at) // 4)
        flags = np.frombuffer(packed.tobytes(), "<u4").astype(np.uint64)
        keyed = lambda h, r: mixed(h + (r.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        got = np.isin(keyed(_tags(name).astype(np.uint64), row), keyed(flags, owner))
        name, first, behind, row = name[got], first[got], behind[got], row[got]
        if len(name):
            length = behind - first + LENGTH - 1
            at = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())
            held.append((name, ids[row], prints[row], (first - offsets[row]).astype("<i4"), length, data[at]))
            n += int(length.sum())
        if n >= FLUSH * 4:
            yield from passed()
            held, n = [], 0
    if n:
        yield from passed()


def previous_factors(text: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Longest previous factor, 0 or ``LENGTH``, of the suffixes at ``starts``: its longest match in a smaller document.

    Suffixes are sorted by their first ``LENGTH`` bytes and, where these are equal, by document, so the previous smaller
    document in suffix order is the nearest with the same bytes, and the next smaller one has others.
    """
    view = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[starts]
    keys = np.ascontiguousarray(view).view(f"S{LENGTH}").ravel()
    by_doc = np.argsort(doc, kind="stable")
    order = by_doc[np.argsort(keys[by_doc], kind="stable")]
    k, d = keys[order], doc[order]
    equal = np.zeros(len(order), bool)
    equal[1:] = k[1:] == k[:-1]
    head = np.maximum.accumulate(np.where(equal, 0, np.arange(len(order))))
    out = np.zeros(len(order), np.int64)
    out[order] = np.where(d > d[head], LENGTH, 0)
    return out


def _spans(table: pa.Table) -> pa.Table:
    """Spans of the group's segments that an earlier document has too."""
    halves = {f"{c}{h}": kind for c, kind in (("id", "<u4"), ("start", "<u2"), ("length", "<u2")) for h in ("", "_high")}
    prints, *rest = _joined(table, print="<i8", **halves)
    ids, start, length = (_whole(*rest[i : i + 2], kind).astype(np.int64) for i, kind in ((0, "<i8"), (2, "<i4"), (4, "<i4")))
    if table.column("part")[0].as_py() < 0:
        first, behind, row = start, start + length, np.arange(len(ids))
    else:
        text = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint8)
        begin = np.cumsum(length) - length
        count = length - LENGTH + 1
        row = np.repeat(np.arange(len(ids)), count)
        within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        gone = previous_factors(text, begin[row] + within, ids[row]) >= LENGTH
        row, within = row[gone], within[gone]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (within[1:] != within[:-1] + 1)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(row)) - 1
        row = row[at]
        first = start[row] + within[at]
        behind = start[row] + within[last] + LENGTH if len(at) else first
    return pa.table({"id": ids[row], "p": prints[row], "first": first.astype(np.int64), "behind": behind.astype(np.int64)})


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        data, offsets = flat(batch.column("text"))
        spans = batch.column("spans")
        row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
        first, behind = (offsets[row] + spans.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("first", "behind"))
        n = len(data) + 1
        gone = np.cumsum(np.bincount(first, minlength=n) - np.bincount(behind, minlength=n))[:-1] > 0
        count = np.diff(np.searchsorted(runs(gone, offsets)[0], offsets))
        at = np.append(0, np.cumsum(~gone))[offsets]
        rest = data[~gone].tobytes()
        kept = [rest[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        size, left = np.diff(offsets), np.diff(at)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (size, size - left, count)],
             pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left)."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("p"), F.col(text).alias("text")
    )
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, size // PART_BYTES)
    entries = "part int, tag binary, id binary, id_high binary, print binary"
    packed = plain.mapInArrow(partial(_named, parts=parts), entries)
    dealt = lambda df: df.repartition(parts + 1, "part").groupBy("part")

    def shared_names(table: pa.Table) -> pa.Table:
        return _slim(_shared(_wide(table, "name", "<u8"), parts))

    def of_documents(table: pa.Table) -> pa.Table:
        return _of_documents(_wide(table, "names", "<u4", "p"))

    shared = stored(dealt(packed).applyInArrow(shared_names, entries))
    by_doc = dealt(shared).applyInArrow(of_documents, "id long, p long, names binary").withColumnRenamed("p", "print")
    id_ = F.coalesce("doc_id", F.lit(int(NO_ID)))
    low = F.col("p").bitwiseAND(F.lit(0xFFFFFFFF))
    with_names = plain.withColumns({"id": id_, "print": low}).join(by_doc, ["id", "print"]).select("doc_id", "p", "text", "names")
    schema = "part int, id binary, id_high binary, print binary, start binary, start_high binary, length binary, length_high binary, body binary"
    spans = stored(dealt(with_names.mapInArrow(partial(_segments, parts=parts), schema)).applyInArrow(_spans, "id long, p long, first long, behind long"))
    per_doc = spans.groupBy("id", "p").agg(F.collect_list(F.struct("first", "behind")).alias("spans"))
    joined = plain.withColumn("id", id_).join(per_doc, ["id", "p"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")
