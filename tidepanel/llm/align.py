"""Alignment of two tokenizers over the same text, in Arrow tables within tasks and counted by Spark across them.

Per chunk of documents: both tokenizers give list arrays of ids; flattened ids and their parent indices, with cumulative
sums of byte lengths restarted at each parent, give (document, end) keys. An Acero full outer join of both sides on that key
has one row per stretch of bytes that a single pair of tokens covers, which is one link; a row found on both sides ends a
group. Pairs are counted per block of documents by ``Table.group_by``, Spark sums these partial counts, and each block gets
back the totals of its own pairs only, so nothing that grows with the corpus is broadcast (best counts: one row per id of B).

Null or empty texts, and texts that either tokenizer doesn't give back byte for byte, have no tokens: zeros and ''. Repeated
rows and null ids count each on its own, other columns are ignored, an empty table gives none. Strings of special tokens
are plain text. A document is tokenised whole, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.llm.common import flat, pieces, read, stored
from tidepanel.llm.packing import Encoder

LEFT, RIGHT = "byte_bpe_50k", "piece_bpe_32k"
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
RIGHT_BITS = 20  # a pair is (id of A) << RIGHT_BITS | (id of B)
END_BITS = 32
MARK = "▁"
PER_DOC = ("n_a", "n_b", "n_groups", "n_links")
SCHEMA = (
    "block long, ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "sha array<string>, groups array<string>, links binary, pairs array<long>, counts array<long>"
)


def cut_lists(cuts: pa.Array, encode) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all cuts end to end and each cut's first; ``encode`` sees every distinct cut once, told apart by its bytes."""
    distinct = cuts.dictionary_encode()
    bag, at, sizes = encode(distinct.dictionary.to_pylist())
    index = distinct.indices.to_numpy()
    counts = sizes[index]
    upto = np.concatenate([[0], np.cumsum(counts)])
    return bag[np.repeat(at[index] - upto[:-1], counts) + np.arange(upto[-1])], upto


class Side:
    """One tokenizer: ids of texts as a list array, and the bytes of every id."""

    vocabulary: pa.Array

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def each(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raise NotImplementedError

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids per text; every text begins with a space."""
        data, offsets = flat(texts)
        begin = self.starts(data, offsets)
        cuts = pa.StringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(data)).astype(np.int32)), pa.py_buffer(data))
        ids, upto = cut_lists(cuts, self.each)
        return pa.ListArray.from_arrays(pa.array(upto[np.searchsorted(begin, offsets)].astype(np.int32)), pa.array(ids.astype(np.int32)))


class ByteSide(Side):
    """Byte-level pairs; cut where the vocabulary's pattern cuts."""

    def __init__(self, name: str) -> None:
        self.encoder = Encoder(name)
        entries = [b""] * (max(self.encoder.ranks.values()) + 1)
        for entry, i in self.encoder.ranks.items():
            entries[i] = entry
        self.vocabulary = pa.array(entries, pa.large_binary())

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        return lead[self.encoder.cuts(points, np.searchsorted(lead, offsets))]

    def each(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encoder.each(cuts)


class PieceSide(Side):
    """Pieces with a mark for spaces. No piece has a mark behind another character, so a run of spaces starts a cut."""

    def __init__(self, name: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in names):
            raise ValueError("a piece of this vocabulary spans a space; texts can't be cut there")
        self.vocabulary = pa.array(
            [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)],
            pa.large_binary(),
        )
        self.space = self.model.piece_to_id(MARK)

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        space = data == 32
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[offsets[:-1][offsets[:-1] < len(data)]] = True
        return np.flatnonzero(first)

    def each(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = self.model.encode([c[1:] for c in cuts], num_threads=1)  # the model adds the first space again
        lists = [x if c != " " else [self.space] for c, x in zip(cuts, lists)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.int32, int(sizes.sum())), np.cumsum(sizes) - sizes, sizes


_SIDES: dict[tuple[str, str], tuple[ByteSide, PieceSide]] = {}


def sides(left: str, right: str) -> tuple[ByteSide, PieceSide]:
    """Both tokenizers, loaded once per Python worker."""
    if (left, right) not in _SIDES:
        _SIDES[left, right] = ByteSide(left), PieceSide(right)
    return _SIDES[left, right]


def same_bytes(lists: pa.Array, vocabulary: pa.Array, texts: pa.Array) -> np.ndarray:
    """Per text: whether its tokens' bytes, joined, are the text's."""
    data, offsets = flat(texts)
    joined, ends = flat(pc.take(vocabulary, pc.list_flatten(lists)))
    mine = ends[lists.offsets.to_numpy()]
    equal = np.diff(mine) == np.diff(offsets)
    if equal.all():
        wrong = np.flatnonzero(joined != data)
        equal[np.searchsorted(offsets, wrong, "right") - 1] = False
    else:
        for r in np.flatnonzero(equal):
            equal[r] = np.array_equal(joined[mine[r] : mine[r + 1]], data[offsets[r] : offsets[r + 1]])
    return equal


def ends_of(lists: pa.Array, vocabulary: pa.Array, name: str) -> pa.Table:
    """(key, id) per token: the key holds the document's index and the byte where the token ends within it."""
    ids, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    running = pc.cumulative_sum(pc.binary_length(pc.take(vocabulary, ids)).cast(pa.int64()))
    before = pa.concat_arrays([pa.array([0], pa.int64()), running])
    within = pc.subtract(running, pc.take(before, pc.take(lists.offsets, parent)))  # the sum restarts at each parent
    return pa.table({"key": pc.add(pc.shift_left(parent, END_BITS), within), name: ids})


def decimals(ids: pa.Array, ends: np.ndarray) -> pa.Array:
    """Per group (ends: rank behind its last id): its ids in decimal, joined by commas."""
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, ids.cast(pa.string())), ",")


def aligned_chunk(texts: pa.Array, left: Side, right: Side) -> tuple[dict[str, np.ndarray], list[str], np.ndarray]:
    """Counts per text, group strings per text ('' without tokens), and the pairs of all links in text order."""
    n = len(texts)
    given = pc.fill_null(texts.cast(pa.large_string()), "")
    rows = np.flatnonzero(pc.greater(pc.binary_length(given), 0).to_numpy(zero_copy_only=False))
    out = {c: np.zeros(n, np.int64) for c in PER_DOC}
    groups = [""] * n
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pc.take(given, pa.array(rows)), pa.scalar("", pa.large_string()))
    a, b = left.encode(spaced), right.encode(spaced)
    good = same_bytes(a, left.vocabulary, spaced) & same_bytes(b, right.vocabulary, spaced)
    if not good.all():
        rows, a, b = rows[good], a.filter(pa.array(good)), b.filter(pa.array(good))
    if not len(rows):
        return out, groups, np.zeros(0, np.int64)
    ta, tb = ends_of(a, left.vocabulary, "a"), ends_of(b, right.vocabulary, "b")
    met = ta.join(tb, keys="key", join_type="full outer", use_threads=False).combine_chunks()
    met = met.take(pc.sort_indices(met["key"]))
    ids_a, ids_b = met["a"].combine_chunks(), met["b"].combine_chunks()
    at_a, at_b = (pc.is_valid(x).to_numpy(zero_copy_only=False) for x in (ids_a, ids_b))
    both = at_a & at_b
    doc = pc.shift_right(met["key"], END_BITS).to_numpy()
    pairs = pc.bit_wise_or(
        pc.shift_left(pc.fill_null_backward(ids_a).cast(pa.int64()), RIGHT_BITS), pc.fill_null_backward(ids_b).cast(pa.int64())
    ).to_numpy()
    counts = np.bincount(doc[both], minlength=len(rows))
    out["n_links"][rows] = np.bincount(doc, minlength=len(rows))
    out["n_groups"][rows] = counts
    out["n_a"][rows], out["n_b"][rows] = (pc.list_value_length(x).to_numpy() for x in (a, b))
    each = pc.binary_join_element_wise(
        decimals(ta["a"].combine_chunks(), np.cumsum(at_a)[both]), decimals(tb["b"].combine_chunks(), np.cumsum(at_b)[both]), "|"
    )
    upto = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    for r, text in zip(rows.tolist(), pc.binary_join(pa.ListArray.from_arrays(upto, each), ";").to_pylist()):
        groups[r] = text
    return out, groups, pairs


def squeezed(codes: np.ndarray) -> bytes:
    """Codes as four planes of bytes, compressed: frequent pairs have small codes, so the upper planes are nearly empty."""
    return pa.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def released(data: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b""
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<u4").reshape(n)


def block_rows(block: int, chunks: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """One row per chunk; the first also holds the block's distinct pairs and how many links have them."""
    pairs = pa.table({"pair": np.concatenate([c[3] for c in chunks])})
    counted = pairs.group_by("pair", use_threads=False).aggregate([("pair", "count")]).sort_by([("pair_count", "descending"), ("pair", "ascending")])
    codes = pc.index_in(pairs["pair"], counted["pair"]).to_numpy()
    rows, done = [], 0
    for k, (ids, per_doc, shown, own) in enumerate(chunks):
        row = {"block": block, "ids": ids, **{c: per_doc[c] for c in PER_DOC}}
        row["sha"] = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in shown[0]]
        row["groups"] = shown[1]
        row["links"] = squeezed(codes[done : done + len(own)])
        row["pairs"] = counted["pair"].to_numpy() if k == 0 else []
        row["counts"] = counted["pair_count"].to_numpy() if k == 0 else []
        rows.append(row)
        done += len(own)
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def aligner(kind: pa.DataType, left: str, right: str, show: bool):
    schema = pa.schema([
        ("block", pa.int64()), ("ids", pa.list_(kind)), *[(c, pa.list_(pa.int64())) for c in PER_DOC], ("sha", pa.list_(pa.string())),
        ("groups", pa.list_(pa.string())), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(left, right)
        block, size, chunks = TaskContext.get().partitionId() << END_BITS, 0, []
        for batch in pieces(batches, limit=CHUNK_BYTES):
            per_doc, groups, pairs = aligned_chunk(batch.column("text"), a, b)
            chunks.append((batch.column("doc_id"), per_doc, (groups, groups if show else [None] * len(groups)), pairs))
            size += max(1, batch.column("text").nbytes)
            if size >= BLOCK_BYTES:
                yield block_rows(block, chunks, schema)
                block, size, chunks = block + 1, 0, []
                pa.default_memory_pool().release_unused()
        if chunks:
            yield block_rows(block, chunks, schema)

    return run


def _scored(chunks: pa.Table, totals: pa.Table) -> pa.Table:
    """Documents of one block with the totals of its pairs: codes are positions in the block's list of pairs."""
    order = np.argsort(totals["code"].to_numpy())
    total, best = totals["total"].to_numpy()[order], totals["best"].to_numpy()[order]
    out = []
    for row in range(chunks.num_rows):
        one = {c: chunks[c].combine_chunks()[row].values for c in ("ids", *PER_DOC, "sha", "groups")}
        links = one["n_links"].to_numpy(zero_copy_only=False)
        codes = released(chunks["links"][row].as_py(), int(links.sum()))
        ends = np.concatenate([[0], np.cumsum(links)])
        for name, amount in (("n_best", best[codes].astype(np.int64)), ("count_sum", total[codes])):
            upto = np.concatenate([[0], np.cumsum(amount)])
            one[name] = pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64())
        out.append(pa.table({
            "doc_id": one["ids"], **{c: one[c] for c in PER_DOC}, "n_best": one["n_best"], "count_sum": one["count_sum"],
            "groups_sha256": one["sha"], "groups": one["groups"],
        }))
    return pa.concat_tables(out)


def align(docs: DataFrame, *, text: str = "text", left: str = LEFT, right: str = RIGHT, show: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups (if ``show``)."""
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    chosen = docs.select("doc_id", F.col(text).alias("text"))
    run = aligner(to_arrow_type(kind), left, right, show)
    chunks = stored(chosen.mapInArrow(run, SCHEMA.format(kind=kind.simpleString())))
    listed = chunks.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "_p"))
    partial = listed.select("block", "code", F.col("_p.pairs").alias("pair"), F.col("_p.counts").alias("n"))
    totals = stored(partial.groupBy("pair").agg(F.sum("n").alias("total")))
    of_b = F.col("pair").bitwiseAND(F.lit((1 << RIGHT_BITS) - 1))
    highest = totals.groupBy(of_b.alias("b")).agg(F.max("total").alias("highest"))  # at most one row per id of B
    known = totals.withColumn("b", of_b).join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    back = partial.select(F.col("block").alias("of"), "code", "pair").join(known, "pair").select("of", "code", "total", "best")
    schema = f"doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
    scored = chunks.drop("pairs", "counts").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_scored, schema)
    return scored if show else scored.drop("groups")


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(read(spark, sf_dir, "documents"))
