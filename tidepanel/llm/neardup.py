"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

1. Document frequencies of five-word shingles are counted over all documents into ``BUCKETS`` hash buckets, a vector of
   fixed size whatever the corpus; a shingle's weight is its count times ln((1+n)/(1+df)) + 1 of its bucket.
2. Consistent weighted sampling draws ``BANDS`` * ``ROWS`` samples per document; a band of equal samples is a bucket key.
3. In each bucket the most central text is compared with all others (no pairs among the rest); pairs that pass the
   weighted Jaccard threshold are links. Texts of a bucket that are then still in different components are compared with
   each other where an exact filter lets them: texts that similar share one of their rarest shingles. Where the bucket has at
   most ``FEW`` it is part of the join's condition, else the join is by these shingles; of both kinds pairs whose sampled estimate is far below the threshold are passed over
   (a loss of 1 in 5,000 at the threshold, less than that of the bands). No bucket is capped.
4. Components of the links are the classes; exact copies of a text belong to its class without being compared.

The verdict is the weighted similarity's. A candidate pair whose unweighted similarity reaches the threshold is linked as
well, but candidates are drawn by weight: pairs that only the unweighted one would link are found less surely, the less the
lower their weighted similarity (0.58 of pairs at 0.81 that share frequent sentences). Words are runs without ASCII white space, A-Z lowered; a text of fewer than five words is one shingle; texts without words,
null ones included, are each a class of its own. Null ids come back with their class; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.llm.common import byte_classes, components, flat, mixed, pieces, read, shingles, stored, word_hashes
from tidepanel.operators.order import null_safe_join

BUCKETS = 1 << 18
BLOCK = 1 << 14
CHUNK = 1 << 17  # bytes of text sampled at a time: the arrays made of them stay in a core's cache
BANDS, ROWS = 20, 5
FEW = 4096
SKETCH = -(-BANDS * ROWS // 32)  # longs that hold two bits of each sample
DIFFER = 28  # of 100 samples: at a similarity of 0.8, 15 differ in those bits on average, and over 28 once in 5,000
THRESHOLD = 0.8
_TABLE = byte_classes(letters_only=False)


def _shingles(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(batch.column(column))
    return shingles(*word_hashes(data, offsets, _TABLE))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many documents each bucket occurs (in blocks), and the number of documents with words."""
    seen, n = np.zeros(BUCKETS, np.int64), 0
    for batch in pieces(batches, limit=CHUNK):
        h, first = _shingles(batch)
        row = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(first))
        pairs = np.sort(row * BUCKETS + (h & np.uint64(BUCKETS - 1)).astype(np.int64))
        pairs = pairs[np.diff(pairs, prepend=-1) != 0]
        seen += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
        n += int((np.diff(first) > 0).sum())
    if n:
        blocks = [seen[i : i + BLOCK] for i in range(0, BUCKETS, BLOCK)] + [np.array([n])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([b.astype("<i8").tobytes() for b in blocks])], names=["block", "counts"]
        )


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, "<i8") for x in pdf.counts)
    return pd.DataFrame({"block": [pdf.block.iloc[0]], "counts": [total.tobytes()]})


def idf(docs: DataFrame) -> np.ndarray:
    """Weight of each bucket. The driver sees ``BUCKETS`` numbers, whatever the corpus."""
    parts = docs.select("text").mapInArrow(_counted, "block int, counts binary")
    sums = {r["block"]: np.frombuffer(bytes(r["counts"]), "<i8") for r in
            parts.groupBy("block").applyInPandas(_summed, "block int, counts binary").collect()}
    if not sums:
        return np.ones(BUCKETS, np.float32)
    n = sums.pop(BUCKETS // BLOCK)[0]
    df = np.concatenate([sums[i] for i in sorted(sums)])
    return (np.log((1 + n) / (1 + np.minimum(df, n))) + 1).astype(np.float32)


def weighted(h: np.ndarray, first: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row, their TF-IDF weights, and each row's first."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.argsort(h)
    order = order[np.argsort(row[order].astype(np.uint16 if len(first) < 1 << 16 else np.int64), kind="stable")]
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(h)))
    kept = h[at]
    return kept, count * weights[(kept & np.uint64(BUCKETS - 1)).astype(np.int64)], np.searchsorted(row[at], np.arange(len(first)))


class Sampler:
    """Consistent weighted samples from fixed tables of Gamma(2,1) and uniform variates, picked by bits of the shingle."""

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        n = 1 << 16
        self.r = rng.gamma(2.0, 1.0, n).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, n)).astype(np.float32)
        self.beta = rng.random(n, np.float32)
        self.turns = rng.integers(1, 1 << 62, samples, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, h: np.ndarray, w: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Least ln(a) of every sample for each row that has shingles: it identifies shingle and quantised weight."""
        log_w = np.log(w).astype(np.float32)
        begin = first[:-1][np.diff(first) > 0]
        out = np.empty((len(begin), len(self.turns)), np.float32)
        x, bits = np.empty_like(h), np.empty_like(h)
        r, beta, log_c, y = (np.empty(len(h), np.float32) for _ in range(4))

        def picked(table: np.ndarray, shift: int, into: np.ndarray) -> None:
            np.right_shift(x, np.uint64(shift), out=bits)
            np.bitwise_and(bits, np.uint64(0xFFFF), out=bits)
            table.take(bits.view(np.int64), out=into, mode="clip")  # no index is outside; "raise" would copy

        for s, turn in enumerate(self.turns):
            np.multiply(h, turn, out=x)
            np.bitwise_xor(x, np.right_shift(x, np.uint64(29), out=bits), out=x)
            picked(self.r, 48, r), picked(self.beta, 32, beta), picked(self.log_c, 16, log_c)
            # t = floor(ln w / r + beta); ln y = r (t - beta); ln a = ln c - ln y - r
            np.divide(log_w, r, out=y)
            y += beta
            np.floor(y, out=y)
            y -= beta
            y *= r
            np.subtract(log_c, y, out=y)
            y -= r
            out[:, s] = np.minimum.reduceat(y, begin)
        return out


def _banded(batches: Iterable[pa.RecordBatch], weights: Broadcast) -> Iterator[pa.RecordBatch]:
    sampler = Sampler()
    for batch in pieces(batches, limit=CHUNK):
        h, w, first = weighted(*_shingles(batch), weights.value)
        has = np.flatnonzero(np.diff(first) > 0)
        if not len(has):
            continue
        bits = sampler(h, w, first).view(np.uint32).astype(np.uint64)
        rows = pa.array(has)
        keys = []
        for b in range(BANDS):
            key = np.full(len(has), b + 1, np.uint64)
            for s in range(b * ROWS, (b + 1) * ROWS):
                key = mixed(key * np.uint64(0x9DDFEA08EB382D69) + bits[:, s])
            keys.append(key)
        flatkeys = np.column_stack(keys).ravel().view(np.int64)
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flatkeys) + 1, BANDS), pa.int32()), pa.array(flatkeys))
        two = np.zeros((len(has), SKETCH * 32), np.uint64)
        two[:, : bits.shape[1]] = mixed(bits) & np.uint64(3)
        packed = (two.reshape(len(has), SKETCH, 32) << np.arange(0, 64, 2, dtype=np.uint64)).sum(2, dtype=np.uint64)
        sketches = pa.ListArray.from_arrays(pa.array(np.arange(0, packed.size + 1, SKETCH), pa.int32()), pa.array(packed.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("node").take(rows), bands, sketches], names=["node", "bands", "sketch"])


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: float) -> bool:
    """Whether the weighted or the plain Jaccard similarity of two sorted shingle sets reaches the threshold."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return False
    at = np.searchsorted(ha, hb)
    at[at == len(ha)] = 0
    same = ha[at] == hb
    low = np.minimum(wa[at[same]], wb[same]).sum()
    n = int(same.sum())
    return low >= threshold * (wa.sum() + wb.sum() - low) or n >= threshold * (len(ha) + len(hb) - n)


def _verified(batches: Iterable[pa.RecordBatch], weights: Broadcast, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in pieces(pieces(batches, "text_a"), "text_b"):
        sides = [weighted(*_shingles(batch, c), weights.value) for c in ("text_a", "text_b")]
        rows = []
        for i in range(batch.num_rows):
            own = [(h[f[i] : f[i + 1]], w[f[i] : f[i + 1]]) for h, w, f in sides]
            if similar(*own, threshold):
                rows.append(i)
        yield batch.select(["a", "b"]).take(pa.array(rows, pa.int64()))


def _rarest(h: np.ndarray, w: np.ndarray, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, list[int]]:
    """A text's shingles, rarest first, and how many of them lead to all similar texts: by weight, then by number, for the
    smaller text of a pair (which shares 2t/(1+t) of itself) and for the larger one (which shares t)."""
    order = np.lexsort((h, -weights[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]))
    mass, n, less = np.cumsum(w[order]), len(h), 1 - threshold
    share = [x * (1 + 1e-6) for x in (less / (1 + threshold), less)]  # what may differ; the least above it is a prefix
    by_weight = [int(np.searchsorted(mass, x * mass[-1], "right")) + 1 if n else 0 for x in share]
    return h[order], [min(k, n) for k in (*by_weight, *(int(x * n) + 1 for x in share))]


def _prefixes(batches: Iterable[pa.RecordBatch], weights: Broadcast, threshold: float) -> Iterator[pa.RecordBatch]:
    """The rarest shingles of each text: any text similar enough, by weight or by number, shares one of them."""
    for batch in pieces(batches):
        h, w, first = weighted(*_shingles(batch), weights.value)
        rows, keys = [], []
        for i in range(batch.num_rows):
            a, b = first[i], first[i + 1]
            own, sizes = _rarest(h[a:b], w[a:b], weights.value, threshold)
            rows.append(np.full(max(sizes), i)), keys.append(own[: max(sizes)])
        if rows:
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(at) for c in ("bucket", "node", "root", "sketch", "bands")] + [pa.array(np.concatenate(keys).view(np.int64))],
                names=["bucket", "node", "root", "sketch", "bands", "key"],
            )


_SHORT = "node binary, mass double, n int, w_less int, w_more int, n_less int, n_more int, rare array<int>"


def _short(batches: Iterable[pa.RecordBatch], weights: Broadcast, threshold: float) -> Iterator[pa.RecordBatch]:
    """Per text: weight and number of its shingles, and 32 bits of each of its rarest ones (equal shingles have equal bits)."""
    for batch in pieces(batches, limit=CHUNK):
        h, w, first = weighted(*_shingles(batch), weights.value)
        rows, rare = [], []
        for i in range(batch.num_rows):
            a, b = first[i], first[i + 1]
            own, sizes = _rarest(h[a:b], w[a:b], weights.value, threshold)
            rows.append((float(w[a:b].sum()), b - a, *sizes))
            rare.append((own[: max(sizes)] >> np.uint64(32)).astype(np.uint32).view(np.int32))
        mass, *numbers = zip(*rows)
        at = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
        columns = [pa.array(mass, pa.float64()), *[pa.array(x, pa.int32()) for x in numbers], pa.ListArray.from_arrays(at, pa.array(np.concatenate(rare)))]
        yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], names=["node", "mass", "n", "w_less", "w_more", "n_less", "n_more", "rare"])


def _may_reach(threshold: float) -> Column:
    """Whether two texts (the other's columns end in 2) can be similar enough: their sizes are near, and rarest shingles meet."""

    def by(size: str, less: str, more: str) -> Column:
        def smaller(a: str, b: str) -> Column:
            met = F.arrays_overlap(F.slice(f"rare{a}", F.lit(1), F.col(less + a)), F.slice(f"rare{b}", F.lit(1), F.col(more + b)))
            return (F.col(size + a) >= F.col(size + b) * (threshold * (1 - 1e-6))) & met

        return F.when(F.col(size) <= F.col(f"{size}2"), smaller("", "2")).otherwise(smaller("2", ""))

    return by("mass", "w_less", "w_more") | by("n", "n_less", "n_more")


def _links(pairs: DataFrame, texts: DataFrame, weights: Broadcast, threshold: float) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return stored(both.mapInArrow(partial(_verified, weights=weights, threshold=threshold), "a binary, b binary"))


def _apart(rows: DataFrame, keys: list[str], also: Column | None = None) -> DataFrame:
    """Pairs (a, b) with equal keys that are in different components and whose sketches differ in ``DIFFER`` places at most,
    and for which ``also`` holds; in it the other's columns end in 2."""
    other = rows.select(*keys, F.col("node").alias("b"), *[F.col(c).alias(f"{c}2") for c in rows.columns if c not in (*keys, "node")])

    def differ(k: int):
        x = F.get(F.col("sketch"), F.lit(k)).bitwiseXOR(F.get(F.col("sketch2"), F.lit(k)))
        return F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    total = sum((differ(k) for k in range(1, SKETCH)), differ(0))
    # A pair comes from the least of the buckets it shares: elsewhere it has been compared or is in one component.
    first = F.col("bucket") == F.array_min(F.array_intersect("bands", "bands2"))
    near = (F.col("root") != F.col("root2")) & (F.col("node") < F.col("b")) & (total <= DIFFER) & first
    both = rows.join(other, keys).where(near if also is None else near & also)
    return both.select(F.col("node").alias("a"), "b")


def _rooted(docs: DataFrame, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """One row per row, (doc_id, node, root) of texts with words and (doc_id, node) of those without: node is a digest of
    the text, root the least one of its class."""
    spark = docs.sparkSession
    plain = docs.select("doc_id", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("node"), F.col(text).alias("text"))
    weights = spark.sparkContext.broadcast(idf(plain))
    sampled = plain.select("node", "text").mapInArrow(partial(_banded, weights=weights), "node binary, bands array<bigint>, sketch array<bigint>")
    keys = stored(sampled.groupBy("node").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))  # copies of a text are one node
    buckets = keys.select("node", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(buckets.join(sizes, "bucket"))
    central = members.groupBy("node").agg(F.sum("n").alias("score"))
    open_ = stored(members.join(central, "node").select("bucket", "node", "score"))
    texts = stored(_first_texts(plain, open_.select("node").distinct()))
    centres = open_.groupBy("bucket").agg(F.max(F.struct("score", "node")).alias("c")).select("bucket", F.col("c.node").alias("centre"))
    spread = stored(open_.join(centres, "bucket").where("node <> centre"))
    pairs = stored(spread.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    links = _links(pairs, texts, weights, threshold)
    roots = components(links, "a", "b")

    # What the stars have left open: texts of a bucket, its centre aside, that are still apart.
    rest = spread.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    apart = rest.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
    rest = rest.join(apart.where("lo <> hi").select("bucket", "n"), "bucket").join(keys, "node")
    rest = stored(rest)
    few = rest.where(F.col("n") <= FEW).select("bucket", "node", "root", "sketch", "bands")
    some = _texts_of(texts, few).mapInArrow(partial(_short, weights=weights, threshold=threshold), _SHORT)
    near = _apart(few.join(some.hint("merge"), "node"), ["bucket"], _may_reach(threshold))
    rarest = rest.where(F.col("n") > FEW).join(texts, "node").select("bucket", "node", "root", "sketch", "bands", "text").mapInArrow(
        partial(_prefixes, weights=weights, threshold=threshold),
        "bucket bigint, node binary, root binary, sketch array<bigint>, bands array<bigint>, key bigint",
    )
    more = near.unionByName(_apart(stored(rarest), ["bucket", "key"])).distinct().join(pairs, ["a", "b"], "left_anti")
    late = _links(stored(more), texts, weights, threshold)
    roots = components(links.unionByName(late), "a", "b")

    rows = stored(plain.select("doc_id", "node", F.length(F.translate(F.coalesce("text", F.lit("")), " \t\n\x0b\x0c\r", "")).alias("_n")))
    worded = rows.where("_n > 0").join(roots, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    return worded, rows.where("_n = 0").select("doc_id", "node")


def classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: doc_id, node (digest of the text), class_id (least doc_id of its class), class_size."""
    worded, blank = _rooted(docs, text, threshold)
    sums = worded.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return (
        worded.join(sums, "root").select("doc_id", "node", "class_id", "class_size")
        .unionByName(blank.select("doc_id", "node", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size")))
    )


def _texts_of(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of some nodes, each once."""
    return texts.join(rows.select("node").distinct().hint("merge"), "node", "left_semi")


def _first_texts(plain: DataFrame, wanted: DataFrame) -> DataFrame:
    """One (node, text) for each wanted node, of which there are the more the larger the corpus: never a broadcast."""
    return plain.join(wanted.hint("merge"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))


def one_of_each(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that stay: one of each class, that of its least doc_id (null ids after all others, then by digest). Of rows
    repeated with one id and one text a single one stays; rows without words are no copies of each other and all stay."""
    worded, blank = _rooted(docs, text, threshold)
    worded = stored(worded)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("first")
    chosen = worded.groupBy("root").agg(first).select("first.doc_id", "first.node")
    times = worded.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n"))
    counted = stored(null_safe_join(chosen, times, ["doc_id", "node"]))

    def having(keys: DataFrame) -> DataFrame:
        node = F.unhex(F.md5(F.coalesce(docs[text], F.lit(""))))
        keep = keys.select(F.col("doc_id").alias("_keep_id"), F.col("node").alias("_keep_node"))
        return docs.join(keep, docs["doc_id"].eqNullSafe(keep["_keep_id"]) & (node == keep["_keep_node"]), "left_semi")

    out = having(counted.where("n = 1").select("doc_id", "node").unionByName(blank.distinct()))
    again = counted.where("n > 1")
    return out if again.isEmpty() else out.unionByName(having(again).dropDuplicates(["doc_id", text]))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classes(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
