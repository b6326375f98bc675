"""Best-fit packing of tokenised documents by linear grouping.

Only a histogram of piece lengths (at most ``SIZE`` numbers) decides the packing: large lengths are cut into groups of
equal cardinality and rounded up to the largest of their group, a small linear programme over configurations of the few
rounded sizes gives how often each configuration is used, actual pieces take the places of their group, and what is left
goes by best fit into the room that remains. The plan is a bounded table of runs (pieces of one length, by rank, into
consecutive sequences), so it does not grow with the data; every piece finds its place by length and rank.

Null texts are empty: one piece holding only the end id. Repeated rows are packed each on its own. An empty table
gives none.
"""

from __future__ import annotations

import base64
import bisect
import itertools
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidepanel.llm.common import flat, pieces, read, stored

SIZE = 2048
LARGE = 384
GROUPS = 32
END_ID = 0
ODD_SPACE = "\x1c\x1d\x1e\x1f"  # white space to Python, not to the pattern; harmless either way
TOKENIZER = "byte_bpe_50k"


class Encoder:
    """Byte-level BPE ids of many texts at once: texts are cut by array operations, each distinct cut is encoded once."""

    def __init__(self, name: str = TOKENIZER) -> None:
        import regex
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.kind = np.zeros(0x110000, np.uint8)
        every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
        for mark, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                self.kind[ord(m[0][0]) : ord(m[0][-1]) + 1] = mark
        self.line = self.ranks[b"\n"]
        with open(public_tokenizers.path(f"{name}.json")) as file:
            self.special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}

    def cuts(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces start that the vocabulary's pattern cuts a text into (``offsets``: first point of each text)."""
        n = len(points)
        if not n:
            return np.zeros(0, np.int64)
        kind = self.kind[points]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        change = first[:-1].copy()
        change[1:] |= kind[1:] != kind[:-1]
        space = points == 32
        after_space = np.zeros(n, bool)
        after_space[1:] = space[:-1]
        start = change & ~((kind != 3) & after_space & ~first[:-1])
        ends = np.flatnonzero(np.append(change[1:], True))  # last point of each run
        blank = ends[(kind[ends] == 3) & ~first[ends + 1]]  # of white space with something behind it
        start[blank] = True
        quote = np.flatnonzero(start & (points == 39))
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        inside = np.concatenate([first, np.ones(2, bool)])
        one = quote[np.isin(padded[quote + 1], [ord(c) for c in "stmd"]) & ~inside[quote + 1]]
        pair = padded[quote + 1].astype(np.int64) << 21 | padded[quote + 2]
        two = quote[np.isin(pair, [ord(a) << 21 | ord(b) for a, b in ("re", "ve", "ll")]) & ~inside[quote + 1] & ~inside[quote + 2]]
        for at, width in ((one, 2), (two, 3)):
            start[at + 1] = False
            behind = at + width
            start[behind[behind < n]] = True
        return np.flatnonzero(start)

    def each(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of single pieces: all ids end to end, where each piece's start, and how many there are.

        Pieces that aren't white space are encoded as lines of one text: the pattern cuts before and behind each line
        break, and no such piece has the break's id in it.
        """
        blank = np.fromiter(map(str.isspace, cuts), bool, len(cuts)) | np.fromiter((c[0] in ODD_SPACE for c in cuts), bool, len(cuts))
        sizes = np.zeros(len(cuts), np.int64)
        ids = np.array(self.bpe.encode_ordinary("\n".join(itertools.compress(cuts, ~blank)) + "\n"), np.uint32)
        ends = np.flatnonzero(ids == self.line) if not blank.all() else np.zeros(0, np.int64)
        own = ids[ids != self.line] if len(ends) else ids[:0]
        sizes[~blank] = np.diff(ends, prepend=-1) - 1
        spaces = [self.bpe.encode_ordinary(c) for c in itertools.compress(cuts, blank)]
        sizes[blank] = [len(x) for x in spaces]
        at = np.zeros(len(cuts), np.int64)
        at[~blank] = np.cumsum(sizes[~blank]) - sizes[~blank]
        at[blank] = len(own) + np.cumsum(sizes[blank]) - sizes[blank]
        return np.concatenate([own, np.fromiter(itertools.chain.from_iterable(spaces), np.uint32)]), at, sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (without end ids), and where each text's ids start."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        at = np.searchsorted(lead, offsets)
        starts = self.cuts(points, at)
        begin = np.append(lead[starts], len(data)) if len(starts) else np.zeros(1, np.int64)
        cuts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        distinct = cuts.dictionary_encode()  # told apart by their bytes
        back = distinct.indices.to_numpy()
        bag, bag_at, sizes = self.each(distinct.dictionary.to_pylist())
        counts = sizes[back]
        upto = np.concatenate([[0], np.cumsum(counts)])
        take = np.repeat(bag_at[back] - upto[:-1], counts) + np.arange(upto[-1])
        return bag[take], upto[np.searchsorted(starts, at)]


    def encode_marked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` where the vocabulary's special strings in a text stand for their own ids, as its file has it."""
        marked = pc.fill_null(pc.match_substring_regex(texts, "|".join(map(re.escape, self.special))), False) if self.special else None
        if marked is None or not pc.any(marked).as_py():
            return self.encode(*flat(texts))
        split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        parts = [split.split(t or "") for t in texts.to_pylist()]
        plain, first = self.encode(*flat(pa.array([p for x in parts for p in x[::2]], pa.large_string())))
        out, at = [], 0
        for x in parts:
            row = []
            for k, part in enumerate(x):
                if k % 2:
                    row.append(np.array([self.special[part]], np.uint32))
                else:
                    row.append(plain[first[at] : first[at + 1]])
                    at += 1
            out.append(np.concatenate(row))
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])


_ENCODERS: dict[str, Encoder] = {}


def tokenised(batches: Iterable[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """One row per piece; rows of one length are numbered within the task."""
    encoder = _ENCODERS.get(name) or _ENCODERS.setdefault(name, Encoder(name))
    part = TaskContext.get().partitionId()
    seen = np.zeros(SIZE + 1, np.int64)
    for batch in pieces(batches, limit=4 << 20):
        ids, first = encoder.encode_marked(batch.column("text"))
        rows, piece, start, length, crc = [], [], [], [], []
        for r in range(batch.num_rows):
            own = np.append(ids[first[r] : first[r + 1]], END_ID).astype("<u4")
            number = -(-len(own) // SIZE)
            head = len(own) - (number - 1) * SIZE
            for k in range(number):
                a, b = (0, head) if k == 0 else (head + (k - 1) * SIZE, head + k * SIZE)
                rows.append(r), piece.append(k), start.append(a), length.append(b - a), crc.append(zlib.crc32(own[a:b].tobytes()))
        size = np.array(length, np.int64)
        order = np.argsort(size, kind="stable")
        run = np.flatnonzero(np.diff(size[order], prepend=-1))
        within = np.arange(len(size)) - np.repeat(run, np.diff(np.append(run, len(size))))
        rank = np.empty(len(size), np.int64)
        rank[order] = within
        rank += seen[size]
        seen += np.bincount(size, minlength=SIZE + 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(size), pa.array(crc, pa.int64()), pa.array(np.full(len(size), part, np.int32)), pa.array(rank)],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "_part", "_rank"],
        )


def configurations(sizes: list[int], size: int = SIZE) -> np.ndarray:
    """Every way to place rounded sizes in one sequence that has no room for a further one, as counts per size."""
    out: list[list[int]] = []

    def grow(at: int, room: int, counts: list[int]) -> None:
        if at == len(sizes):
            if any(counts) and room < min(sizes):
                out.append(counts)
            return
        for k in range(room // sizes[at] + 1):
            grow(at + 1, room - k * sizes[at], counts + [k])

    grow(0, size, [])
    return np.array(out, np.int64).reshape(-1, len(sizes))


def use_of_configurations(patterns: np.ndarray, demand: np.ndarray) -> np.ndarray:
    """How often each configuration is used: the linear programme min sum(x), patterns' x >= demand, rounded down.

    Revised simplex on a basis of one column per size, priced over all configurations.
    """
    k = len(demand)
    basis = [int(np.argmax(np.where(patterns[:, i] > 0, patterns[:, i], -1))) for i in range(k)]
    matrix = np.diag([float(patterns[basis[i], i]) for i in range(k)])  # columns may leave places empty
    columns: list[int] = list(basis)
    own = [matrix[:, i].copy() for i in range(k)]
    for _ in range(4000):
        b = np.column_stack(own)
        price = np.linalg.solve(b.T, np.ones(k))
        gain = patterns @ price
        enter = int(np.argmax(gain))
        if gain[enter] <= 1 + 1e-9:
            break
        x, d = np.linalg.solve(b, demand.astype(float)), np.linalg.solve(b, patterns[enter].astype(float))
        ratio = np.where(d > 1e-9, np.maximum(x, 0) / np.where(d > 1e-9, d, 1), np.inf)
        leave = int(np.argmin(ratio))
        own[leave], columns[leave] = patterns[enter].astype(float), enter
    x = np.linalg.solve(np.column_stack(own), demand.astype(float))
    used = np.zeros(len(patterns), np.int64)
    left = demand.copy()
    for amount, column in sorted(zip(x, columns), reverse=True):
        pattern = patterns[column]
        fits = min((left[i] // pattern[i] for i in np.flatnonzero(pattern)), default=0)
        times = int(min(max(np.floor(amount + 1e-6), 0), fits))
        used[column] += times
        left -= times * pattern
    return used


def plan(counts: np.ndarray, size: int = SIZE, large: int = LARGE, groups: int = GROUPS) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, ranks, first sequence, sequences, offset) that place every counted piece.

    A run deals its ranks over its sequences round by round: rank i goes to sequence i mod sequences, and each further
    round stands one length behind the one before.
    """
    left = counts.astype(np.int64).copy()
    taken = np.zeros(size + 1, np.int64)
    out: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, sequences)
    bins = 0

    def put(length: int, first: int, sequences: int, offset: int, rounds: int = 1) -> None:
        out.append((length, int(taken[length]), sequences * rounds, first, sequences, offset))
        taken[length] += sequences * rounds
        left[length] -= sequences * rounds

    # Linear grouping: (length, how many) of each group, largest first.
    total = int(left[large + 1 : size].sum())
    per = max(1, -(-total // groups))
    members: list[list[list[int]]] = []
    space = 0
    for length in range(size - 1, large, -1):
        n = int(left[length])
        while n:
            if not space:
                members.append([])
                space = per
            k = min(n, space)
            members[-1].append([length, k])
            n, space = n - k, space - k
    if members:
        rounded = [g[0][0] for g in members]
        sizes = sorted(set(rounded), reverse=True)
        by_size = {s: [x for g, r in zip(members, rounded) if r == s for x in g] for s in sizes}
        demand = np.array([sum(n for _, n in by_size[s]) for s in sizes], np.int64)
        patterns = configurations(sizes, size)
        for pattern, times in zip(patterns, use_of_configurations(patterns, demand)):
            slots = [s for s, k in zip(sizes, pattern) for _ in range(k)]
            done = 0
            while done < times:  # a run of sequences whose places hold pieces of the same actual lengths
                chosen, cut = [], times - done
                used: dict[int, int] = defaultdict(int)
                for s in slots:
                    at = used[s]
                    used[s] += 1
                    chosen.append((s, at))
                heads = {s: by_size[s] for s in used}
                # all places of one size take the same length: its head must last for all of them
                for s, k in used.items():
                    while heads[s] and heads[s][0][1] == 0:
                        heads[s].pop(0)
                    cut = min(cut, max(1, heads[s][0][1] // k))
                offset = 0
                if all(heads[s][0][1] >= k * cut for s, k in used.items()):
                    for s, k in used.items():
                        length = heads[s][0][0]
                        put(length, bins, cut, offset, k)
                        heads[s][0][1] -= k * cut
                        offset += k * length
                else:  # a single sequence that mixes two lengths of a group
                    cut = 1
                    for s, k in used.items():
                        for _ in range(k):
                            while heads[s][0][1] == 0:
                                heads[s].pop(0)
                            length = heads[s][0][0]
                            put(length, bins, 1, offset)
                            heads[s][0][1] -= 1
                            offset += length
                room[size - offset].append((bins, cut))
                bins += cut
                done += cut

    # Best fit, longest first, for what is left.
    open_rooms = sorted(r for r, runs in room.items() if runs)
    for length in range(size, 0, -1):
        while left[length]:
            at = bisect.bisect_left(open_rooms, length)
            if at == len(open_rooms):
                each = size // length
                sequences = max(1, int(left[length]) // each)
                rounds = min(each, int(left[length]))
                put(length, bins, sequences, 0, rounds)
                first, rest = bins, size - rounds * length
                bins += sequences
            else:
                r = open_rooms[at]
                first, sequences = room[r].pop()
                if not room[r]:
                    open_rooms.pop(at)
                use = min(sequences, int(left[length]))
                if use < sequences:
                    room[r].append((first + use, sequences - use))
                    if r not in open_rooms[at : at + 1]:
                        open_rooms.insert(at, r)
                rounds = min(r // length, int(left[length]) // use)
                put(length, first, use, size - r, rounds)
                sequences, rest = use, r - rounds * length
            if rest:
                if not room[rest]:
                    bisect.insort(open_rooms, rest)
                room[rest].append((first, sequences))
    return out


def sequences(runs: list[tuple[int, int, int, int, int, int]]) -> int:
    """How many sequences the runs of a plan use."""
    return max((first + wide for _, _, _, first, wide, _ in runs), default=0)


def best_plan(counts: np.ndarray, size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Linear grouping, or best fit over all lengths where rounding up costs more sequences than it saves."""
    return min((plan(counts, size), plan(counts, size, large=size)), key=sequences)


def pack(docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, _part int, _rank long"
    rows = stored(
        docs.select("doc_id", F.col(text).alias("text")).mapInArrow(lambda batches: tokenised(batches, tokenizer), schema)
    )
    counts = rows.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))))
    histogram = np.zeros(SIZE + 1, np.int64)
    for r in before.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most SIZE rows
        histogram[r["length"]] = r["n"]
    runs = best_plan(histogram)
    frame = spark.createDataFrame([tuple(map(int, r)) for r in runs] or [(0,) * 6], "length long, _first long, _ranks long, _sequence long, _wide long, _offset long")
    numbered = rows.join(before.drop("_n"), ["_part", "length"]).withColumn("_at", F.col("_before") + F.col("_rank"))
    # The plan is bounded by the lengths there are, whatever the number of pieces: a broadcast that cannot grow.
    placed = numbered.join(F.broadcast(frame), "length").where("_at >= _first AND _at < _first + _ranks")
    i = F.col("_at") - F.col("_first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_sequence") + i % F.col("_wide")).alias("sequence_id"),
        (F.col("_offset") + F.floor(i / F.col("_wide")) * F.col("length")).cast("long").alias("offset"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
