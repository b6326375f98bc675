"""Logistic loss over all pairs of a day, and its gradient, in a time that grows with the rows and not with the pairs.

A pair is two rows of a day whose relevance differs; the better one is at position i of the falling order, the other at j. Its
loss is softplus(s_j - s_i), its weight what exchanging both has for NDCG: (2^rel_i - 2^rel_j) * (D_i - D_j), with D = 1 /
log2(1 + position). Relevance comes in a few grades, so the first factor is a number per pair of grades and the second one a
difference of terms of either row: what is left are sums of a smooth function of s_j - s_i over the rows of a grade. Scores are
cut into boxes of a fixed width, in which that function is its Chebyshev interpolant to about 1e-12 (its poles are at +-i pi), so
the rows of a grade in a box act on all others as ``DEGREE`` moments. No pair is left out or drawn, and none is made.

Moments add up: a day may be read in any number of parts. Those of a day that is read in one piece are used at once, others
are shuffled and added first. Per pass and day as many numbers move as a day has grades and boxes, whatever its rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from tidepanel.session import ship

WIDTH, DEGREE = 2.0, 16  # of a box of scores
PART = 1 << 16  # rows of a day that a task holds
KERNEL = 1 << 22  # entries of a kernel that a task holds
SETTLED = 1e-8  # what a further step may still take off the loss, as a share of it

_ANGLES = (2 * np.arange(DEGREE) + 1) * np.pi / (2 * DEGREE)
_NODES = np.cos(_ANGLES)
_TO_NODES = np.cos(np.outer(_ANGLES, np.arange(DEGREE))) * np.where(np.arange(DEGREE) == 0, 1, 2) / DEGREE


class Rows:
    """Rows of one day: grades, discounts of their positions, vectors."""

    def __init__(self, grade: np.ndarray, discount: np.ndarray, x: np.ndarray):
        self.grade, self.discount, self.x = grade, discount, x


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change, 0 among them."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


# ---- spread: weight of all pairs and second moments of their differences, without scores -----------------------------


class Spread:
    """Sums of 1, D, x, D x, x x' and D x x' per grade."""

    @staticmethod
    def part(rows: Rows) -> dict:
        out = {}
        for grade in np.unique(rows.grade):
            at = rows.grade == grade
            x, d = rows.x[at], rows.discount[at]
            dx = x * d[:, None]
            out[float(grade)] = [np.array([len(d), d.sum()]), x.sum(0), dx.sum(0), x.T @ x, dx.T @ x]
        return out

    @staticmethod
    def joined(parts: Iterable[dict]) -> dict:
        out: dict = {}
        for part in parts:
            for grade, sums in part.items():
                out[grade] = [a + b for a, b in zip(out[grade], sums)] if grade in out else sums
        return out

    @staticmethod
    def total(part: dict) -> np.ndarray:
        """Weight of the pairs, then those of their differences' products, then their rows' squares as a scale for rounding."""
        out = 0.0
        for a, (n, x, dx, xx, dxx) in part.items():
            for b, (n2, x2, dx2, xx2, dxx2) in part.items():
                if a <= b:
                    continue
                cross = np.outer(dx, x2) - np.outer(x, dx2)
                own = dxx * n2[0] - xx * n2[1] + xx2 * n[1] - dxx2 * n[0]
                moments = own - cross - cross.T
                weight = n[1] * n2[0] - n[0] * n2[1]
                out = out + (2.0**a - 2.0**b) * np.concatenate([[weight], moments.ravel(), np.diag(own)])
        return out

    whole = None


# ---- slope: loss and gradient at given weights of the features --------------------------------------------------------


class Slope:
    """Moments per (grade, box) of 1 and D, and of x and D x where the rows of a day come in parts."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def _placed(self, rows: Rows) -> tuple[np.ndarray, ...]:
        score = rows.x @ self.weights
        box = np.floor(score / WIDTH)
        order = np.lexsort((box, rows.grade))
        grade, box, score = rows.grade[order], box[order], score[order]
        u = np.clip(score / (WIDTH / 2) - 2 * box - 1, -1.0, 1.0)
        basis = np.empty((len(u), DEGREE))
        basis[:, 0], basis[:, 1] = 1.0, u
        for m in range(2, DEGREE):
            basis[:, m] = 2 * u * basis[:, m - 1] - basis[:, m - 2]
        return order, grade, box, basis, _starts(grade, box)

    def part(self, rows: Rows) -> dict:
        order, grade, box, basis, starts = self._placed(rows)
        x, d = rows.x[order], rows.discount[order]
        each = np.concatenate([np.ones((len(d), 1)), d[:, None], x, x * d[:, None]], axis=1)
        ends = np.append(starts[1:], len(d))
        return {(float(grade[a]), float(box[a])): basis[a:b].T @ each[a:b] for a, b in zip(starts, ends)}

    @staticmethod
    def joined(parts: Iterable[dict]) -> dict:
        out: dict = {}
        for part in parts:
            for key, moments in part.items():
                out[key] = out[key] + moments if key in out else moments
        return out

    def total(self, part: dict) -> np.ndarray:
        keys = np.array(list(part))
        moments = np.stack(list(part.values()))
        n = (moments.shape[2] - 2) // 2
        loss, by_one, by_d = _acting(keys[:, 0], keys[:, 1], moments[:, :, :2])
        x, dx = moments[:, :, 2 : 2 + n], moments[:, :, 2 + n :]
        return np.append(loss, np.einsum("gm,gmf->f", by_one, dx) - np.einsum("gm,gmf->f", by_d, x))

    def whole(self, rows: Rows) -> np.ndarray:
        """``total(part(rows))``, with fewer sums."""
        order, grade, box, basis, starts = self._placed(rows)
        d = rows.discount[order]
        moments = np.stack([np.add.reduceat(basis, starts), np.add.reduceat(basis * d[:, None], starts)], axis=2)
        loss, by_one, by_d = _acting(grade[starts], box[starts], moments)
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(d))))
        slope = d * np.einsum("nm,nm->n", basis, by_one[of]) - np.einsum("nm,nm->n", basis, by_d[of])
        return np.append(loss, slope @ rows.x[order])


def _acting(grade: np.ndarray, box: np.ndarray, moments: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss of all pairs, and for each (grade, box) the Chebyshev coefficients of P and Q: the slope of the loss along the score s
    of a row with discount D is D P(s) - Q(s)."""
    count = len(grade)
    charges = np.einsum("km,gmc->gkc", _TO_NODES, moments).reshape(count * DEGREE, 2)
    gain = 2.0**grade
    acting = np.empty((count, DEGREE, 2))
    loss = 0.0
    step = max(1, KERNEL // (count * DEGREE * DEGREE))
    for a in range(0, count, step):
        b = min(a + step, count)
        apart, which = np.unique(box[None, :] - box[a:b, None], return_inverse=True)
        ahead = apart[:, None, None] * WIDTH + (_NODES[None, None, :] - _NODES[None, :, None]) * (WIDTH / 2)  # source - target
        fall = np.exp(-np.abs(ahead))
        lift = np.where(ahead > 0, 1.0, fall) / (1 + fall)
        soft = np.maximum(ahead, 0.0) + np.log1p(fall)
        which = which.reshape(b - a, count)
        gains = (gain[a:b, None] - gain[None, :])[:, :, None, None]
        flat = ((b - a) * DEGREE, count * DEGREE)
        kernel = np.where(gains > 0, lift[which], 1 - lift[which]) * -np.abs(gains)
        acting[a:b] = (kernel.transpose(0, 2, 1, 3).reshape(flat) @ charges).reshape(b - a, DEGREE, 2)
        lost = (soft[which] * np.maximum(gains, 0.0)).transpose(0, 2, 1, 3).reshape(flat) @ charges
        own = charges[a * DEGREE : b * DEGREE]
        loss += float(own[:, 1] @ lost[:, 0] - own[:, 0] @ lost[:, 1])
    coefficients = np.einsum("km,gkc->gmc", _TO_NODES, acting)
    return loss, coefficients[:, :, 0], coefficients[:, :, 1]


# ---- passes over the rows --------------------------------------------------------------------------------------------


def _days(batches: Iterable[pa.RecordBatch], values: list[list[float]]) -> Iterator[tuple[object, bool, Rows]]:
    """(day, whether these are all rows of the day, rows), for runs of rows of a day; long runs in parts."""
    table = np.zeros((len(values), max(map(len, values), default=0)))
    for k, v in enumerate(values):
        table[k, : len(v)] = v
    day, held, count, size = None, [], 0, 0

    def flushed() -> Iterator[tuple[object, bool, Rows]]:
        if count:
            yield day, count == size, Rows(*[np.concatenate(c) for c in zip(*held)])

    for batch in batches:
        if not batch.num_rows:
            continue
        plain = [_matrix(batch.column(k), batch.num_rows) for k in ("_x", "_leaf")]
        x = np.concatenate([plain[0].astype(float), table[np.arange(len(values)), plain[1].astype(int)]], axis=1)
        grade, place, total = (batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in ("_grade", "_at", "_n"))
        discount = 1 / np.log2(place + 1)
        runs = pc.run_end_encode(batch.column("_day"))
        first = 0
        for name, last in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if name != day:
                yield from flushed()
                day, held, count = name, [], 0
            for low in range(first, last, PART):
                high = min(low + PART, last)
                if count and count + high - low > PART:
                    yield from flushed()
                    held, count = [], 0
                held.append((grade[low:high], discount[low:high], x[low:high]))
                count, size = count + high - low, total[low]
            first = last
    yield from flushed()


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _passed(batches: Iterable[pa.RecordBatch], *, kind: Spread | Slope, values: list[list[float]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The sum over whole days in one row, and one row for each part of any other day."""
    total: np.ndarray | float = 0.0
    for day, whole, rows in _days(batches, values):
        if whole:
            total = total + (kind.whole(rows) if kind.whole else kind.total(kind.part(rows)))
        else:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((day, False, pickle.dumps(kind.part(rows))), schema.types)], schema=schema)
    if not np.isscalar(total):
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((None, True, pickle.dumps(total)), schema.types)], schema=schema)


def _summed(found: pd.DataFrame, *, kind: Spread | Slope) -> pd.DataFrame:
    parts = map(pickle.loads, found["sums"])
    total = sum(parts) if found["whole"].iloc[0] else kind.total(kind.joined(parts))
    return pd.DataFrame({"sums": [] if np.isscalar(total) else [pickle.dumps(total)]})


class AllPairs:
    """The loss over all pairs of a day whose relevance differs, as a function of the weights of the features.

    ``rows`` is read once per evaluation and has ``_day`` and, in it, ``_grade``, ``_at`` (position), ``_n`` (rows of the day with a
    grade), ``_x`` and ``_leaf`` (of which ``values`` are the numbers); rows of a day should lie together.
    """

    def __init__(self, rows: DataFrame, values: list[list[float]]):
        ship(rows.sparkSession)
        self._rows, self._values = rows.select("_day", "_grade", "_at", "_n", "_x", "_leaf"), values
        found = self._pass(Spread())
        if found is None or not found[0] > 0:
            raise ValueError("no day has two rows whose relevance differs")
        size = int((np.sqrt(4 * len(found) - 3) - 1) / 2)
        self.weight = float(found[0])
        moments = found[1 : 1 + size * size].reshape(size, size) / self.weight
        square, scale = np.diag(moments), found[1 + size * size :] / self.weight
        self._deviation = np.sqrt(np.where(square > 1e-13 * scale, square, 0.0))  # of the differences, taken in either order
        self._used = self._deviation > 0
        self._bend = (moments / 4)[np.ix_(self._used, self._used)] / np.outer(self._deviation[self._used], self._deviation[self._used])

    def _pass(self, kind: Spread | Slope) -> np.ndarray | None:
        day = self._rows.schema["_day"].dataType
        part = f"_day {day.simpleString()}, whole boolean, sums binary"
        schema = pa.schema([("_day", to_arrow_type(day)), ("whole", pa.bool_()), ("sums", pa.binary())])
        found = self._rows.mapInArrow(partial(_passed, kind=kind, values=self._values, schema=schema), part)
        sums = found.groupBy("_day", "whole").applyInPandas(_summing(kind), "sums binary").collect()
        return sum(pickle.loads(r["sums"]) for r in sums) if sums else None

    def at(self, weights: np.ndarray) -> tuple[float, np.ndarray]:
        """Weighted mean loss and its gradient."""
        found = self._pass(Slope(np.asarray(weights, dtype=float))) / self.weight
        return float(found[0]), found[1:]

    def minimum(self, penalty: float, start: np.ndarray | None = None, *, max_iter: int = 50) -> np.ndarray:
        """Weights with the least loss plus ``penalty`` / 2 times their squares, each in units of its feature's deviation.

        Steps are those of BFGS, which begin from the curvature at even scores.
        """
        used, unit = self._used, self._deviation[self._used]

        def value(at: np.ndarray) -> tuple[float, np.ndarray]:
            full = np.zeros(len(used))
            full[used] = at / unit
            loss, slope = self.at(full)
            return loss + penalty / 2 * float(at @ at), slope[used] / unit + penalty * at

        at = np.zeros(len(unit)) if start is None else np.asarray(start)[used] * unit
        inverse = np.linalg.inv(self._bend + (penalty + 1e-9) * np.eye(len(unit)))
        loss, slope = value(at)
        for _ in range(max_iter):
            step = -inverse @ slope
            fall = float(slope @ step)
            if -fall <= SETTLED * loss:
                break
            size = 1.0
            while True:
                there, then = value(at + size * step)
                if there <= loss + 1e-4 * size * fall or size < 1e-6:
                    break
                size /= 2
            moved, turned = size * step, then - slope
            along = float(moved @ turned)
            if along > 0:
                shift = np.eye(len(at)) - np.outer(moved, turned) / along
                inverse = shift @ inverse @ shift.T + np.outer(moved, moved) / along
            at, loss, slope = at + moved, there, then
        out = np.zeros(len(used))
        out[used] = at / unit
        return out


def _summing(kind: Spread | Slope) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda found: _summed(found, kind=kind)
