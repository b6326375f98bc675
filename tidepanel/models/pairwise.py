"""Learning to rank from pairs: a model of which of two rows of a day is the more relevant.

The score is linear in the features and in the leaf means of a small forest, which let it bend. It is fitted to all pairs of a day
whose relevance differs, each with the weight that exchanging the two rows has for NDCG; ``allpairs`` sums their loss and its
slope without making them, and no day is held by one task. The strength of the penalty is lowered step by step, each fit from
where the one before ended; NDCG at 3 and 5 on the validation days decides when to stop and which step is kept.

``ranked_pairs`` lists pairs at fixed offsets in the order of a day; the fit doesn't use it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.models.allpairs import AllPairs
from tidepanel.models.boosted import _table, _with_leaves, leaf_values
from tidepanel.operators.cross import ndcg
from tidepanel.operators.order import positions
from tidepanel.session import copartitioned, materialise

SHARES = (0.1, 0.2, 0.4, 0.6, 0.8)
PENALTIES = (1.0, 0.3, 0.1, 0.03, 0.01, 0.003, 0.001, 0.0)


def ranked_pairs(
    rows: DataFrame, relevance: str, *, by: str = "d", tie: str = "entity", shares: Sequence[float] = SHARES, keep: Sequence[str] = ()
) -> DataFrame:
    """(by, high, low, weight) and ``{c}_high``, ``{c}_low`` for the columns of ``keep``: rows of a day whose relevance
    differs. ``high`` and ``low`` are positions in the order of falling relevance, then ``tie``; partners stand
    ceil(share * rows of the day) apart."""
    placed = positions(rows.select(by, tie, relevance, *keep), by, [F.col(relevance).desc(), F.col(tie)], out="high", total="_n")
    placed = placed if keep else materialise(placed)  # kept columns have been written once, with their ranges
    steps = F.array_distinct(F.array(*[F.ceil(F.col("_n") * F.lit(s)) for s in shares]))
    low = F.explode(F.filter(F.transform(steps, lambda s: F.col("high") + s), lambda p: p <= F.col("_n"))).alias("low")
    met = [by]
    if keep:
        placed, met = _met(placed, by, steps), [by, "_part"]
    own = placed.where("_part = _own") if keep else placed
    left = own.select(*met, "high", F.col(relevance).alias("_better"), *[F.col(c).alias(f"{c}_high") for c in keep], low)
    right = placed.select(*met, F.col("high").alias("low"), F.col(relevance).alias("_worse"), *[F.col(c).alias(f"{c}_low") for c in keep])
    pairs = left.join(right, [*met, "low"]).where(F.col("_better") > F.col("_worse"))
    gain = F.pow(F.lit(2.0), F.col("_better")) - F.pow(F.lit(2.0), F.col("_worse"))
    weight = gain * (1 / F.log2(F.col("high") + 1.0) - 1 / F.log2(F.col("low") + 1.0))
    return pairs.select(by, "high", "low", weight.alias("weight"), *[f"{c}_{side}" for c in keep for side in ("high", "low")])


PART = 64  # neighbours in the order of a day that meet their partners in one part


def _met(placed: DataFrame, by: str, steps: Column) -> DataFrame:
    """Rows dealt into small parts of a day, ``_own`` and those (``_part``) in which a better partner waits for them.

    Steps are nearly multiples of the first one, so partners stand at nearly the same place modulo that step: neighbours there
    make a part with all their partners, and few rows are in more than one. Pairs of rows are made where the rows are, so that
    a row moves about once, not with each of its pairs.
    """
    copartitioned(placed.sparkSession)
    first = F.get(steps, F.lit(0))

    def part(place: Column) -> Column:
        return F.floor(F.pmod(place - 1, first) / PART)

    better = F.transform(F.filter(steps, lambda s: F.col("high") > s), lambda s: part(F.col("high") - s))
    parts = F.array_distinct(F.concat(F.array(part(F.col("high"))), better))
    return placed.withColumns({"_own": part(F.col("high")), "_part": F.explode(parts)}).repartition(by, "_part")


@dataclass
class PairRanker:
    forest: RandomForestRegressionModel
    values: list[list[float]]
    weights: list[float]
    penalty: float
    ndcg: float
    path: list[tuple[float, float]]  # (penalty, mean NDCG of the validation days) of every step tried

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the score; it orders the rows of a day and means nothing between days."""
        return bent(df, self.forest, self.values).withColumn(out, _score("_bent", self.weights)).drop("_bent")


def bent(df: DataFrame, forest: RandomForestRegressionModel, values: list[list[float]], features: str = "features") -> DataFrame:
    """Add ``_bent``: the features and the leaf means of every tree."""
    leaves = _with_leaves(forest, df, "_leaf")
    return leaves.withColumn("_bent", F.concat(vector_to_array(features), _means("_leaf", values))).drop("_leaf")


def _means(leaves: str, values: list[list[float]]) -> Column:
    return F.zip_with(leaves, _table(values), lambda leaf, value: F.get(value, leaf))


def _score(bent_column: str, weights: Sequence[float]) -> Column:
    products = F.zip_with(bent_column, F.array(*map(F.lit, weights)), lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)


def fit_pairs(
    rows: DataFrame, relevance: str, *, by: str = "d", tie: str = "entity", is_val: str = "is_val", trees: int = 10, depth: int = 4,
    min_rows: int = 50, penalties: Sequence[float] = PENALTIES, patience: int = 2, ks: Sequence[int] = (3, 5), seed: int = 42,
) -> PairRanker:
    """``rows``: a table with a vector ``features``. Days in ``is_val`` give the stop and nothing else."""
    train = rows.where(~F.col(is_val))
    forest = RandomForestRegressor(
        labelCol=relevance, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_rows, subsamplingRate=0.8, bootstrap=False,
        featureSubsetStrategy="0.8", seed=seed,
    ).fit(train)
    centred = train.withColumn("_r", F.col(relevance).cast("double"))
    values = leaf_values(_with_leaves(forest, centred, "_leaf"), "_leaf", "_r", float("inf"), "mean")
    graded = train.where(F.col(by).isNotNull() & F.col(relevance).isNotNull())
    plain = _with_leaves(forest, graded, "_leaf").select(
        by, tie, F.col(relevance).cast("double").alias("_grade"), vector_to_array("features").alias("_x"), F.col("_leaf").cast("array<smallint>").alias("_leaf")
    )
    placed = positions(plain, by, [F.col("_grade").desc(), F.col(tie)], out="_at", total="_n")
    pairs = AllPairs(placed.withColumnRenamed(by, "_day"), values)
    held = materialise(bent(rows.where(is_val), forest, values).select(by, tie, relevance, "_bent"))
    best: PairRanker | None = None
    path: list[tuple[float, float]] = []
    fitted = None
    for penalty in penalties:
        fitted = pairs.minimum(penalty, fitted)
        weights = fitted.tolist()
        quality = ndcg(held.select(by, tie, relevance, _score("_bent", weights).alias("_s")), "_s", relevance, ks=ks, by=by, tie=tie)
        reached = quality.agg(F.avg(sum(F.col(f"ndcg_{k}") for k in ks) / len(ks))).first()[0] or 0.0
        path.append((penalty, reached))
        if best is None or reached > best.ndcg:
            best = PairRanker(forest, values, weights, penalty, reached, path)
        elif len(path) - 1 - [p for p, _ in path].index(best.penalty) >= patience:
            break
    return best
