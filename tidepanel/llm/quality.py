"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Null and empty texts have no words and fail the base rule; every row of the input comes back once, whatever its other
columns hold. A rule whose ratio has no denominator passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.llm.common import WORD_SPLIT, read

SYMBOLS = "#*$%&|<>"
WINDOW = 5
POSITION_BITS = 28
WORD = r"[^\x20\x09-\x0D]"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent function words of the four languages of the corpus.
STOP_WORDS = tuple(dict.fromkeys((
    "the be to of and a in that have it for on with as is was are by this at or an "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "le la les de des un une et à en que qui dans pour par sur au avec ne du est ou pas aux "
    "el los las del y que se por con para su al lo como más o es una no"
).split()))


@dataclass(frozen=True)
class Rule:
    """Keep texts whose ``percent`` * share / 100 lies within the bounds: amount of one measure per unit of another."""

    amount: str
    per: str
    at_least: int | None = None  # percent
    at_most: int | None = None  # percent
    beyond: int = 0  # units that are free: short texts say little about a share


#: Integer percentages, so that every engine decides alike.
RULES = (
    Rule("word_chars", "n_words", at_least=200, at_most=1500),  # mean word length
    Rule("n_symbols", "n_words", at_most=10),
    Rule("n_exclaims", "n_words", at_most=50),
    Rule("n_stop_words", "n_words", at_least=2, beyond=50),
    Rule("n_dup_lines", "n_lines", at_most=50),
    Rule("n_bullet_lines", "n_lines", at_most=90),
    Rule("n_ellipsis_lines", "n_lines", at_most=30),
)


def _count_where(items: Column, test) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def _neighbour(items: Column, same, x: Column, k: Column) -> Column:
    """Whether ``x`` at ``k`` of a sorted array is ``same`` as the one before or after."""
    return ((k > 0) & same(x, F.get(items, k - 1))) | ((k < F.size(items) - 1) & same(x, F.get(items, k + 1)))


def _with_repeats(cut: DataFrame) -> DataFrame:
    """Add n_repeat_words: words that lie in a window found twice in the text.

    Window hashes are made from word hashes by zipping shifted arrays. Only where some hash occurs twice, a long per
    window takes 36 bits of its hash above its position: sorted, windows that may be equal are neighbours, and those are
    compared as text. The count is exact and costs n log n in a text's length.
    """
    w = F.col("_w")
    mask = F.lit((1 << POSITION_BITS) - 1).cast("long")
    none = F.array().cast("array<bigint>")
    together = lambda a, b: F.xxhash64(a, b)
    shifted = lambda name, by: F.slice(name, F.lit(by + 1), F.size(name))

    def opened(x: Column) -> Column:
        at = x.bitwiseAND(mask).cast("int")
        return F.struct(F.concat_ws(" ", F.slice(w, at + 1, WINDOW)).alias("g"), at.alias("i"))

    def step(df: DataFrame, name: str, value: Column, drop: str) -> DataFrame:
        return df.withColumn(name, value).drop(drop)

    ones = cut.withColumn("_1", F.transform(w, lambda x: F.xxhash64(x)))
    twos = ones.withColumn("_2", F.zip_with("_1", shifted("_1", 1), together))
    fours = step(twos, "_4", F.zip_with("_2", shifted("_2", 2), together), "_2")
    fives = step(fours, "_5", F.zip_with("_4", shifted("_1", 4), together), "_4").drop("_1")
    whole = step(fives, "_h", F.slice("_5", F.lit(1), F.greatest(F.size("_5") - (WINDOW - 1), F.lit(0))), "_5")
    pack = lambda x, i: F.shiftleft(x, POSITION_BITS).bitwiseOR(i.cast("long"))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    packed = step(whole, "_e", F.when(twice, F.sort_array(F.transform("_h", pack))).otherwise(none), "_h")
    high = lambda a, b: F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS)
    maybe = step(packed, "_m", F.filter("_e", lambda x, k: _neighbour(F.col("_e"), high, x, k)), "_e")
    texts = step(maybe, "_g", F.sort_array(F.transform("_m", opened)), "_m")
    equal = lambda a, b: a["g"] == b["g"]
    same = F.filter("_g", lambda x, k: _neighbour(F.col("_g"), equal, x, k))
    starts = step(texts, "_p", F.sort_array(F.transform(same, lambda x: x["i"])), "_g")
    last = F.size("_p") - 1
    gap = lambda x, k: F.when(k < last, F.least(F.get(F.col("_p"), k + 1) - x, F.lit(WINDOW))).otherwise(WINDOW)
    total = F.aggregate(F.transform("_p", gap), F.lit(0), lambda acc, x: acc + x)
    return step(starts, "n_repeat_words", total.cast("long"), "_p")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row: the input columns in ``_row``, and every measure that rules can name."""
    clean = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_t")
    )
    cut = clean.select(
        "_row",
        "_t",
        F.filter(F.split("_t", WORD_SPLIT), lambda x: x != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)).alias("_l"),
    )
    removed = lambda chars: (F.length("_t") - F.length(F.translate("_t", chars, ""))).cast("long")
    return _with_repeats(cut).select(
        "_row",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_w")).cast("long").alias("word_chars"),
        removed(SYMBOLS).alias("n_symbols"),
        removed("!").alias("n_exclaims"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        _count_where(F.col("_w"), lambda x: x.isin(*STOP_WORDS)).alias("n_stop_words"),
        _count_where(F.col("_l"), lambda x: F.ltrim(x).rlike("^[-*•] ")).alias("n_bullet_lines"),
        _count_where(F.col("_l"), lambda x: F.endswith(F.rtrim(x), F.lit("..."))).alias("n_ellipsis_lines"),
    )


def compiled(rules: Sequence[Rule]) -> Column:
    """The table as one boolean expression."""
    checks = []
    for r in rules:
        amount, per = 100 * F.col(r.amount), F.col(r.per) - r.beyond
        checks += [amount >= r.at_least * per] if r.at_least is not None else []
        checks += [amount <= r.at_most * per] if r.at_most is not None else []
    return reduce(Column.__and__, checks, F.lit(True))


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``measures`` with base_failed and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measures(docs, text).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compiled(rules))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows that pass, with the columns they came with.

    The verdict must be evaluated once: a filter pushed below the projections would copy them into itself many times over,
    so it also asks for a column that may not be moved.
    """
    marked = judged(docs, rules, text).select("_row", "kept", F.monotonically_increasing_id().alias("_at"))
    return marked.where("kept AND _at >= 0").select("_row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("_row.doc_id", *[c for c in out.columns if c != "_row"])
