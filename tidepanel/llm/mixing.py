"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are words of whole texts (null: none). A source's target is its share of all words by weight, at most ``MOST``
times its own size; what is above is shared again among the others by weight. A source gives complete epochs first; the
rest of its target goes to the documents with the smallest exponential keys -ln(u) / quality, u from a digest of doc_id,
up to the document whose middle passes the rest. Equal keys are ordered by id and size; repeated rows count as often as
they occur; null ids and sources are values like others; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.llm.common import free_name, read, stored, words
from tidepanel.operators.order import null_safe_join, positions, running_total

WEIGHTS = (1, 2, 3)
MOST = 3
SYMBOLS = "#*$%&|<>"
ORDER = ["key", "doc_id", "size", "_print"]


def quality_weight(text: Column, size: Column) -> Column:
    """Words per word and symbol: 1 for plain prose, towards 0 for junk."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(size > 0, size / (size + symbols)).otherwise(F.lit(1.0))


def exponential_key(doc_id: Column, quality: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / quality


def targets(sizes: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """source, source_size, target. One number per round goes to the driver; a round only caps further sources."""
    totals = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    ranked = positions(totals, None, [F.col(source).asc_nulls_last()], out="_n")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("_n") - 1) % len(WEIGHTS) + 1).cast("int"))
    table = stored(ranked.select(source, "source_size", weight.cast("long").alias("_w")))
    most = F.lit(MOST) * F.col("source_size")
    whole = table.agg(F.sum("source_size")).first()[0] or 0
    rest, open_weight, capped = whole, table.agg(F.sum("_w")).first()[0] or 0, -1
    while True:
        # share of one unit of weight: rest / open_weight; a source is capped when its share exceeds its most
        share = F.lit(float(rest)) * F.col("_w") / F.lit(float(max(open_weight, 1)))
        above = table.where(share > most).agg(F.count(F.lit(1)), F.sum(most), F.sum("_w")).first()
        if above[0] <= capped or above[0] == 0:
            break
        capped = above[0]
        rest = whole - above[1]
        open_weight = table.agg(F.sum("_w")).first()[0] - above[2]
    return table.select(source, "source_size", F.least(share, most.cast("double")).alias("target"))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with size and key, without their text."""
    plain = F.coalesce(F.col(text), F.lit(""))
    one = docs.select("doc_id", "source", F.size(words(F.col(text))).cast("long").alias("size"), plain.alias("_t"))
    return one.select(
        "doc_id",
        "source",
        "size",
        exponential_key(F.col("doc_id"), quality_weight(F.col("_t"), F.col("size"))).alias("key"),
        F.xxhash64("_t").alias("_print"),
    )


def _decided(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, source, size, key, _print, source_size, target, _whole (epochs of the source) and _more (one more time)."""
    rows = stored(sized(docs, text))
    goal = stored(targets(rows))
    upto = running_total(rows, "source", ORDER, "size").drop("overall")
    joined = null_safe_join(upto, goal, ["source"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - whole * F.col("source_size")
    once_more = (F.col("upto") - F.col("size") / 2 <= rest) & (rest > 0)
    return joined.withColumns({"_whole": whole, "_more": once_more})


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row: doc_id, source, size, source_size, target, times, taken, and _print (a hash of the text)."""
    decided = _decided(docs, text).withColumn("times", F.col("_whole") + F.col("_more").cast("long"))
    return decided.select(
        "doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"), "_print"
    )


def _cuts(docs: DataFrame, text: str) -> DataFrame:
    """Per source: epochs, the place in its order up to which rows are taken once more, and how many of the rows of that
    very place (repeated ones) are among them."""
    rows = stored(_decided(docs, text).select("source", F.struct(*ORDER).alias("_at"), "_whole", "_more"))
    last = rows.groupBy("source").agg(F.max(F.when(F.col("_more"), F.col("_at"))).alias("_cut"), F.first("_whole").alias("_whole"))
    there = null_safe_join(rows, last.select("source", "_cut"), ["source"]).where(F.col("_at") == F.col("_cut"))
    same = there.groupBy("source").agg(F.count_if("_more").alias("_taken"), F.count(F.lit(1)).alias("_same"))
    return stored(null_safe_join(last, same, ["source"], "left"))


def mixed_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's rows and columns, each row as often as the mix takes it.

    A source takes a beginning of its order once more, so where that ends is all that has to be known: rows are neither
    joined with each other nor moved. Only if a source ends amid repeated rows, these are numbered.
    """
    cuts = _cuts(docs, text)
    names = {c: free_name(docs, c) for c in ("_at", "_cut", "_whole", "_taken", "_same", "_number")}
    at, cut = F.col(names["_at"]), F.col(names["_cut"])
    plain = F.coalesce(F.col(text), F.lit(""))
    size = F.size(words(F.col(text))).cast("long")
    key = exponential_key(F.col("doc_id"), quality_weight(plain, size))
    placed = docs.withColumn(names["_at"], F.struct(key.alias("key"), F.col("doc_id"), size.alias("size"), F.xxhash64(plain).alias("_print")))
    limits = cuts.select("source", *[F.col(c).alias(names[c]) for c in ("_cut", "_whole", "_taken", "_same")])
    rows = null_safe_join(placed, limits, ["source"])
    amid = F.coalesce((at == cut) & (F.col(names["_taken"]) < F.col(names["_same"])), F.lit(False))

    def often(more: Column, whole: str) -> Column:
        return F.explode(F.array_repeat(F.lit(0), (F.col(whole) + F.coalesce(more, F.lit(False)).cast("long")).cast("int")))

    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = rows.where(~amid).withColumn(names["_number"], often(at <= cut, names["_whole"])).select(*columns)
    if cuts.where("_taken < _same").isEmpty():
        return out
    spread = rows.where(amid).select(
        F.struct(*columns).alias("row"), F.col("source").alias("home"), F.struct(F.xxhash64(*columns), F.rand(7)).alias("place"),
        F.col(names["_whole"]).alias("whole"), F.col(names["_taken"]).alias("taken"),
    )
    numbered = positions(spread, "home", ["place"], out="number")
    return out.unionByName(numbered.withColumn("time", often(F.col("number") <= F.col("taken"), "whole")).select("row.*"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "size", "source_size", "target", "times", "taken")
