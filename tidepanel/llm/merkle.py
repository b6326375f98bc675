"""Merkle manifest of a table of documents, proved by a recursive query.

A leaf is the digest of a document's fields. Leaves of one language, by id, are hashed in runs of two until one node, the
subroot, is left; subroots by language give the root in the same way. Built levels are stored as parent-linked node rows: a
row names its ancestor ``HOP`` levels up and holds the siblings on the way there, so a block of 2^HOP nodes is hashed in one
row and the climb takes few joins. ``climb`` is a recursive common table expression that ascends from every leaf: a step
finds the node's row, folds its siblings into the (tampered) hash, appends them to the relation and moves to the ancestor.
Above its own block, a leaf has the siblings of its neighbours, so the relation holds these once per block, with its first
leaf. Node rows high up, which many leaves ask for, are stored once per lane, and a leaf asks in the lane of its position.

Null fields are written ``-``. Null languages are a tree of their own before all others, null ids come first and aren't
tampered, rows that share an id go by their leaf, other columns are ignored, an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.llm.common import read, stored
from tidepanel.operators.order import positions

HOP = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = ""  # the tree of subroots; other trees have longer names
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def encoded(value: Column) -> Column:
    """A field as bytes: length, colon, value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Iterable[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, fields)), 256))


def leaves(docs: DataFrame, tampered: dict[str, Column]) -> DataFrame:
    """(tree, pos, doc_id, leaf, given): position within the language's tree, digest before and after tampering.

    Trees are named so that their names sort as languages do, null first.
    """
    changed = F.lit(False)
    for name, value in tampered.items():
        changed = changed | ~F.col(name).eqNullSafe(value)
    leaf = leaf_digest(F.col(c) for c in FIELDS)
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree"), "doc_id", leaf.alias("leaf"),
        F.when(changed, leaf_digest(tampered.get(c, F.col(c)) for c in FIELDS)).alias("given"),
    )
    placed = positions(stored(rows), "tree", ["doc_id", "leaf"], out="pos", total="n")
    return stored(placed.select("tree", (F.col("pos") - 1).alias("pos"), "n", "doc_id", "leaf", F.coalesce("given", "leaf").alias("given")))


def _hashed(nodes: DataFrame, level: int) -> DataFrame:
    """Blocks of 2^HOP nodes (tree, pos, n, hash, below, and more): their common ancestor, and the siblings of each node.

    ``below``: leaves under a node. ``steps``: levels to climb, fewer than HOP only where the tree ends.
    """
    more = [c for c in nodes.columns if c not in ("tree", "n", "pos", "hash", "below")]
    kid = F.struct("pos", "hash", "below", *more)
    blocks = nodes.groupBy("tree", "n", F.expr(f"shiftright(pos, {HOP})").alias("up")).agg(
        F.sort_array(F.collect_list(kid)).alias("kids"), F.sum("below").alias("up_below")
    )
    pair = "sha2(concat(lower(hex(last[2 * i])), coalesce(lower(hex(get(last, 2 * i + 1))), '')), 256)"
    paired = f"transform(sequence(0, (size(last) + 1) div 2 - 1), i -> unhex({pair}))".replace("last", "element_at(done, -1)")
    levels = f"CASE WHEN steps > 0 THEN aggregate(sequence(1, steps), array(kids.hash), (done, k) -> concat(done, array({paired}))) ELSE array(kids.hash) END"
    path = "CASE WHEN steps > 0 THEN transform(sequence(0, steps - 1), k -> get(levels[k], shiftright(i, k) ^ 1)) ELSE array() END"
    kept = ", ".join(f"'{c}', kid.{c}" for c in ("pos", "hash", "below", *more))
    named = f"transform(kids, (kid, i) -> named_struct({kept}, 'path', {path}))"
    steps = F.when(F.col("n") > 1, F.least(F.lit(HOP), F.length(F.bin(F.col("n") - 1)))).otherwise(0).cast("int")
    made = blocks.withColumn("steps", steps).withColumn("levels", F.expr(levels))
    return stored(made.select(
        "tree", F.lit(level).alias("level"), "n", "up", "up_below", F.expr("element_at(levels, -1)[0]").alias("hash"), F.expr(named).alias("kids")
    ))


def _trees(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """All blocks of some trees, level by level, and (tree, hash, below) of their roots."""
    built, ends = [], None
    level, ended = 0, F.col("n") <= (1 << HOP)
    while not nodes.isEmpty():
        built.append(_hashed(nodes, level))
        roots = built[-1].where(ended).select("tree", "hash", F.col("up_below").alias("below"))
        ends = roots if ends is None else ends.unionByName(roots)
        nodes = built[-1].where(~ended).select(
            "tree", F.col("up").alias("pos"), F.expr(f"(n + {(1 << HOP) - 1}) div {1 << HOP}").alias("n"), "hash",
            F.col("up_below").alias("below"),
        )
        level += HOP
    return built, ends


def _links(blocks: DataFrame, lanes: int, key: tuple[Column, Column, Column], *more: Column) -> DataFrame:
    """Node rows under a key (tree, level, pos), with the key of the ancestor and the lanes that this has.

    The root of a language's tree is the node (tree, -1, 0) of the tree of subroots.
    """
    ended, top = F.col("n") <= (1 << HOP), F.col("tree") == TOP
    rows = blocks.select("tree", "level", "n", "up", "up_below", F.col("hash").alias("_top"), F.inline("kids"))
    return rows.select(
        *[c.alias(name) for c, name in zip(key, ("tree", "level", "pos"))], F.col("pos").alias("at"), "path",
        F.when(~(ended & top), F.col("tree")).alias("up_tree"), F.when(ended, -1).otherwise(F.col("level") + HOP).alias("up_level"),
        F.when(ended, 0).otherwise(F.col("up")).cast("long").alias("up_pos"), _lanes("up_below", lanes).alias("up_lanes"),
        F.when(ended, F.col("_top")).alias("reached"), *more,
    )


def _lanes(below: str, lanes: int) -> Column:
    return F.least(F.lit(lanes), F.greatest(F.lit(1), F.shiftright(below, HOP))).cast("int")


def build(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Over ``leaves``: blocks of leaves, node rows of the leaves, node rows of everything above; None without any leaf."""
    lanes = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = rows.select("tree", "pos", "n", F.col("leaf").alias("hash"), F.lit(1).cast("long").alias("below"), "given", "doc_id")
    built, ends = _trees(first)
    if not built:
        return None
    subroots = positions(ends, None, ["tree"], out="pos", total="n")
    over, _ = _trees(subroots.select(F.lit(TOP).alias("tree"), (F.col("pos") - 1).alias("pos"), "n", "hash", "below", F.col("tree").alias("name")))
    plain = F.col("tree"), F.col("level"), F.col("pos")
    own_lane = F.explode(F.sequence(F.lit(0), _lanes("below", lanes) - 1)).alias("lane")
    nodes = _links(over[0], lanes, (F.col("name"), F.lit(-1), F.lit(0).cast("long")), own_lane)
    for blocks in built[1:] + over[1:]:
        nodes = nodes.unionByName(_links(blocks, lanes, plain, own_lane))
    return built[0], _links(built[0], lanes, plain, F.col("given")), stored(nodes)


FOLD = """aggregate(n.path, named_struct('hash', {hash}, 'at', n.at), (s, sibling) -> named_struct(
            'hash', unhex(sha2(CASE WHEN sibling IS NULL THEN lower(hex(s.hash))
                                    WHEN s.at % 2 = 1 THEN concat(lower(hex(sibling)), lower(hex(s.hash)))
                                    ELSE concat(lower(hex(s.hash)), lower(hex(sibling))) END, 256)),
            'at', shiftright(s.at, 1))).hash"""
CLIMB = """
WITH RECURSIVE climb(home, spot, step, tree, level, pos, lane, folded, siblings, reached) AS (
  SELECT n.tree, n.pos, 0, n.up_tree, n.up_level, n.up_pos, CAST(n.pos % n.up_lanes AS INT), {first}, CAST(array() AS ARRAY<BINARY>), n.reached
  FROM {leaves} n
  UNION ALL
  SELECT c.home, c.spot, c.step + 1, n.up_tree, n.up_level, n.up_pos, CAST(c.spot % n.up_lanes AS INT), {further},
         CASE WHEN c.spot % {block} = 0 THEN n.path ELSE CAST(array() AS ARRAY<BINARY>) END, CASE WHEN c.spot % {block} = 0 THEN n.reached END
  FROM climb c JOIN {nodes} n ON n.tree = c.tree AND n.level = c.level AND n.pos = c.pos AND n.lane = c.lane
)
SELECT home, spot, step, tree, folded, siblings, reached FROM climb
"""


def _joined_up(path: Column) -> Column:
    """Siblings end to end; a node without one adds nothing."""
    return F.aggregate(path, F.lit(b""), lambda upto, sibling: F.concat(upto, F.coalesce(sibling, F.lit(b""))))


def climb(blocks: DataFrame, leaf_nodes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per leaf: doc_id, leaf, subroot, root, siblings (all on the way up, digests end to end) and folded (from ``given``)."""
    spark = blocks.sparkSession
    query = CLIMB.format(
        first=FOLD.format(hash="n.given"), further=FOLD.format(hash="c.folded"), block=1 << HOP, leaves="{leaves}", nodes="{nodes}"
    )
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")  # the default guards against endless queries; this one ends at the root
    try:
        steps = spark.sql(query, leaves=leaf_nodes, nodes=nodes)
        block = F.expr(f"shiftright(spot, {HOP})").alias("up")
        met = F.when(F.col("reached").isNotNull(), F.col("step"))
        found = stored(steps.where("tree IS NULL OR size(siblings) > 0 OR reached IS NOT NULL").groupBy(F.col("home").alias("tree"), block).agg(
            F.sort_array(F.collect_list(F.when(F.col("tree").isNull(), F.struct("spot", "folded")))).alias("ends"),
            F.sort_array(F.collect_list(F.when(F.size("siblings") > 0, F.struct("step", "siblings")))).alias("over"),
            F.min_by("reached", met).alias("subroot"), F.max_by("reached", met).alias("root"),
        ))
    finally:
        spark.conf.unset(ROW_LIMIT) if before is None else spark.conf.set(ROW_LIMIT, before)
    over = F.aggregate("over", F.lit(b""), lambda upto, x: F.concat(upto, _joined_up(x["siblings"])))
    each = F.transform(F.arrays_zip("kids", "ends"), lambda x: F.struct(
        x["kids"]["doc_id"].alias("doc_id"), x["kids"]["hash"].alias("leaf"), _joined_up(x["kids"]["path"]).alias("own"), x["ends"]["folded"].alias("folded"),
    ))
    joined = blocks.join(found, ["tree", "up"]).select("subroot", "root", over.alias("over"), F.inline(each))
    return joined.select("doc_id", "leaf", "subroot", "root", F.concat("own", "over").alias("siblings"), "folded")


def manifest(docs: DataFrame, tampered: dict[str, Column]) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. ``tampered`` gives the new
    value of columns that were changed after the manifest was built."""
    rows = leaves(docs, tampered)
    built = build(rows)
    if built is None:
        return rows.select("doc_id", *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], F.lit(False).alias("verified"))
    proved = climb(*built)
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "siblings", "folded")}
    return proved.select(
        "doc_id", *[text[c].alias(c) for c in ("leaf", "subroot", "root")], F.sha2(text["siblings"], 256).alias("proof_sha256"),
        text["folded"].alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering adds 1 to n_chars where 7 divides the checksum of the id."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    chars = F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return manifest(read(spark, sf_dir, "documents"), {"n_chars": chars})
