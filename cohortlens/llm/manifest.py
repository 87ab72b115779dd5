"""Merkle manifest of a dataset: checkpointed levels, proofs by recomputation.

Every row is a leaf, the digest of its fields. Per group the leaves are ordered and up to ``ARITY`` consecutive nodes become one
node, until one is left: the group's subroot; the subroots, ordered by group, become the root in the same way.

Only every ``STRIDE``-th level is stored, as one row per aligned subtree: the (at most ``ARITY ** STRIDE``) nodes of that level
that lie below one node of the next stored level. The levels between are never written. ``proofs`` goes from
the root down: for each subtree it regenerates the missing interior nodes from the stored ones, hands every
stored node the siblings on its way up, and forgets the interior nodes. So a task holds one subtree, a level
costs one join of subtree rows, and a group of any size (all rows in one language) is spread over its subtrees.

The place of a leaf in its group comes from one range partitioning of digests (no text is shuffled), row numbers within partitions
and the counts of the partitions before. Rows are ordered by order column, digest and a number, so that equal rows are split too.

Defined cases: a null field is ``-`` and differs from an empty one; nulls come first in every order; rows that repeat
an order value are ordered by digest, rows equal in both are interchangeable; an empty table gives no rows and no root; other
columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.session import materialise

ARITY, STRIDE = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: characters of a digest
HEX = 64
PATH = "array<struct<slot: int, others: string>>"
#: nodes under a node, and levels from one stored level to the next
Shape = tuple[int, int]


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


@dataclass
class Manifest:
    """The stored levels of the trees of all groups, and of the tree over their subroots.

    ``levels[k]`` has the rows ``(grp, height, subtree, nodes)``: of a group whose tree has ``height`` levels above its leaves, the
    nodes of level ``k * STRIDE`` below node ``subtree`` of level ``(k + 1) * STRIDE``. A node is a struct of ``place``, ``digest``
    and, for leaves, ``row``: what was carried along. ``top`` are the levels of the tree over the subroots.
    """

    levels: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: DataFrame
    shape: Shape


def _folded(frame: DataFrame, k: int, shape: Shape) -> DataFrame:
    """For stored level ``k``, add ``runs0 ..``: the joined digests of each run of the subtree's levels, and ``up``: the node above them all.

    The tree of a group may end within the stride; levels above its subroot have no runs.
    """
    arity, stride = shape
    out = frame.withColumn("_at", F.expr("transform(nodes, n -> n.digest)"))
    for j in range(stride):
        more = f"height > {stride * k + j}"
        runs = f"transform(sequence(0, (size(_at) - 1) div {arity}), r -> array_join(slice(_at, r * {arity} + 1, {arity}), ''))"
        out = out.withColumn(f"runs{j}", F.expr(f"IF({more}, {runs}, cast(array() AS array<string>))"))
        out = out.withColumn("_at", F.expr(f"IF({more}, transform(runs{j}, s -> sha2(cast(s AS binary), 256)), _at)"))
    return out.withColumn("up", F.element_at("_at", 1)).drop("_at")


def _placed(leaves: DataFrame, order: Sequence[str], arity: int) -> DataFrame:
    """Leaves with ``place`` (0-based, by ``order`` within ``grp``) and the ``height`` of their group's tree."""
    number = F.monotonically_increasing_id()
    in_order = leaves.repartitionByRange("grp", *order, "salt").sortWithinPartitions("grp", *order, "salt")
    rows = materialise(in_order.select("grp", "digest", "row", F.shiftright(number, 33).alias("part"), number.alias("number")), "manifest-order")
    counts = rows.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first"))
    before = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    size = F.sum("n").over(W.partitionBy("grp"))
    offsets = counts.select(
        F.col("part").alias("o_part"),
        F.col("grp").alias("o_grp"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        sum(((size > F.lit(arity**k)).cast("int") for k in range(62) if arity**k < 1 << 62), F.lit(0)).alias("height"),
    )
    same = (F.col("part") == F.col("o_part")) & F.col("grp").eqNullSafe(F.col("o_grp"))
    return rows.join(offsets, same).select("grp", "height", (F.col("number") + F.col("shift")).alias("place"), "digest", "row")


def _tree(leaves: DataFrame, order: Sequence[str], name: str, shape: Shape) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels, and the subroot of each group: (grp, digest)."""
    arity, stride = shape
    nodes, levels, subroots = _placed(leaves, order, arity), [], None
    while nodes is not None:
        k = len(levels)
        subtrees = nodes.groupBy("grp", "height", F.expr(f"place div {arity**stride}").alias("subtree"))
        levels.append(materialise(subtrees.agg(F.sort_array(F.collect_list(F.struct("place", "digest", "row"))).alias("nodes")), f"manifest-{name}-{k}"))
        above = _folded(levels[k], k, shape)
        goes_on = F.col("height") > stride * (k + 1)
        ended = above.where(~goes_on).select("grp", F.col("up").alias("digest"))
        subroots = ended if subroots is None else subroots.unionByName(ended)
        nodes = above.where(goes_on).select("grp", "height", F.col("subtree").alias("place"), F.col("up").alias("digest"), F.lit(None).cast("int").alias("row"))
        if levels[k].where(goes_on).isEmpty():
            nodes = None
    return levels, materialise(subroots, f"manifest-{name}-roots")


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    order_col: str = "doc_id",
    group_col: str = "lang",
    carry: dict[str, Column] | None = None,
    shape: Shape = (ARITY, STRIDE),
) -> Manifest:
    """The manifest of ``docs``. ``carry`` names further values of a row that its leaf keeps beside the order column (such as another
    digest to verify); the texts are read once, here, and not stored."""
    leaves = docs.select(
        F.col(group_col).alias("grp"),
        F.col(order_col).alias("place_key"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        F.struct(F.col(order_col).alias("key"), *[v.alias(k) for k, v in (carry or {}).items()]).alias("row"),
        F.monotonically_increasing_id().alias("salt"),
    )
    levels, subroots = _tree(materialise(leaves, "manifest-leaves"), ["place_key", "digest"], "leaves", shape)
    tops = subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("place_key"), "digest", F.struct(F.col("grp").alias("key")).alias("row"), F.lit(0).alias("salt"))
    top, root = _tree(tops, ["place_key"], "top", shape)
    return Manifest(levels, subroots, top, root.select(F.col("digest").alias("root")), shape)


def _step(runs: str, place: str, arity: int) -> str:
    """SQL: one step of a proof, for the node at ``place`` of a subtree's level with these runs."""
    slot, run = f"cast({place} % {arity} AS int)", f"element_at({runs}, cast({place} div {arity} AS int) + 1)"
    others = f"concat(substr({run}, 1, {HEX} * {slot}), substr({run}, {HEX} * {slot} + {HEX + 1}))"
    return f"IF(size({runs}) > 0, array(named_struct('slot', {slot}, 'others', {others})), cast(array() AS {PATH}))"


def _proved(levels: list[DataFrame], start: DataFrame, shape: Shape) -> DataFrame:
    """Leaves with their proofs: (grp, place, digest, row, subroot, path). ``start`` (s_grp, subroot, path) has the way on from each
    group's subroot.

    A path is an array of structs: ``slot``, the place in the run, and ``others``, the joined digests of the run's other nodes.
    """
    arity, stride = shape
    above = None
    for k in range(len(levels) - 1, -1, -1):
        frame = _folded(levels[k], k, shape)
        goes_on = F.col("height") > stride * (k + 1)
        rows = frame.where(~goes_on).join(start, F.col("grp").eqNullSafe(F.col("s_grp"))).drop("s_grp")
        if above is not None:
            ups = above.select(F.col("grp").alias("a_grp"), F.col("place").alias("a_place"), "subroot", "path")
            same = F.col("grp").eqNullSafe(F.col("a_grp")) & (F.col("subtree") == F.col("a_place"))
            rows = rows.unionByName(frame.where(goes_on).join(ups, same).drop("a_grp", "a_place"))
        steps = [_step(f"runs{j}", f"(pos div {arity**j})", arity) for j in range(stride)]
        above = rows.select("*", F.posexplode("nodes").alias("pos", "node")).select(
            "grp", "node.place", "node.digest", "node.row", "subroot", F.expr(f"concat({', '.join(steps)}, path)").alias("path")
        )
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: grp, place, digest, row, subroot, path (the siblings, level by level up to the root) and root."""
    spark = manifest.root.sparkSession
    whole = spark.createDataFrame([(0, None, [])], f"s_grp int, subroot string, path {PATH}")
    tops = _proved(manifest.top, whole, manifest.shape).select(F.col("row.key").alias("s_grp"), F.col("digest").alias("subroot"), "path")
    return _proved(manifest.levels, materialise(tops, "manifest-tops"), manifest.shape).withColumn("root", manifest.root.scalar())


def folded(leaf: Column | str, path: str = "path") -> Column:
    """The root that a leaf's digest and its siblings lead to."""

    def up(node: Column, step: Column) -> Column:
        cut = step["slot"] * HEX
        run = F.concat(F.substring(step["others"], F.lit(1), cut), node, F.substring(step["others"], cut + 1, F.length(step["others"])))
        return F.sha2(run.cast("binary"), 256)

    return F.aggregate(F.col(path), F.col(leaf) if isinstance(leaf, str) else leaf, up)


def siblings_digest(path: str = "path") -> Column:
    """SHA-256 of all siblings on the way up, joined."""
    return F.sha2(F.array_join(F.transform(F.col(path), lambda s: s["others"]), "").cast("binary"), 256)


def audit(docs: DataFrame) -> DataFrame:
    """Every row's proof, tried on a copy in which every third row (by the CRC-32 of its identifier) has lost its capitals:
    doc_id, leaf, subroot, root, proof_sha256, folded_root and verified."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(hit, leaf_digest([lower if c == "text" else F.col(c) for c in FIELDS]))
    rows = proofs(build(docs, carry={"changed": changed}))
    return rows.select(
        F.col("row.key").cast("long").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        siblings_digest().alias("proof_sha256"),
        folded(F.coalesce("row.changed", "digest")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
