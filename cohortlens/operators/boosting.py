"""Boosted trees by second-order gain, grown level by level with one aggregate per level.

Features are cut into bins at exact quantiles once. A level of a tree is one group-by of (node, feature, bin) with the sums of
gradient and Hessian of the log loss; each task sums its rows first, so at most ``2 ** depth * features * bins`` sums
reach the driver, whatever the number of rows. The driver chooses the splits: gain with leaf penalty, a least Hessian per child, nulls to the
side that gains more. Rows are drawn per tree by a hash of their key, columns per tree by a hash of their name, so reruns and
retries give the same trees. Margins are written once per tree, which cuts the lineage.

The model is a table of nodes (``NODES``). Scores and contributions walk it in column expressions: an array of trees in
one row, a step per level; the table is a subquery of one row, rows stay where they are.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.columns import digest, digest_uniform
from cohortlens.functions.ordered import running_sums
from cohortlens.params import RunParams
from cohortlens.session import materialise

NODES = (
    "tree int, node int, feature string, threshold double, nulls_left boolean, gain double, cover double, value double"
)
#: A gain below this is noise.
LEAST_GAIN = 1e-6


@dataclass
class Settings:
    trees: int = 200
    depth: int = 6
    rate: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    leaf_penalty: float = 1.0
    least_hessian: float = 1.0
    bins: int = 64
    base_margin: float = 0.0
    seed: int = RunParams.seed


@dataclass
class Node:
    """A node of a tree, numbered like a heap: the children of n are 2n and 2n + 1."""

    gradient: float
    hessian: float
    feature: int | None = None
    cut: int | None = None
    nulls_left: bool = False
    gain: float | None = None


@dataclass
class BoostedTrees:
    """``nodes`` (schema ``NODES``): a node without feature is a leaf; a value below the threshold goes left; ``value`` is the node's
    weight times the rate, also of inner nodes; ``cover`` is the sum of Hessians."""

    nodes: DataFrame
    features: list[str]
    settings: Settings = field(default_factory=Settings)

    def _trees(self) -> Column:
        """All trees as one value: per tree an array of nodes by heap number."""
        number = F.lit(0)
        for k, f in enumerate(self.features):
            number = F.when(F.col("feature") == f, k + 1).otherwise(number)
        entry = F.struct("node", F.struct(number.alias("feature"), "threshold", "nulls_left", "value", "path").alias("n"))
        trees = self._paths().groupBy("tree").agg(F.map_from_entries(F.collect_list(entry)).alias("by_number"))
        by_place = F.expr(f"transform(sequence(1, {2 ** (self.settings.depth + 1) - 1}), k -> by_number[k])")
        return trees.agg(F.transform(F.sort_array(F.collect_list(F.struct("tree", by_place.alias("nodes")))), lambda t: t["nodes"])).scalar()

    def _paths(self) -> DataFrame:
        """Nodes with ``path``: for each feature, the sum of changes of value on the way from the root."""
        at = self.nodes.where("node = 1").withColumn("path", F.array_repeat(F.lit(0.0), len(self.features)))
        every, number = at, {f: k for k, f in enumerate(self.features)}
        for _ in range(self.settings.depth):
            up = at.select(
                F.col("tree").alias("p_tree"), F.col("node").alias("p_node"), F.col("feature").alias("p_feature"), F.col("value").alias("p_value"), F.col("path").alias("p_path")
            ).where("p_feature is not null")
            down = self.nodes.join(up, (F.col("tree") == F.col("p_tree")) & (F.expr("node div 2") == F.col("p_node")) & (F.col("node") > 1))
            steps = [F.element_at("p_path", k + 1) + F.when(F.col("p_feature") == f, F.col("value") - F.col("p_value")).otherwise(0.0) for f, k in number.items()]
            at = down.select(*self.nodes.columns, F.array(*steps).alias("path"))
            every = every.unionByName(at)
        return every

    def _leaf(self, tree: str) -> str:
        """SQL: the leaf of a tree that the row's features ``_x`` lead to."""
        x, node = f"element_at(_x, element_at({tree}, n).feature)", f"element_at({tree}, n)"
        left = f"IF({x} IS NULL, {node}.nulls_left, {x} < {node}.threshold)"
        return f"aggregate(sequence(1, {self.settings.depth}), 1, (n, level) -> IF({node}.feature = 0, n, IF({left}, 2 * n, 2 * n + 1)))"

    def score(self, df: DataFrame, threshold: float = RunParams.risk_threshold) -> DataFrame:
        """Add ``margin``, ``risk_score`` and ``high_risk_flag``."""
        found = self._with_model(df).withColumn("margin", F.expr(f"{self.settings.base_margin!r}D + aggregate(_trees, 0D, (s, t) -> s + element_at(t, {self._leaf('t')}).value)"))
        score = 1.0 / (1.0 + F.exp(-F.col("margin")))
        return found.select(*df.columns, "margin", score.alias("risk_score"), (score >= threshold).cast("int").alias("high_risk_flag"))

    def contributions(self, df: DataFrame) -> DataFrame:
        """Add ``base`` and ``contributions``, the change of margin at the splits of each feature (a map); together they are the margin."""
        zero = f"array_repeat(0D, {len(self.features)})"
        total = F.expr(f"aggregate(_trees, {zero}, (s, t) -> zip_with(s, element_at(t, {self._leaf('t')}).path, (a, b) -> a + b))")
        base = F.expr(f"{self.settings.base_margin!r}D + aggregate(_trees, 0D, (s, t) -> s + element_at(t, 1).value)")
        names = F.array(*[F.lit(f) for f in self.features])
        return self._with_model(df).select(*df.columns, base.alias("base"), F.map_from_arrays(names, total).alias("contributions"))

    def mean_contributions(self, df: DataFrame) -> DataFrame:
        """feature, mean_abs_contribution: over all rows."""
        rows = self.contributions(df).select(F.explode("contributions").alias("feature", "contribution"))
        return rows.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))

    def _with_model(self, df: DataFrame) -> DataFrame:
        x = F.array(*[F.col(f).cast("double") for f in self.features])
        return df.withColumn("_x", x).withColumn("_trees", self._trees())

    def importance(self) -> DataFrame:
        """feature, importance (mean gain of its splits, as a share of all), splits, rank (1 is the largest)."""
        found = self.nodes.where("feature is not null").groupBy("feature").agg(F.avg("gain").alias("mean_gain"), F.count(F.lit(1)).alias("splits"))
        names = self.nodes.sparkSession.createDataFrame([(f,) for f in self.features], "feature string")
        every = names.join(found, "feature", "left").select("feature", F.coalesce("mean_gain", F.lit(0.0)).alias("mean_gain"), F.coalesce("splits", F.lit(0)).alias("splits"))
        total = every.agg(F.sum("mean_gain")).scalar()
        share = F.when(total > 0, F.col("mean_gain") / total).otherwise(0.0)
        # one row per feature
        ahead = every.select(F.col("mean_gain").alias("o_gain"), F.col("feature").alias("o_feature"))
        before = (F.col("o_gain") > F.col("mean_gain")) | ((F.col("o_gain") == F.col("mean_gain")) & (F.col("o_feature") < F.col("feature")))
        ranks = every.join(ahead, before, "left").groupBy("feature").agg((F.count("o_feature") + 1).alias("rank"))
        return every.join(ranks, "feature").select("feature", share.alias("importance"), "splits", "rank")


def cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Per feature the distinct exact quantiles (interpolated), at most ``bins - 1`` thresholds; all features in one pass."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("f"), F.col(f).cast("double").alias("value")) for k, f in enumerate(features)]))
    counts = df.select(cells.alias("c")).select("c.*").where("value IS NOT NULL").groupBy("f", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sums(counts, "value", ["n"], ["f"])
    place = f"i / {float(bins)!r}D * (total_n - 1)"

    def holds(position: str) -> str:
        return f"filter(sequence(1, {bins - 1}), i -> cum_n - n <= {position} AND {position} < cum_n)"

    ends = ranked.selectExpr("f", "value", "total_n", f"{holds(f'floor({place})')} AS lows", f"{holds(f'least(floor({place}) + 1, total_n - 1)')} AS highs")
    low, high, total = {}, {}, {}
    # at most two values per quantile
    for r in ends.where("size(lows) > 0 OR size(highs) > 0").collect():
        total[r.f] = r.total_n
        low.update({(r.f, i): r.value for i in r.lows})
        high.update({(r.f, i): r.value for i in r.highs})
    out: list[set[float]] = [set() for _ in features]
    for (f, i), value in low.items():
        at = i / bins * (total[f] - 1)
        out[f].add(value + (at - math.floor(at)) * (high[f, i] - value))
    return [sorted(x) for x in out]


def columns_of(tree: int, features: Sequence[str], share: float, seed: int) -> list[int]:
    """The features that a tree may split by: those with the smallest hashes."""
    order = sorted(range(len(features)), key=lambda k: hashlib.md5(f"{seed}|{tree}|{features[k]}".encode()).hexdigest())
    return sorted(order[: max(1, round(share * len(features)))])


def best_split(sums: dict[int, dict[int, tuple[float, float]]], node: Node, settings: Settings) -> tuple | None:
    """(gain, feature, cut, nulls_left, left gradient, left Hessian) of a node from its sums by feature and bin; bin -1 holds nulls.

    Of equal gains (to nine digits) the first feature, the lowest cut and nulls to the right win.
    """
    penalty, least = settings.leaf_penalty, settings.least_hessian

    def part(g: float, h: float) -> float:
        return g * g / (h + penalty)

    best, key = None, None
    for feature, bins in sorted(sums.items()):
        g_null, h_null = bins.get(-1, (0.0, 0.0))
        g, h = 0.0, 0.0
        for k, b in enumerate(sorted(x for x in bins if x >= 0)):
            if k:
                for nulls_left in (False, True) if -1 in bins else (False,):
                    gl, hl = (g + g_null, h + h_null) if nulls_left else (g, h)
                    gr, hr = node.gradient - gl, node.hessian - hl
                    gain = part(gl, hl) + part(gr, hr) - part(node.gradient, node.hessian)
                    if min(hl, hr) >= least and gain > LEAST_GAIN and (key is None or round(gain, 9) > key):
                        best, key = (gain, feature, b, nulls_left, gl, hl), round(gain, 9)
            g, h = g + bins[b][0], h + bins[b][1]
    return best


def _descend(splits: dict[int, Node], level: int) -> str:
    """SQL: the children of a level's split nodes; other nodes stay.

    A lookup in literal arrays as long as the level is wide: they are values and not code, so the code of a level is compiled once
    for all trees.
    """
    first = 2**level
    every = [splits.get(n) for n in range(first, 2 * first)]

    def lookup(values: list) -> str:
        return f"element_at(array({', '.join(str(v).lower() for v in values)}), node - {first - 1})"

    found = f"element_at(bins, {lookup([x.feature + 1 if x else 1 for x in every])})"
    left = f"IF({found} < 0, {lookup([x.nulls_left if x else False for x in every])}, {found} < {lookup([x.cut if x else 0 for x in every])})"
    return f"IF(node >= {first} AND {lookup([x is not None for x in every])}, IF({left}, 2 * node, 2 * node + 1), node)"


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], settings: Settings | None = None) -> BoostedTrees:
    """Fit on all rows of ``df``; ``keys`` name the unique key that rows are drawn by. Rows without a label are left out."""
    settings, features = settings or Settings(), list(features)
    spark = df.sparkSession
    table = materialise(df.where(F.col(label).isNotNull()).select(*dict.fromkeys([*keys, *features]), F.col(label).cast("double").alias("_y")), "boosting-rows")
    limits = cuts(table, features, settings.bins)

    def bin_number(f: str, points: list[float]) -> Column:
        x = F.col(f).cast("double")
        below = F.size(F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p <= x)) if points else F.lit(0)
        return F.when(x.isNull(), -1).otherwise(below)

    bins = F.array(*[bin_number(f, points) for f, points in zip(features, limits, strict=True)])
    # the key's digest stands for the key from here on
    rows = materialise(table.select("_y", bins.alias("bins"), digest(settings.seed, *[F.col(k) for k in keys]).alias("key"), F.lit(settings.base_margin).alias("margin")), "boosting-margins")
    out: list[tuple] = []
    for tree in range(1, settings.trees + 1):
        nodes = _grow(rows, tree, features, settings)
        if nodes is None:
            break
        value = {n: -settings.rate * x.gradient / (x.hessian + settings.leaf_penalty) for n, x in nodes.items()}
        for n, x in sorted(nodes.items()):
            name, threshold = (None, None) if x.feature is None else (features[x.feature], limits[x.feature][x.cut - 1])
            out.append((tree, n, name, threshold, None if x.feature is None else x.nulls_left, x.gain, x.hessian, value[n]))
        if tree < settings.trees:
            at = rows.selectExpr("*", "1 AS node")
            for level in range(settings.depth):
                splits = {n: x for n, x in nodes.items() if x.feature is not None and n.bit_length() == level + 1}
                at = at.selectExpr("_y", "bins", "key", "margin", f"{_descend(splits, level)} AS node")
            values = ", ".join(f"{value.get(n, 0.0)!r}D" for n in range(1, 2 ** (settings.depth + 1)))
            rows = materialise(at.selectExpr("_y", "bins", "key", f"margin + element_at(array({values}), node) AS margin"), "boosting-margins")
    return BoostedTrees(spark.createDataFrame(out, NODES), features, settings)


def _grow(rows: DataFrame, tree: int, features: list[str], settings: Settings) -> dict[int, Node] | None:
    """The nodes of one tree by heap number; None if no row was drawn."""
    columns = columns_of(tree, features, settings.column_share, settings.seed)
    drawn = rows.where(digest_uniform(F.md5(F.concat("key", F.lit(f"|{tree}")))) < settings.row_share)
    at = drawn.selectExpr("_y", "bins", "1 / (1 + exp(-margin)) AS p").selectExpr("bins", "p - _y AS g", "p * (1 - p) AS h", "1 AS node")
    chosen = ", ".join(f"named_struct('feature', {k}, 'bin', element_at(bins, {k + 1}))" for k in columns)
    nodes: dict[int, Node] = {}
    open_nodes: list[int] = [1]
    for level in range(settings.depth):
        # rows in leaves are summed too: a filter on the node would be pushed down with all the splits that lead to it
        rows_of = at.selectExpr("node", "g", "h", f"explode(array({chosen})) AS c")
        sums = rows_of.groupBy("node", "c.feature", "c.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        by_node: dict = defaultdict(lambda: defaultdict(dict))
        # bounded by the settings: nodes of a level, features, bins
        for r in sums.collect():
            by_node[r.node][r.feature][r.bin] = (r.g, r.h)
        if level == 0:
            if not by_node:
                return None
            first = by_node[1][columns[0]].values()
            nodes[1] = Node(sum(g for g, _ in first), sum(h for _, h in first))
        splits: dict[int, Node] = {}
        for n in open_nodes:
            found = best_split(by_node[n], nodes[n], settings)
            if found:
                node = nodes[n]
                node.gain, node.feature, node.cut, node.nulls_left, gl, hl = found
                nodes[2 * n], nodes[2 * n + 1] = Node(gl, hl), Node(node.gradient - gl, node.hessian - hl)
                splits[n] = node
        open_nodes = [c for n in splits for c in (2 * n, 2 * n + 1)]
        if not open_nodes:
            break
        at = at.selectExpr("bins", "g", "h", f"{_descend(splits, level)} AS node")
    return nodes
