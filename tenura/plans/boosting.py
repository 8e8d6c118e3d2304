"""Second-order gradient boosting with an L2 term on the leaves, by grouped aggregates.

Features are binned once. A level of a tree is one aggregate: sums of gradients and hessians by node, feature and bin, for
all settings and folds that are fitted together. What reaches the driver is a row for each bin of each node, whatever the
rows; the trees go back to the rows as expressions, so nothing is joined.
"""

from __future__ import annotations

import itertools
import math
import random
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators.monitoring import auc_by_rank
from tenura.sources.sinks import cut_lineage

# fixed values: search grid and training parameters
MAX_DEPTH = (3, 4, 5)
REG_LAMBDA = (1.0, 2.0)
MIN_CHILD_WEIGHT = (5.0, 10.0, 20.0)
ROUNDS = 50
STEP = 0.05
ROW_SHARE = 0.6
COLUMN_SHARE = 0.6
MIN_GAIN = 0.1
MAX_LEAF = 4.0

MOST_BINS = 64
#: Rounds between two written tables of margins.
WRITE_EVERY = 4


@dataclass(frozen=True)
class Setting:
    depth: int
    reg_lambda: float
    child_weight: float


GRID = [Setting(*each) for each in itertools.product(MAX_DEPTH, REG_LAMBDA, MIN_CHILD_WEIGHT)]


@dataclass
class Tree:
    """Nodes by number: the children of n are 2n (at most the split's bin) and 2n + 1."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)  # feature, last bin to the left
    gains: dict[int, float] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def text(self, test, leaf, node: int = 1) -> str:
        """SQL of the row's value: `test(feature, bin)` is true to the left, `leaf(node)` is a node's value."""
        if node not in self.splits:
            return leaf(node)
        return f"CASE WHEN {test(*self.splits[node])} THEN {self.text(test, leaf, 2 * node)} ELSE {self.text(test, leaf, 2 * node + 1)} END"

    def prune(self, least: float, node: int = 1) -> None:
        """From the bottom up, splits that gain less than `least` and have no split below them become leaves."""
        if node in self.splits:
            self.prune(least, 2 * node)
            self.prune(least, 2 * node + 1)
            if 2 * node not in self.splits and 2 * node + 1 not in self.splits and self.gains[node] < least:
                del self.splits[node]


def leaf_weight(g: float, h: float, reg_lambda: float) -> float:
    """The leaf that lowers the loss most, shrunk by lambda and bounded."""
    return max(-MAX_LEAF, min(MAX_LEAF, -g / (h + reg_lambda)))


def loss_fall(g: float, h: float, reg_lambda: float) -> float:
    w = leaf_weight(g, h, reg_lambda)
    return -(2 * g * w + (h + reg_lambda) * w * w)


def best_split(bins: dict[int, dict[int, tuple[float, float]]], setting: Setting) -> tuple[float, int, int] | None:
    """(gain, feature, last bin to the left) of a node; ties go to the first feature and bin."""
    found = None
    for feature in sorted(bins):
        total_g, total_h = (sum(x) for x in zip(*bins[feature].values()))
        whole, left_g, left_h = loss_fall(total_g, total_h, setting.reg_lambda), 0.0, 0.0
        for last in sorted(bins[feature])[:-1]:
            left_g, left_h = left_g + bins[feature][last][0], left_h + bins[feature][last][1]
            right_g, right_h = total_g - left_g, total_h - left_h
            if left_h < setting.child_weight or right_h < setting.child_weight:
                continue
            gain = loss_fall(left_g, left_h, setting.reg_lambda) + loss_fall(right_g, right_h, setting.reg_lambda) - whole
            if gain > 1e-6 and (found is None or gain > found[0] + 1e-12):
                found = (gain, feature, last)
    return found


@dataclass
class Boosted:
    """A fitted sum of trees over an array of features."""

    thresholds: list[list[float]]
    trees: list[Tree]
    step: float

    def margin(self, features: str = "x", names: Sequence[str] | None = None) -> str:
        """SQL of the log odds, over an array of features or over columns of these names."""
        def test(f, b):
            return f"{f'{features}[{f}]' if names is None else f'`{names[f]}`'} <= {self.thresholds[f][b]!r}D"

        return " + ".join(["0D", *[f"{self.step}D * ({tree.text(test, lambda n, t=tree: repr(t.leaves[n]) + 'D')})" for tree in self.trees]])


def thresholds_of(data: DataFrame, size: int, most_bins: int = MOST_BINS) -> list[list[float]]:
    """For each feature values to cut at: quantiles, each once, without the largest value. One aggregate for all."""
    shares = F.array(*[F.lit(i / most_bins) for i in range(most_bins + 1)])
    found = data.agg(*[F.percentile_approx(F.col("x").getItem(j), shares, 10000).alias(f"x{j}") for j in range(size)]).first()
    cuts = [sorted({float(v) for v in (found[f"x{j}"] or []) if not math.isnan(v)}) for j in range(size)]
    return [c[:-1] for c in cuts]


def fit_together(data: DataFrame, size: int, variants: Sequence[tuple[Setting, int | None]], rounds: int = ROUNDS, step: float = STEP,
                 row_share: float = ROW_SHARE, column_share: float = COLUMN_SHARE, min_gain: float = MIN_GAIN, seed: int = 0) -> tuple[DataFrame, list[Boosted]]:
    """Fits a model for each (setting, fold left out) on `data` (key, x array of `size` doubles, label, class_weight, fold).

    Returns the rows with their `margins`, one for each variant, and the models. A round takes `row_share` of the rows, by
    a hash of the key, and `column_share` of the features; 1 takes all."""
    cuts = thresholds_of(data, size)
    bins = "array(" + ", ".join(
        f"size(filter(array({', '.join(f'{c!r}D' for c in cut)}), c -> c < x[{j}]))" if cut else "0" for j, cut in enumerate(cuts)) + ")"
    zero = ", ".join(["0D"] * len(variants))
    rows = cut_lineage(data.selectExpr("key", "x", "CAST(label AS DOUBLE) AS label", "CAST(class_weight AS DOUBLE) AS class_weight", "fold",
                                       f"{bins} AS bins", f"array({zero}) AS margins"), "boosting")
    chosen_of, models = random.Random(seed), [Boosted(cuts, [], step) for _ in variants]
    usable = [j for j in range(size) if cuts[j]]

    def binned(f, b):
        return f"bins[{f}] <= {b}"

    for number in range(rounds):
        chosen = sorted(chosen_of.sample(usable, math.ceil(column_share * len(usable)))) if usable else []
        part = rows if row_share >= 1 else rows.where(f"pmod(xxhash64(key, {seed}, {number}), 1000000) < {int(row_share * 1000000)}")
        trees, growing = [Tree() for _ in variants], {v: {1} for v in range(len(variants))}
        for level in range(max(setting.depth for setting, _ in variants) + 1):
            nodes = []
            for v, active in growing.items():
                if active:
                    node = trees[v].text(binned, lambda n, active=active: str(n) if n in active else "0")
                    left_out = variants[v][1]
                    node = node if left_out is None else f"CASE WHEN fold = {left_out} THEN 0 ELSE {node} END"
                    nodes.append(f"struct({v} AS v, {node} AS node, 1 / (1 + exp(-margins[{v}])) AS p)")
            if not nodes:
                break
            spread = part.selectExpr("bins", "label", "class_weight", f"inline(array({', '.join(nodes)}))").where("node > 0")
            # a feature without cuts stands for the node's sums where no other is chosen
            array = "array(" + ", ".join(f"struct({j} AS feature, bins[{j}] AS bin)" for j in chosen or [0]) + ")"
            sums = (spread.selectExpr("v", "node", "class_weight * (p - label) AS g", "class_weight * p * (1 - p) AS h", f"inline({array})")
                    .groupBy("v", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")))
            held: dict = defaultdict(lambda: defaultdict(dict))
            for r in sums.collect():  # a row for each bin of each node
                held[r["v"], r["node"]][r["feature"]][r["bin"]] = (r["g"], r["h"])
            following: dict[int, set[int]] = defaultdict(set)
            for (v, node), features in held.items():
                setting, tree = variants[v][0], trees[v]
                g, h = (sum(x) for x in zip(*next(iter(features.values())).values()))
                tree.leaves[node] = leaf_weight(g, h, setting.reg_lambda)
                found = best_split(features, setting) if level < setting.depth and chosen else None
                if found is not None:
                    tree.gains[node], tree.splits[node] = found[0], found[1:]
                    following[v] |= {2 * node, 2 * node + 1}
            growing = {v: following[v] for v in growing}
        for tree, model in zip(trees, models):
            tree.prune(min_gain)
            for node in [1, *[c for n in tree.splits for c in (2 * n, 2 * n + 1)]]:
                tree.leaves.setdefault(node, 0.0)  # no row of the sample came here
            model.trees.append(tree)
        added = ", ".join(f"margins[{v}] + {step}D * ({tree.text(binned, lambda n, t=tree: repr(t.leaves[n]) + 'D')})" for v, tree in enumerate(trees))
        rows = rows.withColumn("margins", F.expr(f"array({added})"))
        if number % WRITE_EVERY == WRITE_EVERY - 1:
            rows = cut_lineage(rows, "boosting")
    return rows, models


def cross_validated(data: DataFrame, size: int, settings: Sequence[Setting] = tuple(GRID), folds: int = 5, **options) -> list[tuple[Setting, float]]:
    """Mean ROC area of the rows left out, for each setting; all settings and folds are fitted in the same passes."""
    variants = [(setting, fold) for setting in settings for fold in range(folds)]
    rows, _ = fit_together(data, size, variants, **options)
    own = ", ".join(f"struct({v} AS v, margins[{v}] AS margin, {fold} AS left_out)" for v, (_, fold) in enumerate(variants))
    judged = rows.selectExpr("fold", "label", f"inline(array({own}))").where("fold = left_out")
    areas = {r["v"]: r["auc"] for r in auc_by_rank(judged, "margin", "label", ["v"]).collect()}
    found = []
    for position, setting in enumerate(settings):
        mine = [a for v in range(position * folds, (position + 1) * folds) if (a := areas.get(v)) is not None]
        found.append((setting, sum(mine) / len(mine) if mine else 0.0))
    return found
