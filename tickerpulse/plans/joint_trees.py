"""Decision trees of all symbols, subsets and criteria, grown level by level, then pruned by cost and
complexity.

A pass counts, for every open node of every tree, the classes per (feature, bin); Spark adds the
counts up, takes running sums over the bins and keeps the best split of each node. Features are cut
into ``BINS`` bins at quantiles of the symbol (of their values only, never of labels). A node looks at as many
features as its setting says, drawn by a hash of its path.

One tree serves all depths and all complexities of a setting: a tree of smaller depth is its top, and
the subtree that minimises impurity + alpha * leaves follows from the node table by one sweep
from the leaves up (weakest-link pruning ends in the same subtree). A node whose own impurity, weighted
by its share of the rows, is not above the smallest alpha loses any split it is given, so it is not split
at all; that bounds a tree by depth / alpha nodes, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joint import Batch, Problem, Scores, Subset, _sums, held_out, held_out_counts, in_training, summed

BINS = 64
SEED = 1024


class Setting(NamedTuple):
    features: str
    alpha: float
    depth: int
    criterion: str


@dataclass
class Nodes:
    """The nodes of all trees of one symbol, parents before children; node t is the root of tree t.
    ``left`` is -1 at leaves of the full tree, the right child comes after the left one."""

    tree: np.ndarray
    depth: np.ndarray
    path: np.ndarray  # 1 at the root, then a bit for each turn
    feature: np.ndarray
    cut: np.ndarray  # the last bin that goes left
    left: np.ndarray
    classes: np.ndarray  # [node, class]

    def add(self, parents: np.ndarray, classes: np.ndarray) -> np.ndarray:
        first = len(self.tree) + 2 * np.arange(len(parents))
        twice = parents.repeat(2)
        self.left[parents] = first
        self.tree = np.append(self.tree, self.tree[twice])
        self.depth = np.append(self.depth, self.depth[twice] + 1)
        self.path = np.append(self.path, self.path[twice] * 2 + np.tile([0, 1], len(parents)))
        none = np.full(len(twice), -1)
        self.feature, self.cut, self.left = (np.append(x, none) for x in (self.feature, self.cut, self.left))
        self.classes = np.concatenate([self.classes, classes])
        return first


@dataclass(frozen=True)
class Forest:
    """``variants``: (criterion, features looked at); tree number = subset * variants + variant."""

    settings: tuple[Setting, ...]
    variants: tuple[tuple[str, int], ...]
    edges: np.ndarray  # [symbol, feature, bin]
    nodes: list[Nodes]
    passes: int

    def variant_of(self, setting: Setting, features: int) -> int:
        return self.variants.index((setting.criterion, looked_at(setting.features, features)))


def looked_at(rule: str, features: int) -> int:
    return max(1, int({"sqrt": math.sqrt, "log2": math.log2, "all": float}[rule](features)))


def impurity(classes: np.ndarray, entropy: np.ndarray) -> np.ndarray:
    n = np.maximum(classes.sum(-1), 1e-300)
    p = classes[..., 1] / n
    q = classes[..., 0] / n
    with np.errstate(divide="ignore", invalid="ignore"):
        bits = -(np.where(p > 0, p * np.log2(p), 0) + np.where(q > 0, q * np.log2(q), 0))
    return np.where(entropy, bits, 1 - p * p - q * q)


def _edges(problem: Problem, bins: int) -> np.ndarray:
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    names = [f"x{i}" for i in range(len(problem.features))]
    rows = problem.rows.groupBy("symbol").agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in names]).collect()
    out = np.zeros((len(problem.symbols), len(names), bins - 1))
    for r in rows:
        out[problem.symbols.index(r.symbol)] = [r[c] for c in names]
    return out


def _binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)])


def _reached(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, trees: int) -> np.ndarray:
    """[row, tree]: the node where each row ends up."""
    at = np.broadcast_to(np.arange(trees), (len(bins), trees)).copy()
    row = np.arange(len(bins))[:, None]
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        at = np.where(inner, left[at] + (bins[row, np.maximum(f, 0)] > cut[at]), at)


def _drawn(path: np.ndarray, features: int) -> np.ndarray:
    """[node, feature]: features in the order in which a node at this path looks at them."""
    x = (path[:, None].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (
        (np.arange(features, dtype=np.uint64) + np.uint64(SEED)) * np.uint64(0xBF58476D1CE4E5B9))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return np.argsort(x ^ (x >> np.uint64(29)), axis=1, kind="stable")


def _histograms(own: Batch, state: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Class counts per (node, criterion, slot, bin) of the open nodes; a slot is one of the features drawn."""
    subsets, variants, edges, symbols = state
    feature, cut, left, open_, slots = symbols[own.symbol]
    if not open_.any() or not len(own.x):
        return
    bins = _binned(own.x, edges[own.symbol])
    at = _reached(bins, feature, cut, left, len(subsets) * len(variants))
    inside = np.stack([in_training(Subset(*u), own.outer, own.inner) for u in subsets], 1).repeat(len(variants), 1)
    row, tree = np.nonzero(inside & open_[at])
    if not len(row):
        return
    node, entropy = at[row, tree], np.array([c == "entropy" for c, _ in variants])[tree % len(variants)]
    for slot in range(slots.shape[1]):
        f = slots[node, slot]
        able = f >= 0
        n_bins = edges.shape[2] + 1
        key, back = np.unique(node[able] * n_bins + bins[row[able], f[able]], return_inverse=True)
        if not len(key):
            continue
        one = np.bincount(back, own.label[row[able]], len(key))
        kind = np.zeros(len(key))
        kind[back] = entropy[able]
        yield (np.column_stack([key // n_bins, kind, np.full(len(key), slot), key % n_bins]),
               np.column_stack([np.bincount(back, minlength=len(key)) - one, one]))


def _best_splits(counts: DataFrame) -> DataFrame:
    """(symbol, node, slot, bin, and the classes left of the cut) of the split that lowers the impurity most."""
    key = ["symbol", "node", "slot"]
    so_far = Window.partitionBy(*key).orderBy("bin")
    whole = Window.partitionBy(*key)
    placed = counts.select(
        *key, "bin", "entropy", F.sum("v0").over(so_far).alias("l0"), F.sum("v1").over(so_far).alias("l1"),
        F.sum("v0").over(whole).alias("n0"), F.sum("v1").over(whole).alias("n1"))

    def weighted(a, b):
        n = a + b
        bits = F.when(a > 0, -a * F.log2(a / n)).otherwise(0.0) + F.when(b > 0, -b * F.log2(b / n)).otherwise(0.0)
        return F.when(F.col("entropy") == 1, bits).otherwise(n - (a * a + b * b) / n)

    l0, l1 = F.col("l0"), F.col("l1")
    r0, r1 = F.col("n0") - l0, F.col("n1") - l1
    able = placed.where((r0 + r1) > 0)
    gain = weighted(F.col("n0"), F.col("n1")) - weighted(l0, l1) - weighted(r0, r1)
    # equal gains: rounding must not decide between them
    order = F.struct(F.round(gain, 9), -F.col("slot"), -F.col("bin"), l0, l1)
    return able.groupBy("symbol", "node").agg(F.max(order).alias("b")).select(
        "symbol", "node", (-F.col("b.col2")).alias("slot"), (-F.col("b.col3")).alias("bin"), "b.l0", "b.l1")


def grow(problem: Problem, settings: Sequence[Setting], bins: int = BINS) -> Forest:
    features = len(problem.features)
    variants = tuple(dict.fromkeys((s.criterion, looked_at(s.features, features)) for s in settings))
    trees = len(problem.subsets) * len(variants)
    smallest, deepest = min(s.alpha for s in settings), max(s.depth for s in settings)
    edges = _edges(problem, bins)
    entropy = np.array([c == "entropy" for c, _ in variants])
    slots_of = np.array([n for _, n in variants])
    nodes = []
    for s in range(len(problem.symbols)):
        roots = np.arange(trees)
        none = np.full(trees, -1)
        nodes.append(Nodes(roots, np.zeros(trees, int), np.ones(trees, int), none.copy(), none.copy(), none.copy(),
                           problem.counts[s].repeat(len(variants), 0)))

    def open_nodes(own: Nodes, since: int) -> np.ndarray:
        at = np.arange(len(own.tree)) >= since
        share = own.classes.sum(1) / np.maximum(own.classes[own.tree].sum(1), 1)
        return at & (own.depth < deepest) & (share * impurity(own.classes, entropy[own.tree % len(variants)]) > smallest)

    since, passes = [0] * len(nodes), 0
    while True:
        opened = [open_nodes(own, a) for own, a in zip(nodes, since)]
        if not any(o.any() for o in opened):
            break
        passes += 1
        slots = []
        for own in nodes:
            drawn = _drawn(own.path, features)[:, :slots_of.max()]
            drawn[np.arange(slots_of.max()) >= slots_of[own.tree % len(variants)][:, None]] = -1
            slots.append(drawn)
        state = (tuple(problem.subsets), variants, edges,
                 [(own.feature, own.cut, own.left, o, d) for own, o, d in zip(nodes, opened, slots)])
        counts = _sums(problem, _histograms, state, ["node", "entropy", "slot", "bin"], 2)
        found = _best_splits(counts).toPandas()  # a row for each open node
        since = [len(own.tree) for own in nodes]
        for s, rows in found.groupby("symbol"):
            own, rows = nodes[s], rows.sort_values("node")
            parents = rows["node"].to_numpy()
            own.feature[parents] = slots[s][parents, rows["slot"].to_numpy()]
            own.cut[parents] = rows["bin"].to_numpy()
            left = rows[["l0", "l1"]].to_numpy()
            own.add(parents, np.stack([left, own.classes[parents] - left], 1).reshape(-1, 2))
    return Forest(tuple(settings), variants, edges, nodes, passes)


def leaves(own: Nodes, entropy: np.ndarray, alpha: float, depth: int) -> np.ndarray:
    """Which nodes are leaves of the pruned trees: of all subtrees no deeper than ``depth`` the smallest that
    minimises impurity + alpha * leaves. ``entropy``: by tree."""
    share = own.classes.sum(1) / np.maximum(own.classes[own.tree].sum(1), 1)
    cost = share * impurity(own.classes, entropy[own.tree]) + alpha
    split = np.zeros(len(cost), bool)
    for level in range(depth - 1, -1, -1):
        at = np.flatnonzero((own.depth == level) & (own.left >= 0))
        below = cost[own.left[at]] + cost[own.left[at] + 1]
        better = below < cost[at] - 1e-12
        split[at[better]] = True
        cost[at[better]] = below[better]
    reached = own.depth == 0
    for level in range(depth):
        at = np.flatnonzero(reached & split & (own.depth == level))
        reached[own.left[at]] = reached[own.left[at] + 1] = True
    return reached & ~split


def _test_counts(own: Batch, state: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    subsets, variants, edges, symbols = state
    feature, cut, left = symbols[own.symbol]
    if not len(own.x):
        return
    at = _reached(_binned(own.x, edges[own.symbol]), feature, cut, left, len(subsets) * variants)
    judging = np.stack([held_out(Subset(*u), own.outer, own.inner) for u in subsets], 1).repeat(variants, 1)
    row, tree = np.nonzero(judging)
    node, back = np.unique(at[row, tree], return_inverse=True)
    one = np.bincount(back, own.label[row], len(node))
    yield node[:, None], np.column_stack([np.bincount(back, minlength=len(node)) - one, one])


def scores(problem: Problem, forest: Forest) -> Scores:
    """Right predictions of every setting on the held-out rows, from one pass that counts their classes per node."""
    variants = len(forest.variants)
    state = (tuple(problem.subsets), variants, forest.edges, [(n.feature, n.cut, n.left) for n in forest.nodes])
    keys, values = summed(problem, _test_counts, state, ["node"], 2)
    right = np.zeros((len(problem.symbols), len(problem.subsets), len(forest.settings)))
    entropy = np.array([c == "entropy" for c, _ in forest.variants])
    for s, own in enumerate(forest.nodes):
        seen = np.zeros((len(own.tree), 2))
        seen[keys[keys[:, 0] == s, 1]] = values[keys[:, 0] == s]
        for level in range(int(own.depth.max()) - 1, -1, -1):
            at = np.flatnonzero((own.depth == level) & (own.left >= 0))
            seen[at] += seen[own.left[at]] + seen[own.left[at] + 1]
        hits = seen[np.arange(len(seen)), np.argmax(own.classes, 1)]
        done: dict[tuple[float, int], np.ndarray] = {}
        for k, setting in enumerate(forest.settings):
            which = (setting.alpha, setting.depth)
            if which not in done:
                leaf = leaves(own, np.tile(entropy, len(problem.subsets)), *which)
                done[which] = np.bincount(own.tree[leaf], hits[leaf], len(problem.subsets) * variants).reshape(-1, variants)
            right[s, :, k] = done[which][:, forest.variant_of(setting, len(problem.features))]
    return Scores(right, held_out_counts(problem))


def node_table(problem: Problem, forest: Forest, symbol: int, subset: int, setting: Setting) -> list[dict]:
    """The pruned tree of one setting: node, feature, threshold (values up to it go left), left and right
    (null at leaves) and the class. Node 0 is the root."""
    own = forest.nodes[symbol]
    variants = len(forest.variants)
    leaf = leaves(own, np.tile([c == "entropy" for c, _ in forest.variants], len(problem.subsets)), setting.alpha, setting.depth)
    out, todo = [], [subset * variants + forest.variant_of(setting, len(problem.features))]
    number = {todo[0]: 0}
    for node in todo:  # grows while it is read
        row = {"node": number[node], "feature": None, "threshold": None, "left": None, "right": None,
               "prediction": int(np.argmax(own.classes[node])), "rows": int(own.classes[node].sum())}
        if not leaf[node]:
            children = [int(own.left[node]), int(own.left[node]) + 1]
            for child in children:
                number[child] = len(number)
            row |= {"feature": int(own.feature[node]), "left": number[children[0]], "right": number[children[1]],
                    "threshold": float(forest.edges[symbol, own.feature[node], own.cut[node]])}
            todo += children
        out.append(row)
    return out
