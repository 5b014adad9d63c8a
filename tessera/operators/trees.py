"""Importances of a random forest over binned columns, for many fits of deep trees.

Spark's learner sends a histogram of every open node of every tree from every
partition at each level; 100 trees of depth 15 have millions of such nodes, most of
them with a few rows. Here the nodes with more than ``LOCAL_WEIGHT`` rows are split
in that way (a pass over the table per level), and every smaller one is grown to its
end by one task that is sent its rows, as blobs of bin numbers and labels. A task
holds the rows of one such node at a time whatever the table size, the driver only
the splits above them.

The trees are those of ``RandomForestRegressor``: Poisson bags (or subsamples),
splits at bin edges, a random subset of the features at each node, variance gain,
the same stopping rules and the same importances. Bags and subsets are hashes of
row and node numbers, so each pass and each retried task draws the same ones.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, NumericType, StructField, StructType

from ..functions.columns import q
from ..functions.quantiles import column_quantiles
from ..session import cut_lineage

LOCAL_WEIGHT = 4_000_000     # bagged rows of a node that one task may grow
ROWS_AT_ONCE = 1 << 15       # rows of a task that are dealt to the trees at a time
MOST_BINS = 256              # a bin number is a byte
ROUNDING = 1e-12             # a smaller share of a node's squares is no gain
ROW, LABEL, VALUES = "__row", "__label", "__values"


@dataclass(frozen=True)
class Forest:
    """What a fit needs of the estimator's parameters, for a given table."""
    trees: int
    depth: int
    bins: int
    subset: int        # features tried at a node
    least: float       # bagged rows of a child
    gain: float        # variance gain of a split
    bootstrap: bool
    rate: float
    seed: int


def supported(estimator, df: DataFrame, features: Sequence[str]) -> bool:
    """Whether ``importances`` grows what the estimator would: a forest on plain numbers."""
    return (isinstance(estimator, RandomForestRegressor) and estimator.getImpurity() == "variance"
            and estimator.getMaxBins() <= MOST_BINS and not (estimator.isDefined("weightCol") and estimator.getWeightCol())
            and all(isinstance(df.schema[c].dataType, (NumericType, BooleanType)) for c in features))


def subset_size(strategy: str, features: int, trees: int) -> int:
    """Features tried at a node, by Spark's names of strategies."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": features, "onethird": math.ceil(features / 3), "sqrt": math.ceil(math.sqrt(features)),
             "log2": max(1, math.ceil(math.log2(features)))}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), features) if strategy.isdigit() else math.ceil(float(strategy) * features)


def settings(estimator, features: int, rows: int) -> Forest:
    e = estimator
    return Forest(e.getNumTrees(), e.getMaxDepth(), e.getMaxBins(), subset_size(e.getFeatureSubsetStrategy(), features, e.getNumTrees()),
                  max(e.getMinInstancesPerNode(), e.getMinWeightFractionPerNode() * rows), e.getMinInfoGain(),
                  e.getBootstrap(), e.getSubsamplingRate(), e.getSeed())


# ------------------------------------------------------------------- bins

def split_points(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Ascending edges of each feature (bin = edges below the value): between all its
    values if these are ``bins`` at most, else the exact ``j/bins`` quantiles."""
    def few(batches):
        seen = [np.array([])] * len(features)
        for b in batches:
            for i in range(len(features)):
                if seen[i] is not None:
                    v = np.union1d(seen[i], b.column(i).to_numpy(zero_copy_only=False))
                    seen[i] = v if len(v) <= bins else None
        for i, v in enumerate(seen):       # a null: too many
            yield pa.RecordBatch.from_arrays([pa.array([i] * (1 if v is None else len(v)), pa.int32()),
                                              pa.array([None] if v is None else v, pa.float64())], ["i", "v"])

    values = df.select(*[F.col(q(c)).cast("double").alias(f"c{i}") for i, c in enumerate(features)])
    found = {r["i"]: r for r in values.mapInArrow(few, "i int, v double").groupBy("i")
             .agg(F.max(F.col("v").isNull()).alias("many"), F.collect_set("v").alias("v")).collect()}
    points = {i: np.unique(r["v"]) for i, r in found.items() if not r["many"]}
    points = {i: (v[1:] + v[:-1]) / 2 for i, v in points.items() if len(v) <= bins}
    many = [f"c{i}" for i in range(len(features)) if i not in points]
    if many:
        edges = column_quantiles(values.select(*many), many, [j / bins for j in range(1, bins)], exact=True, interpolation="inverted_cdf")
        points |= {int(c[1:]): np.unique(np.array(edges[c], float)) for c in many}
    return [points[i] for i in range(len(features))]


def binned(df: DataFrame, key: str, features: Sequence[str], label: str, bins: int) -> tuple[DataFrame, int]:
    """``(frame, rows)``: the key, a row number, the label less its mean and the bin
    numbers of the features, a byte each; written once. Missing or infinite values are an error, as in Spark's learner."""
    features = list(features)
    y, cols = F.col(q(label)).cast("double"), [F.col(q(c)).cast("double") for c in features]

    def bad(c):
        return F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(True))
    told = df.agg(F.count("*").alias("n"), F.avg(y).alias("mean"), *[F.count(F.when(bad(c), 1)).alias(f"b{i}") for i, c in enumerate([y, *cols])]).first()
    wrong = [c for i, c in enumerate([label, *features]) if told[f"b{i}"]]
    if wrong or not told["n"]:
        raise ValueError(f"a forest needs values in {', '.join(wrong)}" if wrong else "a forest needs rows")
    points = split_points(df, features, bins)

    def pack(batches):
        for b in batches:
            x = np.empty((b.num_rows, len(features)), np.uint8)
            for i, at in enumerate(points):
                x[:, i] = np.searchsorted(at, b.column(3 + i).to_numpy(zero_copy_only=False), "left")
            yield pa.RecordBatch.from_arrays([*b.columns[:3], _blobs(x)], [key, ROW, LABEL, VALUES])

    flat = df.select(F.col(q(key)), F.monotonically_increasing_id().alias(ROW), (y - F.lit(told["mean"])).alias(LABEL),
                     *[c.alias(f"c{i}") for i, c in enumerate(cols)])
    schema = StructType([df.schema[key], StructField(ROW, LongType()), StructField(LABEL, DoubleType()), StructField(VALUES, BinaryType())])
    return cut_lineage(flat.mapInArrow(pack, schema)), told["n"]


def _blobs(x: np.ndarray) -> pa.Array:
    """A binary value of each row of a byte matrix."""
    n, k = x.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(k)),
                                                  pa.py_buffer(np.ascontiguousarray(x))])


def _matrix(a: pa.Array) -> np.ndarray:
    a = a.cast(pa.large_binary())
    at = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    return np.frombuffer(a.buffers()[2], np.uint8)[at[0]:at[-1]].reshape(len(a), -1)


# ------------------------------------------------------------ bags, subsets

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _stream(p: Forest, tree: int, what: int) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for v in (p.seed, tree, what):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(v % (1 << 64)) + np.uint64(0x632BE59BD9B4E019))
    return h[0]


def bag(rows: np.ndarray, p: Forest, tree: int) -> np.ndarray:
    """How often each row is in the tree's sample."""
    if not p.bootstrap and p.rate == 1:
        return np.ones(len(rows), np.uint8)
    u = _mix(_mix(rows.astype(np.uint64) + _stream(p, tree, 1)) * np.uint64(0x9E3779B97F4A7C15) + _stream(p, tree, 2)) >> np.uint64(11)
    if not p.bootstrap:
        return (u < p.rate * 2.0 ** 53).astype(np.uint8)
    at = np.cumsum([math.exp(-p.rate) * p.rate ** k / math.factorial(k) for k in range(40)]) * 2.0 ** 53
    w = np.zeros(len(u), np.uint8)
    for c in at[:3]:
        w += u >= np.uint64(c)
    rest = np.flatnonzero(w == 3)
    w[rest] = np.searchsorted(at, u[rest].astype(float), "right")
    return w


def subsets(nodes: np.ndarray, p: Forest, tree: int, features: int) -> np.ndarray:
    """The features tried at each node (numbered as in a heap from 1), in random order."""
    h = _mix(nodes.astype(np.uint64) + _stream(p, tree, 3))[:, None] + _mix(np.arange(features, dtype=np.uint64) + _stream(p, tree, 4))[None, :]
    return np.argsort(_mix(h), axis=1)[:, :p.subset]


# ------------------------------------------------------------------ growth

class _Best:
    """The best split of each of some nodes, from their histograms of one feature after another."""

    def __init__(self, weight: np.ndarray, total: np.ndarray):
        self.weight, self.total, self.base = weight, total, total ** 2 / weight
        self.gain, self.feature, self.bin = np.full(len(weight), -np.inf), np.full(len(weight), -1), np.zeros(len(weight), int)
        self.left = np.zeros(len(weight))

    def offer(self, feature: np.ndarray, count: np.ndarray, total: np.ndarray, p: Forest) -> None:
        n, s = count.cumsum(1)[:, :-1], total.cumsum(1)[:, :-1]
        m = self.weight[:, None] - n
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = s * s / n + (self.total[:, None] - s) ** 2 / m
        gain[(n < p.least) | (m < p.least)] = -np.inf
        at, k = gain.argmax(1), np.arange(len(gain))
        gain = gain[k, at] - self.base
        better = np.flatnonzero((gain > self.gain) & (gain > ROUNDING * self.base) & (gain > 0) & (gain >= p.gain * self.weight))
        self.gain[better], self.feature[better], self.bin[better] = gain[better], feature[better], at[better]
        self.left[better] = n[better, at[better]]


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, root: int, p: Forest, tree: int) -> np.ndarray:
    """The summed gains of each feature in the tree below ``root``, from that node's rows."""
    features, gains = x.shape[1], np.zeros(x.shape[1])
    flat, first, w = np.ascontiguousarray(x).ravel(), np.arange(len(w)) * features, w.astype(float)      # first: of a row in flat
    wy, slot, nodes = w * y, np.zeros(len(w), np.int64), np.array([root], np.uint64)
    for _ in range(root.bit_length() - 1, p.depth):
        best = _Best(np.bincount(slot, w, len(nodes)), np.bincount(slot, wy, len(nodes)))
        tried, cells = subsets(nodes, p, tree, features).T.copy(), slot * p.bins
        for feature in tried:
            at = feature.take(slot)
            at += first
            np.add(cells, flat.take(at), out=at)
            count, total = (np.bincount(at, v, len(nodes) * p.bins).reshape(-1, p.bins) for v in (w, wy))
            best.offer(feature, count, total, p)
        split = best.feature >= 0
        gains += np.bincount(best.feature[split], best.gain[split], features)
        # children that can be split again, and their rows
        weight = np.stack([best.left, best.weight - best.left], 1)
        live = (split[:, None] & (weight >= 2 * p.least)).ravel()
        child = 2 * slot + (flat.take(best.feature.take(slot) + first) > best.bin.take(slot))
        kept = np.flatnonzero(live.take(child))
        if not len(kept):
            break
        first, w, wy, slot = first.take(kept), w.take(kept), wy.take(kept), (np.cumsum(live) - 1).take(child.take(kept))
        nodes = (2 * nodes[:, None] + np.arange(2, dtype=np.uint64)).ravel()[live]
    return gains


SPLIT, CLOSED = -2, -1


class _Top:
    """The splits of a tree above the nodes that are still open, as arrays by node number."""

    def __init__(self, splits: Mapping[int, tuple[int, int]], open_: Mapping[int, int]):
        n = max([1, *open_, *splits]) + 1
        self.state, self.feature, self.bin = np.full(n, CLOSED, np.int32), np.zeros(n, np.int32), np.zeros(n, np.uint8)
        for h, (f, b) in splits.items():
            self.state[h], self.feature[h], self.bin[h] = SPLIT, f, b
        for h, i in open_.items():
            self.state[h] = i

    def route(self, x: np.ndarray) -> np.ndarray:
        """The number that was given to each row's open node, or ``CLOSED``."""
        if self.state[1] != SPLIT:
            return np.full(len(x), self.state[1])
        at, rows = np.ones(len(x), np.int64), np.arange(len(x))
        while len(rows):
            inner = self.state[at[rows]] == SPLIT
            rows = rows[inner]
            h = at[rows]
            at[rows] = 2 * h + (x[rows, self.feature[h]] > self.bin[h])
            at[rows[at[rows] >= len(self.state)]] = 0          # below the last open node
        return self.state[at]


def _chunks(batches, picks: Sequence[Sequence[int]]):
    """``(row numbers, labels, bins)`` of about ``ROWS_AT_ONCE`` rows; the bins are the picked
    features of each binary column, side by side."""
    held, n = [], 0

    def joined():
        return tuple(np.concatenate(v) for v in zip(*held))
    for b in batches:
        if not b.num_rows:
            continue
        x = np.concatenate([_matrix(b.column(2 + i))[:, list(k)] for i, k in enumerate(picks)], 1)
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy(), x))
        n += b.num_rows
        if n >= ROWS_AT_ONCE:
            yield joined()
            held, n = [], 0
    if held:
        yield joined()


def importances(df: DataFrame, values: Mapping[str, Sequence[int]], rows: int, estimator) -> np.ndarray:
    """Importances (sum 1) of the picked features: ``values`` names the binary columns of a
    ``binned`` frame and the features of each."""
    picks, features = list(values.values()), sum(map(len, values.values()))
    p = settings(estimator, features, rows)
    d = df.select(ROW, LABEL, *[F.col(q(c)) for c in values])
    gains = np.zeros((p.trees, features))
    splits: list[dict] = [{} for _ in range(p.trees)]
    open_ = {(t, 1): p.rate * rows for t in range(p.trees)} if p.depth else {}
    if any(v > LOCAL_WEIGHT for v in open_.values()):
        d = cut_lineage(d)                 # read by every pass
    while big := [k for k, v in open_.items() if v > LOCAL_WEIGHT]:
        for r in _split(d, picks, splits, big, p, features):
            del open_[r["tree"], r["node"]]
            if r["feature"] < 0:
                continue
            splits[r["tree"]][r["node"]] = (r["feature"], r["bin"])
            gains[r["tree"], r["feature"]] += r["gain"]
            for h, v in ((2 * r["node"], r["lower"]), (2 * r["node"] + 1, r["upper"])):
                if h.bit_length() <= p.depth and v >= 2 * p.least:
                    open_[r["tree"], h] = v
    if open_:
        for r in _finish(d, picks, splits, open_, p):
            gains[r["tree"]] += r["gains"]
    # as Spark: a tree's importances sum to 1, and so do those of all
    each = gains.sum(1, keepdims=True)
    out = np.divide(gains, each, out=np.zeros_like(gains), where=each > 0).sum(0)
    return out / out.sum() if out.sum() > 0 else out


def _tops(splits, numbered: Mapping[tuple[int, int], int], p: Forest) -> list[_Top]:
    by_tree: list[dict] = [{} for _ in range(p.trees)]
    for (t, h), i in numbered.items():
        by_tree[t][h] = i
    return [_Top(splits[t], by_tree[t]) if by_tree[t] else None for t in range(p.trees)]


def _split(d: DataFrame, picks, splits, big, p: Forest, features: int) -> list:
    """The best split of each of the nodes ``(tree, node)``, by one pass over the table."""
    nodes = {t: np.array(sorted(h for u, h in big if u == t), np.uint64) for t in {t for t, _ in big}}
    tops = _tops(splits, {(t, int(h)): i for t, hs in nodes.items() for i, h in enumerate(hs)}, p)
    tried = {t: subsets(hs, p, t, features) for t, hs in nodes.items()}

    def count(batches):
        held = {t: np.zeros((2, len(hs), p.subset, p.bins)) for t, hs in nodes.items()}
        for ids, y, x in _chunks(batches, picks):
            for t, total in held.items():
                w, slot = bag(ids, p, t), tops[t].route(x)
                r = np.flatnonzero((w > 0) & (slot >= 0))
                slot, w, n = slot[r].astype(np.int64), w[r].astype(float), total[0, :, 0].size
                wy = w * y[r]
                for j in range(p.subset):
                    cell = slot * p.bins + x[r, tried[t][slot, j]]
                    for v, to in zip((w, wy), total):
                        to[:, j] += np.bincount(cell, v, n).reshape(-1, p.bins)
        for t, total in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["tree", "total"])

    def choose(t: pa.Table) -> pa.Table:
        tree = t.column("tree")[0].as_py()
        hs, total = nodes[tree], 0
        for part in sorted(v.as_py() for v in t.column("total")):      # in one order: the sums do not depend on the tasks'
            total = total + np.frombuffer(part)
        n, s = total.reshape(2, len(hs), p.subset, p.bins)
        best = _Best(n[:, 0].sum(1), s[:, 0].sum(1))
        for j in range(p.subset):
            best.offer(tried[tree][:, j], n[:, j], s[:, j], p)
        return pa.table({"tree": pa.array([tree] * len(hs), pa.int32()), "node": pa.array(hs.astype(np.int64)), "feature": pa.array(best.feature, pa.int32()),
                         "bin": pa.array(best.bin, pa.int32()), "gain": best.gain, "lower": best.left, "upper": best.weight - best.left})

    return (d.mapInArrow(count, "tree int, total binary").groupBy("tree")
            .applyInArrow(choose, "tree int, node bigint, feature int, bin int, gain double, lower double, upper double").collect())


def _finish(d: DataFrame, picks, splits, open_, p: Forest) -> list:
    """The gains below each open node, by a task that has its rows."""
    groups = sorted(open_, key=lambda k: (-open_[k], k))
    parts = min(len(groups), max(4 * d.sparkSession.sparkContext.defaultParallelism, math.ceil(2 * sum(open_.values()) / LOCAL_WEIGHT)))
    load, part = [(0.0, i) for i in range(parts)], []
    for k in groups:                       # the heaviest first, each to the lightest part
        held, i = heapq.heappop(load)
        part.append(i)
        heapq.heappush(load, (held + open_[k], i))
    tops = _tops(splits, {k: g for g, k in enumerate(groups)}, p)

    def deal(batches):
        for ids, y, x in _chunks(batches, picks):
            for t, top in enumerate(tops):
                if top is None:
                    continue
                w, g = bag(ids, p, t), top.route(x)
                r = np.flatnonzero((w > 0) & (g >= 0))
                if not len(r):
                    continue
                if top.state[1] != SPLIT:
                    found, own = [int(top.state[1])], [r]
                else:
                    r = r[np.argsort(g[r], kind="stable")]
                    found, at = np.unique(g[r], return_index=True)
                    own = np.split(r, at[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[k] for k in found], pa.int32()), pa.array(found, pa.int32()), pa.array([int(ids[o[0]]) for o in own], pa.int64()),
                     *[pa.array([v[o].tobytes() for o in own], pa.binary()) for v in (y, w, x)]], ["part", "g", "at", "y", "w", "x"])

    def finish(batches):
        held: dict = {}
        for b in batches:
            for g, *blob in zip(*[b.column(i).to_pylist() for i in range(1, 6)]):
                held.setdefault(g, []).append(blob)
        for g in sorted(held):
            # in one order: the sums do not depend on the order of arrival
            y, w, x = (b"".join(v) for v in list(zip(*sorted(held.pop(g), key=lambda v: v[0])))[1:])
            y, w = np.frombuffer(y), np.frombuffer(w, np.uint8)
            tree, node = groups[g]
            found = grow(np.frombuffer(x, np.uint8).reshape(len(y), -1), y, w, node, p, tree)
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([found.tolist()], pa.list_(pa.float64()))], ["tree", "gains"])

    dealt = d.mapInArrow(deal, "part int, g int, at bigint, y binary, w binary, x binary").repartitionById(parts, "part")
    return dealt.mapInArrow(finish, "tree int, gains array<double>").collect()
