"""Random forest regression over one-hot keys and numeric columns (M5).

The trees are those of Spark ML's settings: bootstrap by Poisson(1) weights,
all features at every split, variance gain, ``BINS`` bins of a numeric column,
at least ``MIN_LEAF`` drawn rows per leaf, depth at most ``MAX_DEPTH``. A
one-hot column is kept as the number of its slot: its only split is "the slot
is k", and a node counts only the slots that its rows have. Its work and memory
therefore follow the rows, not the number of keys.

* ``_top``: nodes of more than ``local_rows`` drawn rows are split level by
  level; tasks count rows by (node, feature, value), Spark sums the counts, and
  a group per node finds the best split. Only splits reach the driver.
* ``_subtrees``: every other node's rows are dealt to a group of their own, at
  most ``local_rows`` of them, which grows the subtree.
* Scoring sends rows to the subtrees they reach and sums over the trees.

The top nodes are the driver's (one for about ``local_rows`` rows of a tree);
the subtrees stay a table.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.session import staged

TREES, BINS, MIN_LEAF, MAX_DEPTH = 200, 32, 2, 30
LOCAL_ROWS = 4_000_000
LARGE_ROWS = 10_000  # of a node that is split by itself
GROUP_TREES = 8  # trees that a task grows from the same rows, about
SLICE_ROWS, GROUP_BYTES = 500_000, 16 << 20  # of rows and trees that a task scores
NODE = np.dtype([("feature", "<i4"), ("cut", "<i4"), ("left", "<i4"), ("depth", "<i4"), ("value", "<f8")])
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
PURE = 1e-12  # a node whose squared error is this share of the sum of squares is constant but for rounding
TIE = 1e-9  # gains closer than this share of the node's squared error are equal, in whatever order sums were taken


def draws(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often the tree's bootstrap holds each row: Poisson(1), from the row's number."""
    h = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + \
        np.uint64(((seed << 20) + tree) * 0xD1B54A32D192ED03 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    h ^= h >> np.uint64(31)
    return np.searchsorted(POISSON, (h >> np.uint64(11)) * 2.0 ** -53, side="right")


def goes_left(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, numeric: int) -> np.ndarray:
    v = x[np.arange(len(x)), feature]
    return np.where(feature < numeric, v <= cut, v == cut)


def descend(nodes: np.ndarray, at: np.ndarray, x: np.ndarray, numeric: int) -> np.ndarray:
    """The leaf that each row reaches from node ``at``."""
    at, rows = at.copy(), np.arange(len(at))
    while len(rows := rows[nodes["left"][at[rows]] >= 0]):
        n = nodes[at[rows]]
        at[rows] = n["left"] + ~goes_left(x[rows], n["feature"], n["cut"], numeric)
    return at


def _gain(w, s, whole_w, whole_s):
    """Variance gain of a part of weight ``w`` and sum ``s`` against the rest; -inf where a side is too small."""
    rest = whole_w - w
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s * s / w + (whole_s - s) ** 2 / rest - whole_s * whole_s / whole_w
    return np.where((w >= MIN_LEAF) & (rest >= MIN_LEAF), gain, -np.inf)


def best_splits(x, w, wy, node, tie, bins: list[int]):
    """(gain, feature, cut) of each node; ``tie``: gains of a node closer than
    this are equal. Keys come before numeric columns, as in the feature vector;
    the first of equal gains is taken."""
    k = len(tie)
    whole_w, whole_s = np.bincount(node, w, k), np.bincount(node, wy, k)
    gain, feature, cut = np.full(k, -np.inf), np.zeros(k, np.int32), np.zeros(k, np.int32)

    def take(of, g, f, c):
        better = g > gain[of] + tie[of]
        at = of[better]
        gain[at], feature[at], cut[at] = g[better], f, c[better]
    for f in range(len(bins), x.shape[1]):
        span = int(x[:, f].max()) + 1
        code = node * span + x[:, f]
        if k * span <= 4 * len(code):
            part_w, part_s = np.bincount(code, w, k * span), np.bincount(code, wy, k * span)
            code = np.flatnonzero(part_w)
            part_w, part_s = part_w[code], part_s[code]
        else:
            code, at = np.unique(code, return_inverse=True)
            part_w, part_s = np.bincount(at, w), np.bincount(at, wy)
        of, slot = code // span, code % span
        g = _gain(part_w, part_s, whole_w[of], whole_s[of])
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        top = np.repeat(np.maximum.reduceat(g, begin), np.diff(np.r_[begin, len(of)]))
        first = np.flatnonzero(g >= top - tie[of])
        first = first[np.r_[True, of[first][1:] != of[first][:-1]]]
        take(of[first], g[first], f, slot[first])
    for f, n in enumerate(bins):
        if n < 2:
            continue
        code = node * n + x[:, f]
        left_w = np.bincount(code, w, k * n).reshape(k, n).cumsum(1)[:, :-1]
        left_s = np.bincount(code, wy, k * n).reshape(k, n).cumsum(1)[:, :-1]
        g = _gain(left_w, left_s, whole_w[:, None], whole_s[:, None])
        c = (g >= g.max(axis=1, keepdims=True) - tie[:, None]).argmax(axis=1)
        take(np.arange(k), g[np.arange(k), c], f, c)
    return gain, feature, cut


def levels(x: np.ndarray, w: np.ndarray, y: np.ndarray, node: np.ndarray, depth: np.ndarray, bins: list[int], begin: int,
           mean: float) -> np.ndarray:
    """The nodes of the subtrees over these rows, level by level; the first are
    the roots, as many as ``depth``, their children are numbered from ``begin``
    on. ``mean``: of the labels of all rows that the tree was given."""
    k = len(depth)
    x, center, out = np.ascontiguousarray(x.T).T, np.zeros(k), []  # by column
    while k:
        level = np.zeros(k, NODE)
        level["left"], level["depth"] = -1, depth
        weight = np.bincount(node, w, k)
        for _ in range(2):  # labels less the mean of their node; once more for what rounding left
            shift = np.bincount(node, w * y, k) / weight
            y, center = y - shift[node], center + shift
        level["value"] = center
        error = np.bincount(node, w * y * y, k)
        may = (weight >= 2 * MIN_LEAF) & (error > PURE * (error + weight * (center - mean) ** 2)) & (depth < MAX_DEPTH)
        out.append(level)
        if not may.any():
            break
        keep = may[node]
        x, w, y = x.T[:, keep].T, w[keep], y[keep]
        of, node = np.flatnonzero(may), (np.cumsum(may) - 1)[node[keep]]
        gain, feature, cut = best_splits(x, w, w * y, node, TIE * error[of], bins)
        split = gain > TIE * error[of]
        number = np.cumsum(split) - 1
        last = of[split]
        level["feature"][last], level["cut"][last] = feature[split], cut[split]
        level["left"][last] = begin + 2 * number[split]
        keep = split[node]
        x, w, y, node = x.T[:, keep].T, w[keep], y[keep], node[keep]
        node = 2 * number[node] + ~goes_left(x, feature[node], cut[node], len(bins))
        k = 2 * int(split.sum())
        begin, depth, center = begin + k, np.repeat(depth[last] + 1, 2), np.repeat(center[last], 2)
    return np.concatenate(out)


class _Large:
    """A node of many rows: their numbers, and weight and sum of the label less
    ``center`` by (column, value). Rows are counted once: of the two parts of a
    split only the smaller one is counted, the larger is what it leaves."""

    def __init__(self, rows: np.ndarray, at: int, depth: int):
        self.rows, self.at, self.depth, self.parts = rows, at, depth, None

    def count(self, x, w, y, bins, center: float) -> None:
        self.center, weight = center, w[self.rows]
        wy = weight * (y[self.rows] - center)
        self.parts = []
        for f in range(x.shape[1]):
            v = x[:, f][self.rows]
            span = int(v.max()) + 1 if f >= len(bins) else bins[f]
            if f < len(bins) or span <= 4 * len(v):
                part_w, part_s = np.bincount(v, weight, span), np.bincount(v, wy, span)
                slots = np.flatnonzero(part_w) if f >= len(bins) else np.arange(span)
                self.parts.append((slots, part_w[slots], part_s[slots]))
            else:
                slots, pos = np.unique(v, return_inverse=True)
                self.parts.append((slots, np.bincount(pos, weight), np.bincount(pos, wy)))
        self.sums = np.array([weight.sum(), wy.sum(), wy @ (y[self.rows] - center)])
        self.known = self.sums

    def without(self, part: _Large, rows: np.ndarray, at: int) -> _Large:
        rest = _Large(rows, at, self.depth + 1)
        rest.center, rest.known, rest.sums, rest.parts = self.center, self.known, self.sums - part.sums, []
        for (slots, pw, ps), (less, lw, ls) in zip(self.parts, part.parts):
            pos = np.searchsorted(slots, less)
            pw[pos] -= lw
            ps[pos] -= ls
            if (pw == 0).sum() > len(pw) // 2 and len(pw) > 64:
                on = pw > 0
                slots, pw, ps = slots[on], pw[on], ps[on]
            rest.parts.append((slots, pw, ps))
        return rest

    def best(self, weight: float, total: float, tie: float, numeric: int) -> tuple[float, int, int]:
        """As ``best_splits``, of this node."""
        best = (-np.inf, 0, 0)
        for f in [*range(numeric, len(self.parts)), *range(numeric)]:
            slots, pw, ps = self.parts[f]
            if f < numeric:
                if len(slots) < 2:
                    continue
                pw, ps = np.cumsum(pw)[:-1], np.cumsum(ps)[:-1]
            g = _gain(pw, ps, weight, total)
            i = int(np.argmax(g >= g.max() - tie))
            if g[i] > best[0] + tie:
                best = (float(g[i]), f, int(slots[i]))
        return best


def grow(x: np.ndarray, w: np.ndarray, y: np.ndarray, depth: int, bins: list[int]) -> np.ndarray:
    """The nodes of the tree over the rows of a weight; the first is the root.
    Nodes of more than ``LARGE_ROWS`` rows are split one by one, the others together."""
    numeric, mean = len(bins), float(np.average(y, weights=w))
    nodes, count = np.zeros(64, NODE), 1
    open_, small = [_Large(np.flatnonzero(w).astype(np.int32), 0, depth)], []
    while open_:
        n = open_.pop()
        if len(n.rows) <= LARGE_ROWS:
            small.append(n)
            continue
        if count + 2 > len(nodes):
            nodes = np.concatenate([nodes, np.zeros(len(nodes), NODE)])
        if n.parts is None:
            n.count(x, w, y, bins, mean)
        for _ in range(2):
            weight, total, square = n.sums
            error = square - total * total / weight
            if error >= n.known[2] / 1000:  # else count anew: sums left by larger ones keep their rounding
                break
            n.count(x, w, y, bins, n.center + total / weight)
        value = n.center + total / weight
        nodes[n.at] = (0, 0, -1, n.depth, value)
        if weight < 2 * MIN_LEAF or n.depth >= MAX_DEPTH or not error > PURE * (error + weight * (value - mean) ** 2):
            continue
        gain, f, cut = n.best(weight, total, TIE * error, numeric)
        if not gain > TIE * error:
            continue
        v = x[:, f][n.rows]
        left = v <= cut if f < numeric else v == cut
        parts = [_Large(n.rows[left], count, n.depth + 1), _Large(n.rows[~left], count + 1, n.depth + 1)]
        nodes["feature"][n.at], nodes["cut"][n.at], nodes["left"][n.at] = f, cut, count
        count += 2
        less = int(len(parts[0].rows) > len(parts[1].rows))
        if len(parts[1 - less].rows) > LARGE_ROWS:
            parts[less].count(x, w, y, bins, n.center)
            parts[1 - less] = n.without(parts[less], parts[1 - less].rows, parts[1 - less].at)
        open_ += parts
        n.parts = None
    nodes = nodes[:count]
    if small:
        rows = np.concatenate([n.rows for n in small])
        of = np.repeat(np.arange(len(small)), [len(n.rows) for n in small])
        below = levels(np.stack([c[rows] for c in x.T]).T, w[rows], y[rows], of, np.array([n.depth for n in small]), bins, count, mean)
        nodes[[n.at for n in small]] = below[:len(small)]
        nodes = np.concatenate([nodes, below[len(small):]])
    return nodes


def _cuts(train: DataFrame, numeric: str, width: int) -> list[list[float]]:
    """Thresholds of each numeric column: between all its values where they are
    few, else its quantiles."""
    cols = [F.col(numeric)[i] for i in range(width)]
    probs = [k / BINS for k in range(1, BINS)]
    quantiles = train.agg(*[F.percentile_approx(c, probs, 10_000).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    out = []
    for c, q in zip(cols, quantiles):
        values = sorted(r[0] for r in train.select(c.alias("v")).distinct().limit(BINS + 1).collect())
        few = len(values) <= BINS
        out.append([(a + b) / 2 for a, b in zip(values, values[1:])] if few else sorted(set(q)))
    return out


def _matrix(batch: pa.RecordBatch, cuts: list[list[float]], keys: list[str]) -> np.ndarray:
    """Bins of the numeric columns, then slots of the keys."""
    v = np.array(batch.column("__x").to_pylist(), dtype=float).reshape(batch.num_rows, len(cuts))
    return np.stack([*(np.searchsorted(c, v[:, i], side="left") for i, c in enumerate(cuts)),
                     *(batch.column(c).to_numpy(zero_copy_only=False) for c in keys)], axis=1).astype(np.int32)


def _packed(batch: pa.RecordBatch, cuts: list[list[float]], keys: list[str], *more: np.ndarray) -> bytes:
    """A batch's row numbers (as steps), ``more`` columns of doubles, bins and slots."""
    x = _matrix(batch, cuts, keys).T
    row = np.diff(batch.column("__row").to_numpy(), prepend=0)
    return b"".join([row.astype("<i8").tobytes(), *(np.asarray(m, "<f8").tobytes() for m in more),
                     x[:len(cuts)].astype("u1").tobytes(), x[len(cuts):].astype("<i4").tobytes()])


def _unpacked(packed: list[bytes], numeric: int, keys: int, more: int = 0) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Row numbers, doubles and the matrix (by column) of batches."""
    size = 8 + 8 * more + numeric + 4 * keys
    counts = [len(p) // size for p in packed]
    n = sum(counts)
    row, doubles, x = np.zeros(n, np.int64), [np.zeros(n) for _ in range(more)], np.zeros((numeric + keys, n), np.int32)
    at = 0
    for p, m in zip(packed, counts):
        to = slice(at, at + m)
        row[to] = np.cumsum(np.frombuffer(p, "<i8", m))
        for i, d in enumerate(doubles):
            d[to] = np.frombuffer(p, "<f8", m, 8 * m * (1 + i))
        begin = 8 * m * (1 + more)
        x[:numeric, to] = np.frombuffer(p, "u1", numeric * m, begin).reshape(numeric, m)
        x[numeric:, to] = np.frombuffer(p, "<i4", keys * m, begin + numeric * m).reshape(keys, m)
        at += m
    return row, doubles, x.T


class Forest:
    """``top``: the nodes above the subtrees, tree t starting at node t; a leaf
    of it whose ``value`` is NaN goes on in the row of ``subtrees`` (node, tree,
    nodes) of its number."""

    def __init__(self, prep: PipelineModel, numeric: str, keys: list[str], cuts, top: np.ndarray, subtrees: DataFrame,
                 trees: int):
        self.prep, self.numeric, self.keys, self.cuts, self.top = prep, numeric, keys, cuts, top
        self.subtrees, self.trees = subtrees, trees

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean of its trees as ``prediction``."""
        cuts, keys, top, trees = self.cuts, self.keys, self.top, self.trees
        rows = staged(_prepared(self.prep, df, self.numeric, keys, df.columns), "forest-rows")
        n, size = rows.count(), max(1, self.subtrees.agg(F.sum(F.length("nodes"))).first()[0] or 0)
        # a task judges a slice of the rows by the trees of a group, both of bounded size; rows are sent once a group
        # and trees once a slice, so there are few slices where the trees are large
        per = max(1, min(trees, trees * GROUP_BYTES // size))
        groups = -(-trees // per)
        slices = max(1, -(-n // SLICE_ROWS), min(-(-n // (SLICE_ROWS // 20)), 4 * GROUP_BYTES // size))

        def dealt(batches):
            for batch in batches:
                if batch.num_rows:
                    part = int(batch.column("__row")[0].as_py()) * 2654435761 % (1 << 32) % slices
                    yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([_packed(batch, cuts, keys)], pa.binary())], names=["part", "rows"])

        def judged(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left):
                return pd.DataFrame({"__r": np.zeros(0, np.int64), "__sum": np.zeros(0)})
            row, _, x = _unpacked(list(left["rows"]), len(cuts), len(keys))
            below, total, group = dict(zip(right["node"], right["nodes"])), np.zeros(len(row)), int(left["grp"].iloc[0])
            for tree in range(group * per, min(trees, group * per + per)):
                at = descend(top, np.full(len(row), tree), x, len(cuts))
                value = top["value"][at]
                for node in np.unique(at[np.isnan(value)]):
                    on = np.flatnonzero(at == node)
                    nodes = np.frombuffer(below[node], NODE)
                    value[on] = nodes["value"][descend(nodes, np.zeros(len(on), np.int64), x[on], len(cuts))]
                total += value
            return pd.DataFrame({"__r": row, "__sum": total})
        wide = groups * slices
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        sent = rows.select("__row", "__x", *keys).mapInArrow(dealt, "part long, rows binary").withColumn("grp", every(groups))
        told = self.subtrees.withColumn("grp", F.floor(F.col("tree") / per).cast("long")).withColumn("part", every(slices))
        sums = (sent.repartition(wide, "grp", "part").groupBy("grp", "part")
                .cogroup(told.repartition(wide, "grp", "part").groupBy("grp", "part"))
                .applyInPandas(judged, "__r long, __sum double")
                .groupBy("__r").agg((F.sum("__sum") / trees).alias("prediction")))
        return rows.join(sums, F.col("__row") == F.col("__r")).select(*df.columns, "prediction")

    def save(self, path: str) -> None:
        spark = self.subtrees.sparkSession
        self.prep.write().overwrite().save(f"{path}/prep")
        self.subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")
        said = {"numeric": self.numeric, "keys": self.keys, "cuts": self.cuts, "trees": self.trees}
        spark.createDataFrame([(json.dumps(said), bytearray(self.top.tobytes()))], "said string, top binary") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/top")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        r = spark.read.parquet(f"{path}/top").first()
        return Forest(PipelineModel.load(f"{path}/prep"), top=np.frombuffer(bytes(r.top), NODE),
                      subtrees=spark.read.parquet(f"{path}/subtrees"), **json.loads(r.said))


def _prepared(prep: PipelineModel, df: DataFrame, numeric: str, keys: list[str], columns: list[str]) -> DataFrame:
    return prep.transform(df).select(*columns, *[F.col(c).cast("int").alias(c) for c in keys],
                                     vector_to_array(numeric).alias("__x"), F.monotonically_increasing_id().alias("__row"))


def _top(rows: DataFrame, cuts, keys: list[str], trees: int, seed: int, local_rows: int) -> np.ndarray:
    """The nodes above the subtrees."""
    numeric, bins = len(cuts), [len(c) + 1 for c in cuts]
    top = np.zeros(trees, NODE)
    top["left"], top["value"] = -1, np.nan
    n = rows.count()
    open_ = np.arange(trees) if n * (1 - math.exp(-1)) > local_rows else np.arange(0)
    while len(open_):
        opened = np.zeros(len(top), bool)
        opened[open_] = True

        def counted(batches, top=top, opened=opened):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, y, row = _matrix(batch, cuts, keys), batch.column("__y").to_numpy(), batch.column("__row").to_numpy()
                for tree in range(trees):
                    w = draws(row, tree, seed)
                    at = descend(top, np.full(len(x), tree), x, numeric)
                    on = np.flatnonzero((w > 0) & opened[at])
                    for f in range(x.shape[1]) if len(on) else ():
                        code, pos = np.unique(at[on].astype(np.int64) << 32 | x[on, f], return_inverse=True)
                        wy = w[on] * y[on]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(code >> 32), pa.array(np.full(len(code), f, np.int32)), pa.array((code & 0xFFFFFFFF).astype(np.int32)),
                             pa.array(np.bincount(pos)), pa.array(np.bincount(pos, w[on]).astype(np.int64)),
                             pa.array(np.bincount(pos, wy)), pa.array(np.bincount(pos, wy * y[on]))],
                            names=["node", "feature", "cut", "n", "w", "s", "q"])

        def split(p: pd.DataFrame) -> pd.DataFrame:
            p = p.sort_values(["feature", "cut"])
            one = p[p.feature == 0]
            n, w, s, q = (one[c].sum() for c in ("n", "w", "s", "q"))
            mean = s / w
            tie = TIE * max(q - s * mean, 0.0)
            best = (0.0, -1, 0, 0)
            for f in [*range(numeric, numeric + len(keys)), *range(numeric)]:
                part = p[p.feature == f]
                here = [(part[c] if c != "s" else part.s - part.w * mean).to_numpy() for c in ("n", "w", "s")]
                if f < numeric:
                    here = [np.cumsum(c) for c in here]
                g = _gain(here[1], here[2], w, 0.0)
                i = int(np.argmax(g >= g.max() - tie))
                if g[i] > best[0] + tie:
                    best = (g[i], f, int(part.cut.iloc[i]), int(here[0][i]))
            return pd.DataFrame([(p.node.iloc[0], best[1], best[2], best[3], n - best[3], mean)],
                                columns=["node", "feature", "cut", "n_left", "n_right", "value"])
        counts = (rows.mapInArrow(counted, "node long, feature int, cut int, n long, w long, s double, q double")
                  .groupBy("node", "feature", "cut").agg(*[F.sum(c).alias(c) for c in ("n", "w", "s", "q")]))
        found = (counts.groupBy("node")
                 .applyInPandas(split, "node long, feature int, cut int, n_left long, n_right long, value double")
                 .orderBy("node").collect())  # a row per open node
        top, more = top.copy(), []
        for r in found:
            if r.feature < 0 or top["depth"][r.node] >= MAX_DEPTH:
                top["value"][r.node] = r.value
                continue
            left = len(top)
            top["feature"][r.node], top["cut"][r.node], top["left"][r.node] = r.feature, r.cut, left
            top = np.concatenate([top, np.array([(0, 0, -1, top["depth"][r.node] + 1, np.nan)] * 2, NODE)])
            more += [left + i for i, m in enumerate((r.n_left, r.n_right)) if m > local_rows]
        open_ = np.array(more, int)
    return top


def _spread(spark: SparkSession, n: int) -> list[int]:
    """Numbers of which ``repartition(n, column)`` deals one to each partition."""
    found = spark.range(40 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()
    return sorted(r.id for r in found) if len(found) == n else list(range(n))


def _whole_trees(rows: DataFrame, cuts, keys: list[str], trees: int, seed: int) -> DataFrame:
    """(node, tree, nodes) where every tree is a group's: rows are sent once to
    a group of trees, not with the weights of every tree."""
    numeric, bins = len(cuts), [len(c) + 1 for c in cuts]
    tasks = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    groups = min(trees, tasks * max(1, round(trees / GROUP_TREES / tasks)))  # so that no task is left to the end
    numbers = _spread(rows.sparkSession, groups)

    def dealt(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([_packed(batch, cuts, keys, batch.column("__y").to_numpy())], pa.binary())], names=["rows"])

    def grown(p: pd.DataFrame) -> pd.DataFrame:
        row, (y,), x = _unpacked(list(p["rows"]), numeric, len(keys), 1)
        group = numbers.index(int(p["grp"].iloc[0]))
        order = np.argsort(row)  # sums are taken in one order
        row, y, x = row[order], y[order], np.stack([c[order] for c in x.T]).T
        out = []
        for tree in range(group * trees // groups, (group + 1) * trees // groups):
            w = draws(row, tree, seed)
            if not w.any():  # a handful of rows, none of them drawn
                w = np.ones_like(w)
            out.append((tree, tree, grow(x, w, y, 0, bins).tobytes()))
        return pd.DataFrame(out, columns=["node", "tree", "nodes"])
    sent = rows.mapInArrow(dealt, "rows binary").withColumn("grp", F.explode(F.array([F.lit(n).cast("long") for n in numbers])))
    return staged(sent.repartition(groups, "grp").groupBy("grp").applyInPandas(grown, "node long, tree long, nodes binary"), "forest")


def _subtrees(rows: DataFrame, cuts, keys: list[str], top: np.ndarray, trees: int, seed: int) -> DataFrame:
    """(node, tree, nodes): the subtree of each leaf of ``top`` that goes on."""
    if len(top) == trees:
        return _whole_trees(rows, cuts, keys, trees, seed)
    numeric, bins, width = len(cuts), [len(c) + 1 for c in cuts], len(cuts) + len(keys)
    row = np.dtype([("x", "<i4", (width,)), ("w", "<i4"), ("y", "<f8")])

    def dealt(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            r, number = np.zeros(batch.num_rows, row), batch.column("__row").to_numpy()
            r["x"], r["y"] = _matrix(batch, cuts, keys), batch.column("__y").to_numpy()
            for tree in range(trees):
                r["w"] = draws(number, tree, seed)
                at = descend(top, np.full(len(r), tree), r["x"], numeric)
                on = (r["w"] > 0) & np.isnan(top["value"][at])
                nodes = np.unique(at[on])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), pa.array(np.full(len(nodes), tree)), pa.array([r[on & (at == n)].tobytes() for n in nodes], pa.binary())],
                    names=["node", "tree", "rows"])

    def grown(p: pd.DataFrame) -> pd.DataFrame:
        r, node = np.frombuffer(b"".join(p["rows"]), row), int(p["node"].iloc[0])
        x = np.ascontiguousarray(r["x"].T).T
        nodes = grow(x, r["w"].astype(np.int64), r["y"], int(top["depth"][node]), bins)
        return pd.DataFrame({"node": [node], "tree": [int(p["tree"].iloc[0])], "nodes": [nodes.tobytes()]})
    return staged(rows.mapInArrow(dealt, "node long, tree long, rows binary").repartition(len(top), "node")
                  .groupBy("node").applyInPandas(grown, "node long, tree long, nodes binary"), "forest")


def fit(train: DataFrame, prep: PipelineModel, numeric: str, keys: list[str], label: str, seed: int = 42,
        trees: int = TREES, local_rows: int = LOCAL_ROWS) -> Forest:
    """``prep`` gives the vector ``numeric`` and the slot numbers ``keys``."""
    rows = staged(_prepared(prep, train, numeric, keys, [F.col(label).cast("double").alias("__y")]), "forest-train")
    cuts = _cuts(rows, "__x", len(rows.select("__x").first()[0]))
    top = _top(rows, cuts, keys, trees, seed, local_rows)
    return Forest(prep, numeric, keys, cuts, top, _subtrees(rows, cuts, keys, top, trees, seed), trees)
