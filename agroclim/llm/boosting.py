"""Gradient-boosted trees, applied as a Spark expression.

``train`` fits rows in numpy. ``train_profiles`` fits a table of any size: values are put
into fixed bins, rows alike in all bins are counted together (a profile), and for each level
of a tree Spark adds up the gradients of all profiles by node, feature and bin. Gradients are
whole numbers of 2**-30, so that neither order nor partitioning changes a sum. No Python
runs on its rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES, DEPTH, RATE, LEAF, BINS = 30, 3, 0.3, 10, 32

# Upper ends of the bins of counts (single, then four to a doubling) and of shares.
COUNT_CUTS = np.concatenate([np.arange(32.0), np.round(32 * 2 ** (np.arange(45) / 4))])
SHARE_CUTS = np.arange(64) / 64
_CELLS = 128  # more than the bins of a feature
_UNIT = 1 << 30
_STEPS = 512  # steps of the threshold in a unit of log-odds


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int):
    """A tree as nested (feature, threshold, below-or-equal, above), or a leaf's value."""
    total_g, total_h = g[rows].sum(), h[rows].sum()
    value = float(RATE * total_g / (total_h + 1.0))
    if depth == 0 or len(rows) < 2 * LEAF:
        return value
    best = (1e-6, None, None)
    for k in range(x.shape[1]):
        column = x[rows, k]
        cuts = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
        at = np.searchsorted(cuts, column, side="left")
        sums_g, sums_h, sizes = (np.cumsum(np.bincount(at, w, len(cuts) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
        gain = sums_g**2 / (sums_h + 1) + (total_g - sums_g) ** 2 / (total_h - sums_h + 1) - total_g**2 / (total_h + 1)
        gain[(sizes < LEAF) | (len(rows) - sizes < LEAF)] = 0
        if len(gain) and gain.max() > best[0]:
            best = (gain.max(), k, float(cuts[gain.argmax()]))
    _, k, cut = best
    if k is None:
        return value
    low = x[rows, k] <= cut
    return k, cut, _grow(x, g, h, rows[low], depth - 1), _grow(x, g, h, rows[~low], depth - 1)


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    k, cut, low, high = tree
    return np.where(x[:, k] <= cut, _apply(low, x), _apply(high, x))


def train(x: np.ndarray, y: np.ndarray) -> tuple[float, list]:
    """(base log-odds, trees) of the logistic loss; y is 0 or 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    score, trees = np.full(len(y), base), []
    for _ in range(TREES if len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        trees.append(_grow(x, y - p, p * (1 - p), np.arange(len(y)), DEPTH))
        score += _apply(trees[-1], x)
    return base, trees


def scores(model: tuple[float, list], x: np.ndarray) -> np.ndarray:
    return model[0] + sum((_apply(t, x) for t in model[1]), np.zeros(len(x)))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bins of values: a value up to ``cuts[k][b]`` is in bin b or below."""
    return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1).astype(np.uint8)


def profile_counts(x: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """Rows of bins as the column key (one byte a feature) beside ``columns``."""
    flat = np.ascontiguousarray(x).tobytes()
    key = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.py_buffer(flat)])
    return pa.table({"key": key} | {c: pa.array(v) for c, v in columns.items()})


def bin_column(value: Column, cuts: np.ndarray) -> Column:
    """The bin of one value, as of ``binned``."""
    return F.size(F.filter(F.lit(cuts.tolist()), lambda cut: cut < value))


def key_column(bins: Column) -> Column:
    """The key of a profile from its bins (array<int>)."""
    return F.array_join(F.transform(bins, lambda b: F.chr(b)), "").cast("binary")


def _bins(features: int) -> Column:
    """The bins (array<int>) of the column key."""
    signs = F.decode("key", "ISO-8859-1")
    return F.transform(F.sequence(F.lit(1), F.lit(features)), lambda k: F.ascii(F.substring(signs, k, F.lit(1))))


def _scored(model: tuple[float, list], profiles: DataFrame, features: int) -> DataFrame:
    """Profiles as x (bins), positive, n and their log-odds."""
    rows = profiles.select(_bins(features).alias("x"), "positive", "n")
    return rows.withColumn("score", score_column(model, [F.get("x", F.lit(k)) for k in range(features)]))


def _place(splits: dict[int, tuple[int, int]], nodes: list[int], node: int = 0) -> Column:
    """Which of ``nodes`` a row comes to, -1 if none; those below node i are 2 i + 1 and 2 i + 2."""
    if node not in splits:
        return F.lit(nodes.index(node) if node in nodes else -1)
    k, b = splits[node]
    return F.when(F.get("x", F.lit(k)) <= b, _place(splits, nodes, 2 * node + 1)).otherwise(_place(splits, nodes, 2 * node + 2))


def _sums(model: tuple[float, list], splits: dict[int, tuple[int, int]], nodes: list[int], profiles: DataFrame, features: int) -> DataFrame:
    """Sums of gradient, curvature and rows by node, feature and bin."""
    rows = _scored(model, profiles, features).withColumn("place", _place(splits, nodes)).filter("place >= 0")
    rows = rows.withColumn("p", 1 / (1 + F.exp(-F.col("score"))))
    g, h = F.col("positive") - F.col("n") * F.col("p"), F.col("n") * F.col("p") * (1 - F.col("p"))
    rows = rows.select("x", "place", "n", *[F.rint(c * _UNIT).cast("long").alias(name) for name, c in (("g", g), ("h", h))])
    cells = rows.select("place", "g", "h", "n", F.posexplode("x").alias("k", "bin"))
    cell = (F.col("place") * features + F.col("k")) * _CELLS + F.col("bin")
    return cells.groupBy(cell.alias("cell")).agg(F.sum("g"), F.sum("h"), F.sum("n"))


def train_profiles(profiles: DataFrame, cuts: list[np.ndarray]) -> tuple[float, list]:
    """(base log-odds, trees) as of ``train``, of all rows of a stored table of profiles.

    ``profiles`` has key (a byte a feature, its bin), positive and n (rows with label 1, all
    rows). The thresholds of the trees returned are bins; ``unbinned`` gives values.
    """
    whole = profiles.agg(F.coalesce(F.sum("positive"), F.lit(0)).alias("positive"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    share = (whole["positive"] + 1) / (whole["n"] + 2)
    base, trees, features = float(np.log(share / (1 - share))), [], len(cuts)
    for _ in range(TREES if whole["n"] else 0):
        splits, values, nodes = {}, {0: 0.0}, [0]
        for depth in range(DEPTH):
            if not nodes:
                break
            cells = _sums((base, trees), splits, nodes, profiles, features).toArrow()  # at most nodes x features x bins
            total = np.zeros((3, len(nodes) * features * _CELLS))
            total[:, cells.column(0).to_numpy()] = [c.to_numpy() for c in cells.columns[1:]]
            total[:2] /= _UNIT
            opened = []
            for node, (g, h, n) in zip(nodes, total.reshape(3, len(nodes), features, _CELLS).transpose(1, 0, 2, 3), strict=True):
                all_g, all_h, all_n = g[0].sum(), h[0].sum(), n[0].sum()
                values[node] = float(RATE * all_g / (all_h + 1.0))
                low_g, low_h, low_n = (np.cumsum(x, axis=1) for x in (g, h, n))
                gain = low_g**2 / (low_h + 1) + (all_g - low_g) ** 2 / (all_h - low_h + 1) - all_g**2 / (all_h + 1)
                gain[(low_n < LEAF) | (all_n - low_n < LEAF)] = 0
                k, b = np.unravel_index(gain.argmax(), gain.shape)
                if all_n < 2 * LEAF or gain[k, b] <= 1e-6:
                    continue
                splits[node] = (int(k), int(b))
                for child, (own_g, own_h) in ((2 * node + 1, (low_g[k, b], low_h[k, b])), (2 * node + 2, (all_g - low_g[k, b], all_h - low_h[k, b]))):
                    values[child] = float(RATE * own_g / (own_h + 1.0))
                    opened.append(child)
            nodes = opened
        trees.append(_nested(splits, values, 0))
    return base, trees


def _nested(splits: dict[int, tuple[int, int]], values: dict[int, float], node: int):
    if node not in splits:
        return values[node]
    return *splits[node], _nested(splits, values, 2 * node + 1), _nested(splits, values, 2 * node + 2)


def unbinned(model: tuple[float, list], cuts: list[np.ndarray]) -> tuple[float, list]:
    """A model over bins as one over values."""
    def build(tree):
        if not isinstance(tree, tuple):
            return tree
        k, b, low, high = tree
        return k, float(cuts[k][b]), build(low), build(high)

    return model[0], [build(t) for t in model[1]]


def precise_threshold(model: tuple[float, list], profiles: DataFrame, features: int, precision: float) -> float:
    """The least log-odds (in steps of 1/512) from which on at least ``precision`` of all rows have label 1; infinity if none."""
    step = F.floor(F.col("score") * _STEPS).cast("int")
    steps = _scored(model, profiles, features).groupBy(step.alias("step")).agg(F.sum("positive"), F.sum("n"))
    step, positive, n = (c.to_numpy() for c in steps.toArrow().columns)  # one row a step of the log-odds
    order = np.argsort(-step)
    precise = np.flatnonzero(np.cumsum(positive[order]) >= precision * np.cumsum(n[order]))
    return float(step[order][precise[-1]] / _STEPS) if len(precise) else float("inf")


def score_column(model: tuple[float, list], features: list[Column]) -> Column:
    """The model's log-odds as one SQL expression over the features."""
    def build(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(tree)
        k, cut, low, high = tree
        return F.when(features[k] <= F.lit(cut), build(low)).otherwise(build(high))

    total = F.lit(model[0])
    for tree in model[1]:
        total = total + build(tree)
    return total
