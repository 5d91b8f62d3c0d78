"""Gradient-boosted trees for binary labels, from arrays or from a table of any size, and isotonic calibration.

A table holds distinct vectors and how often each has either label. Its rows stay in their tasks: a level of a tree is one
job, which brings the driver sums by node, feature and bin. Gradients are rounded to multiples of 1 / ``UNIT`` and added as
whole numbers, so neither the order of rows nor their partitions change a tree, and arrays give the same trees as a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = float(1 << 24)
#: Vectors of a task: no more than BLOCK, and no fewer than SMALL for the sake of more tasks.
BLOCK, SMALL = 1 << 16, 1 << 12
#: Partitions whose sums the driver adds by itself.
DIRECT = 32
#: A vector of whole numbers, as rows of a table have it in ``x``; ``n0`` and ``n1`` count its labels.
VECTORS = "fold int, x binary, n0 bigint, n1 bigint"


def packed(x: list[int]) -> bytes:
    return np.array(x, "<i2").tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<i2").reshape(len(rows), -1)


def tallied(vectors: DataFrame) -> pd.DataFrame:
    """By fold, feature and value: labels (n0, n1) and distinct vectors. It grows with the values that a feature can have, not with the rows."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = unpacked(batch["x"].tolist())
                counts = batch[["fold", "n0", "n1"]].assign(vectors=1)
                for k in range(x.shape[1]):
                    yield counts.assign(feature=k, value=x[:, k]).groupby(["fold", "feature", "value"], as_index=False).sum()

    names = ["fold", "feature", "value"]
    counts = vectors.mapInPandas(tally, "fold int, n0 bigint, n1 bigint, vectors bigint, feature int, value int")
    counts = counts.groupBy(names).agg(*(F.sum(n).alias(n) for n in ("n0", "n1", "vectors")))
    return counts.toPandas().sort_values(names)


def nodes(b: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node, counted within its level, that each vector (a column of ``b``) falls into."""
    node, at = np.zeros(b.shape[1], np.int64), np.arange(b.shape[1])
    for _ in range(depth):
        node = 2 * node + 1 + (b[feature[node], at] > cut[node])
    return node - (2**depth - 1)


def level_sums(block: tuple, score: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int, width: int) -> np.ndarray:
    """Gradients and their slopes by node of a level, feature and bin, in units of 1 / UNIT."""
    b, n0, n1 = block
    p, n = 1 / (1 + np.exp(-score)), n0 + n1
    weights = n1 * UNIT - n * np.rint(p * UNIT), n * np.rint(p * (1 - p) * UNIT)
    node = nodes(b, feature, cut, level)
    out = np.empty((2, 2**level, len(b), width), np.int64)
    for f, column in enumerate(b):
        cell = node * width + column
        for k, weight in enumerate(weights):
            out[k, :, f] = np.bincount(cell, weight, 2**level * width).reshape(-1, width)
    return out


class BoostedTrees:
    """Trees of fixed depth on features cut into bins, fitted to the logistic loss by Newton steps."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.cuts: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        """Bins by feature and vector."""
        return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)]).astype(np.min_scalar_type(self.bins))

    def _cut(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The quantiles (the lower value between two) of sorted values that come ``counts`` times."""
        ends = np.cumsum(counts)
        places = np.floor(np.linspace(0, 1, self.bins + 1)[1:-1] * (ends[-1] - 1)).astype(np.int64)
        return np.unique(values[np.searchsorted(ends, places, side="right")])

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [self._cut(*np.unique(x[:, k], return_counts=True)) for k in range(x.shape[1])]
        block = self._binned(x), 1.0 - y, np.asarray(y, float)
        return self._boost(float(y.mean()), lambda *grown: level_sums(block, self._score(block[0]), *grown))

    def fit_table(self, vectors: DataFrame, tally: pd.DataFrame) -> BoostedTrees:
        """Learn from every row of ``vectors``, which ``tally`` was counted from."""
        self.cuts = [self._cut(t["value"].to_numpy(), (t["n0"] + t["n1"]).to_numpy()) for _, t in tally.groupby("feature")]
        n0, n1, count = tally.loc[tally["feature"] == 0, ["n0", "n1", "vectors"]].sum()
        tasks = int(max(-(-count // BLOCK), min(vectors.sparkSession.sparkContext.defaultParallelism, -(-count // SMALL))))
        bare = BoostedTrees(self.rounds, self.depth, self.rate, self.bins, self.ridge)
        bare.cuts = self.cuts

        def pack(rows):
            rows = list(rows)
            if rows:
                yield bare._binned(unpacked([r[0] for r in rows])), np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)

        blocks = vectors.select("x", "n0", "n1").repartition(tasks).rdd.mapPartitions(pack).persist(StorageLevel.MEMORY_AND_DISK)

        def sums(*grown) -> np.ndarray:
            bare.base, bare.trees = self.base, self.trees
            part = blocks.map(lambda block: level_sums(block, bare._score(block[0]), *grown))
            return part.treeReduce(np.add, depth=1 if tasks <= DIRECT else 2)

        try:
            return self._boost(n1 / (n0 + n1), sums)
        finally:
            blocks.unpersist()

    def _boost(self, mean: float, sums: Callable) -> BoostedTrees:
        """``sums`` gives the gradients of a level's nodes, given the features and cuts above them."""
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        self.base, self.trees = float(np.log(mean / (1 - mean))), []
        for _ in range(self.rounds):
            self.trees.append(self._grow(sums))
        return self

    def _grow(self, sums: Callable):
        inner, width = 2**self.depth - 1, self.bins + 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, self.bins, np.int64)
        for level in range(self.depth):
            first, n = 2**level - 1, 2**level
            g, h = sums(feature, cut, level, width).cumsum(axis=3) / UNIT
            whole_g, whole_h = g[..., -1:], h[..., -1:]
            gain = g**2 / (h + self.ridge) + (whole_g - g) ** 2 / (whole_h - h + self.ridge) - whole_g**2 / (whole_h + self.ridge)
            gain = gain.reshape(n, -1)
            at = gain.argmax(axis=1)
            better = gain[np.arange(n), at] > 1e-6
            feature[first : first + n][better], cut[first : first + n][better] = at[better] // width, at[better] % width
        # a leaf's sums are those of one side of the cut above it
        side = np.arange(n), feature[first:], cut[first:]
        value = np.empty(2 * n)
        value[::2] = self.rate * g[side] / (h[side] + self.ridge)
        value[1::2] = self.rate * (whole_g[:, 0, 0] - g[side]) / (whole_h[:, 0, 0] - h[side] + self.ridge)
        return feature, cut, value

    def _score(self, b: np.ndarray) -> np.ndarray:
        total = np.full(b.shape[1], self.base)
        for feature, cut, value in self.trees:
            total += value[nodes(b, feature, cut, self.depth)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return self._score(self._binned(x))


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Steps (score, probability) of the best rising fit, by pooling adjacent violators; an entry counts ``weight`` times."""
    values, where = np.unique(score, return_inverse=True)
    counts = np.bincount(where, weight).astype(float)
    total = np.bincount(where, label if weight is None else label * weight)
    pools: list[list[float]] = []
    for v, w, t in zip(values, counts, total):
        pools.append([v, w, t])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            _, w2, t2 = pools.pop()
            pools[-1][1] += w2
            pools[-1][2] += t2
    return np.array([p[0] for p in pools]), np.array([(p[2] + 0.5) / (p[1] + 1) for p in pools])
