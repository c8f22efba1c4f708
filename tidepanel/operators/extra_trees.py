"""Extremely randomised trees for two classes, grown a level at a time by one aggregation over all trees.

Every node draws some features and one random threshold each, from the box that the splits above leave
it. Tasks place their rows in the nodes of all trees and count labels on either side of every drawn
split; the counts, whose number the nodes bound, choose the splits of the level. Rows never move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 1 << 15  # rows that a task places at once
BLOCK = 4096  # open nodes whose counts travel as one row


@dataclass
class Tree:
    """Nodes in the order of their making: feature -1 is a leaf; children follow each other."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    child: list[int] = field(default_factory=lambda: [0])
    share: list[float] = field(default_factory=lambda: [0.0])


@dataclass
class ExtraTrees:
    columns: list[str]
    trees: list[Tree]
    importances: np.ndarray


def _places(trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    """The leaf of every row in every tree; values up to the threshold go to the first child."""
    return list(_each_place(_steps(trees, len(x)), x))


def _steps(trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """What places n rows: where a node's feature starts among columns laid end to end, its threshold, its child and the tree's depth. Leaves lead to themselves."""
    out = []
    for feature, threshold, child in trees:
        inner, level, depth = feature >= 0, np.zeros(1, np.int64), 0
        while len(level := level[inner[level]]):
            level = np.concatenate((child[level], child[level] + 1))
            depth += 1
        out.append((np.where(inner, feature, 0) * n, np.where(inner, threshold, np.inf), np.where(inner, child, np.arange(len(child))), depth))
    return out


def _each_place(steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], x: np.ndarray) -> Iterator[np.ndarray]:
    flat, row, n = np.ascontiguousarray(x.T).ravel(), np.arange(len(x)), len(x)
    where, value, cut, right = np.empty(n, np.int64), np.empty(n), np.empty(n), np.empty(n, bool)
    for start, threshold, child, depth in steps:
        at, to = np.zeros(n, np.int64), np.empty(n, np.int64)
        for _ in range(depth):
            np.take(start, at, out=where, mode="clip")
            where += row
            np.take(flat, where, out=value, mode="clip")
            np.take(threshold, at, out=cut, mode="clip")
            np.greater(value, cut, out=right)
            np.take(child, at, out=to, mode="clip")
            np.add(to, right, out=at)
        yield at


def _arrays(trees: list[Tree]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return [(np.array(t.feature), np.array(t.threshold), np.array(t.child)) for t in trees]


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(n)]).astype(float)


def _side_counts(train: DataFrame, width: int, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], drawn: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Numbers of rows (node, split, side, label) of the drawn splits (nodes, features, cuts) of all trees, one after the other.

    A task counts all its rows before it gives anything out, so what moves follows the drawn splits, not the rows.
    """
    firsts = np.concatenate(([0], np.cumsum([len(nodes) for nodes, _, _ in drawn])))
    slots, tries = int(firsts[-1]), max(f.shape[1] for _, f, _ in drawn)
    context = train.sparkSession.sparkContext
    shared = context.broadcast((trees, drawn))  # the open nodes of all trees

    def count(batches):
        arrays, drawn = shared.value
        total, open_ = np.zeros((slots, tries, 2, 2), np.int64), [t for t, d in enumerate(drawn) if len(d[0])]
        plans, steps = [], {}
        for t in open_:
            nodes, features, cuts = drawn[t]
            slot = np.full(len(arrays[t][0]), len(nodes))  # the last is that of rows in closed leaves
            slot[nodes] = np.arange(len(nodes))
            last = lambda a, j: np.concatenate((a[:, j], [0]))
            plans.append((slot, [(last(features, j), last(cuts, j)) for j in range(tries)], total[firsts[t] : firsts[t + 1]]))
        arrays = [arrays[t] for t in open_]
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                n = batch.num_rows
                if n not in steps:
                    steps = {n: _steps(arrays, n)}
                x, y = _matrix(batch, width), batch.column(width).to_numpy(zero_copy_only=False).astype(np.int64)
                flat, row = np.ascontiguousarray(x.T).ravel(), np.arange(n)
                for at, (slot, splits, into) in zip(_each_place(steps[n], x), plans):
                    k = slot.take(at)
                    cell = k * 4 + y
                    for j, (feature, cut) in enumerate(splits):
                        where = feature.take(k)
                        where *= n
                        where += row
                        right = flat.take(where) > cut.take(k)
                        into[:, j] += np.bincount(cell + 2 * right, minlength=len(into) * 4 + 4)[: len(into) * 4].reshape(-1, 2, 2)
        total = total.reshape(slots, -1)
        for start in range(0, slots, BLOCK):
            counts = total[start : start + BLOCK]
            if counts.any():
                yield pa.record_batch([pa.array([start]), pa.array([counts.tobytes()])], names=["start", "counts"])

    def add(table: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(chunk.as_py(), np.int64) for chunk in table["counts"])
        return pa.table({"start": table["start"][:1].combine_chunks(), "counts": [whole.tobytes()]})

    parts = train.coalesce(2 * context.defaultParallelism).mapInArrow(count, "start long, counts binary")
    sums = np.zeros((slots, tries * 4), np.int64)
    for r in parts.groupBy("start").applyInArrow(add, "start long, counts binary").toLocalIterator():
        counts = np.frombuffer(r["counts"], np.int64).reshape(-1, tries * 4)
        sums[r["start"] : r["start"] + len(counts)] = counts
    shared.destroy()
    return sums.reshape(slots, tries, 2, 2)


def _impurity(counts: np.ndarray) -> np.ndarray:
    """Rows times Gini impurity of (…, label) counts."""
    n = counts.sum(axis=-1)
    return n - (counts**2).sum(axis=-1) / np.maximum(n, 1)


def fit_extra_trees(train: DataFrame, columns: list[str], label: str, trees: int = 50, depth: int = 8, leaf: int = 50, tries: int | None = None, seed: int = 1) -> ExtraTrees:
    """Trees of at most `depth` levels whose leaves hold `leaf` rows or more, fixed by the seed however rows are dealt.

    Features must be known numbers (see apply_statistics) and the label 0 or 1; rows without a label are
    left out. tries is the number of features drawn for a node, the root of their number by default. An
    empty table or a single class gives trees of one leaf.
    """
    width = len(columns)
    rows = train.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(columns)], F.col(label).cast("int").alias("y")).where("y is not null")
    ends = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos"), *[f(f"x{k}").alias(f"{f.__name__}{k}") for k in range(width) for f in (F.min, F.max)]).first()
    tries = tries or max(1, round(width**0.5))
    rng = np.random.Generator(np.random.PCG64(seed))
    share, gained = ends["pos"] / ends["n"] if ends["n"] else 0.0, np.zeros(width)
    made = [(np.array([-1]), np.zeros(1), np.zeros(1, np.int64), np.array([share])) for _ in range(trees)]
    box = (np.array([[ends[f"min{k}"] for k in range(width)]], float), np.array([[ends[f"max{k}"] for k in range(width)]], float))
    roots = np.arange(int(ends["n"] >= 2 * leaf and 0 < ends["pos"] < ends["n"]))
    open_ = [(roots, *(b[roots] for b in box)) for _ in made]
    for _ in range(depth):
        drawn = []
        for nodes, low, high in open_:
            features, place = np.zeros((len(nodes), min(tries, width)), np.int64), np.zeros((len(nodes), min(tries, width)))
            for i in range(len(nodes)):
                features[i] = rng.permutation(width)[:tries]
                place[i] = rng.random(len(features[i]))
            row = np.arange(len(nodes))[:, None]
            drawn.append((nodes, features, low[row, features] + place * (high - low)[row, features]))
        if not any(len(nodes) for nodes, _, _ in drawn):
            break
        counted, first = _side_counts(rows, width, [m[:3] for m in made], drawn), 0
        for t, ((nodes, features, cuts), (_, low, high)) in enumerate(zip(drawn, open_)):
            counts = counted[first : first + len(nodes)]
            first += len(nodes)
            gain = _impurity(counts.sum(axis=2)) - _impurity(counts).sum(axis=2)
            gain[counts.sum(axis=3).min(axis=2) < leaf] = -1.0
            best = gain.argmax(axis=1)
            split = np.flatnonzero(gain[np.arange(len(nodes)), best] > 0)
            node, best = nodes[split], best[split]
            feature, cut, sides = features[split, best], cuts[split, best], counts[split, best]
            np.add.at(gained, feature, gain[split, best])
            n, pos = sides.sum(axis=2), sides[:, :, 1]
            f, c, child, shares = made[t]
            at = len(f) + 2 * np.arange(len(split))
            f[node], c[node], child[node] = feature, cut, at
            leaves = 2 * len(split)
            made[t] = (np.concatenate((f, np.full(leaves, -1))), np.concatenate((c, np.zeros(leaves))), np.concatenate((child, np.zeros(leaves, np.int64))), np.concatenate((shares, (pos / n).ravel())))
            low, high = np.repeat(low[split], 2, axis=0), np.repeat(high[split], 2, axis=0)
            high[2 * np.arange(len(split)), feature], low[2 * np.arange(len(split)) + 1, feature] = cut, cut
            go_on = np.flatnonzero(((n >= 2 * leaf) & (0 < pos) & (pos < n)).ravel())
            open_[t] = (len(f) + go_on, low[go_on], high[go_on])
    made = [Tree(*(a.tolist() for a in m)) for m in made]
    return ExtraTrees(columns, made, gained / gained.sum() if gained.sum() else gained)


def score_extra_trees(model: ExtraTrees, df: DataFrame, name: str = "score") -> DataFrame:
    """df with the mean share of label 1 in the leaves that a row falls into."""
    shared = df.sparkSession.sparkContext.broadcast((_arrays(model.trees), [np.array(t.share) for t in model.trees]))

    def score(*columns: pd.Series) -> pd.Series:
        arrays, shares = shared.value
        x = np.column_stack([c.to_numpy(float) for c in columns])
        total = np.zeros(len(x))
        for at, share in zip(_each_place(_steps(arrays, len(x)), x), shares):
            total += share.take(at)
        return pd.Series(total / len(shares))

    return df.withColumn(name, F.pandas_udf(score, "double")(*[F.col(c).cast("double") for c in model.columns]))
