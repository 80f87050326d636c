"""Boosted trees from histograms: monotone bounds, L1/L2 penalties, least gain, leaf limits, and a loss per round."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sumac.session import freeze

#: Rows of one packed block, and trees after which margins are written anew instead of being computed from all trees.
BLOCK, REWRITE = 8192, 16
#: Inner nodes of a tree that is evaluated node by node instead of row by row.
SMALL = 64
BLOCKS = "bins binary, label binary, weight binary, margin binary"


@dataclass
class Tree:
    """A binary tree in arrays; node i has children 2i + 1 (value at most the threshold) and 2i + 2. Inner nodes have a feature, others -1."""

    feature: list[int]
    bin: list[int]
    threshold: list[float]
    missing_left: list[bool]
    value: list[float]

    @classmethod
    def root(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls([-1] * n, [0] * n, [0.0] * n, [False] * n, [0.0] * n)

    def leaf_of(self, cells: np.ndarray, at: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The leaf of each row; ``cells`` holds bins or raw values, ``at`` what to compare with in each node."""
        feature, left = np.array(self.feature), np.array(self.missing_left)
        node, rows = np.zeros(len(cells), np.int64), np.arange(len(cells))
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            f = np.maximum(f, 0)
            down = np.where(missing[rows, f], left[node], cells[rows, f] <= at[node])
            node = np.where(inner, 2 * node + np.where(down, 1, 2), node)

    def chosen(self, columns: Sequence[np.ndarray], at: Sequence[float], missing: Sequence[np.ndarray | None], of: Sequence) -> np.ndarray:
        """``of[leaf]`` of each row, from whole columns (``missing``: None where nothing is).

        Every node of a small tree is compared for all rows at once, which is many times quicker than following each row down; large trees are followed.
        """
        if sum(f >= 0 for f in self.feature) > SMALL:
            gone = [np.zeros(len(c), bool) if m is None else m for c, m in zip(columns, missing)]
            return np.asarray(of)[self.leaf_of(np.stack(columns, axis=1), np.asarray(at), np.stack(gone, axis=1))]

        def below(node: int):
            f = self.feature[node]
            if f < 0:
                return of[node]
            down = columns[f] <= at[node]
            if missing[f] is not None:
                down = down | missing[f] if self.missing_left[node] else down & ~missing[f]
            return np.where(down, below(2 * node + 1), below(2 * node + 2))

        return np.broadcast_to(below(0), len(columns[0]))


@dataclass
class BoostedTrees:
    """A fitted model: a prediction is ``base`` plus the trees' values, passed through the logistic function for that loss."""

    columns: list[str]
    loss: str
    base: float
    trees: list[Tree] = field(default_factory=list)
    history: list[dict] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, columns = np.full(len(x), self.base), [np.ascontiguousarray(c) for c in x.T]
        missing = [_some(np.isnan(c)) for c in columns]
        for tree in self.trees:
            out += tree.chosen(columns, tree.threshold, missing, tree.value)
        return out

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Adds the prediction (for the logistic loss the probability of 1). A missing value follows the side learnt for it."""

        @F.pandas_udf("double")
        def predict(rows: pd.DataFrame) -> pd.Series:
            margin = self.margins(rows.to_numpy(dtype=float))
            return pd.Series(1 / (1 + np.exp(-margin)) if self.loss == "logistic" else margin)

        return df.withColumn(output, predict(F.struct(*[F.col(c).cast("double").alias(c) for c in self.columns])))

    def importances(self) -> dict[str, int]:
        used = [f for t in self.trees for f in t.feature if f >= 0]
        return {c: used.count(k) for k, c in enumerate(self.columns)}

    def save(self, spark: SparkSession, path: str) -> None:
        """Writes the model as one row of JSON."""
        spark.createDataFrame([(json.dumps(asdict(self)),)], "model string").coalesce(1).write.text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        found = json.loads(spark.read.text(path).first()[0])
        return cls(**{**found, "trees": [Tree(**t) for t in found["trees"]]})


def _gradients(loss: str, margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """First and second derivatives of the loss, and its sum."""
    if loss == "logistic":
        p = 1 / (1 + np.exp(-margin))
        return weight * (p - label), weight * p * (1 - p), float((weight * (np.logaddexp(0, margin) - label * margin)).sum())
    return weight * (margin - label), weight, float((weight * (margin - label) ** 2).sum())


@dataclass
class HistogramBoosting:
    """Gradient boosting on binned columns.

    Rows are packed once into blocks of bin numbers. Each level of a tree is one job: a task sums gradients per (node, column, bin) over its
    blocks, a grouped sum adds the tasks up, and the driver sees nodes x columns x bins sums, whatever the rows. Splits are the best by penalised gain; with
    ``monotone`` {column: -1 or 1} a split must order its children so, and their values stay on their side of the middle in all later
    splits, so that the prediction never rises (falls) with that column. ``leaves`` keeps the splits of largest gain first.
    With validation rows a loss per round is recorded, and training ends once ``patience`` rounds bring no better one; the best round's trees stay.

    Missing values form a bin of their own, which goes to the better side. Rows with a missing label or weight are left out.
    """

    loss: str = "squared"
    trees: int = 100
    depth: int = 6
    rate: float = 0.1
    bins: int = 64
    monotone: Mapping[str, int] = field(default_factory=dict)
    l1: float = 0.0
    l2: float = 1.0
    least_gain: float = 0.0
    least_weight: float = 1.0
    leaves: int | None = None
    patience: int | None = None

    def fit(self, df: DataFrame, columns: Sequence[str], label: str, weight: str | None = None, validation: DataFrame | None = None) -> BoostedTrees:
        columns = list(columns)
        edges = [self._edges(df, c) for c in columns]
        self._width, self._missing = len(columns), np.array([len(e) for e in edges])
        blocks = self._packed(df, columns, edges, label, weight, 0.0)
        total, sums = blocks_total(blocks)
        if not total:
            raise ValueError("no rows to learn from")
        mean = sums / total
        base = float(np.log(min(max(mean, 1e-6), 1 - 1e-6) / (1 - min(max(mean, 1e-6), 1 - 1e-6)))) if self.loss == "logistic" else mean
        model = BoostedTrees(columns, self.loss, base)
        checked = None if validation is None else self._packed(validation, columns, edges, label, weight, base)
        blocks = self._rewritten(blocks, [], base)
        fresh: list[Tree] = []  # trees that the written margins lack
        best = (np.inf, 0)
        for n in range(1, self.trees + 1):
            tree, loss = self._grow(blocks, fresh, columns, edges)
            model.trees.append(tree)
            fresh.append(tree)
            model.history.append({"round": n, "train_before": loss / total})
            if checked is not None:
                held = self._loss(checked, fresh)
                model.history[-1]["validation"] = held
                best = min(best, (held, n))
                if self.patience and n - best[1] >= self.patience:
                    break
            if len(fresh) == REWRITE:
                blocks = self._rewritten(blocks, fresh, 0.0)
                checked = checked and self._rewritten(checked, fresh, 0.0)
                fresh = []
        if checked is not None and self.patience:
            model.trees = model.trees[: best[1]]
        return model

    def _edges(self, df: DataFrame, column: str) -> np.ndarray:
        """Upper bounds of a column's bins: its values if they are few, else quantiles."""
        value = df.select(F.col(column).cast("double").alias("v")).filter("v is not null and not isnan(v)")
        few = value.distinct().limit(self.bins + 1).collect()
        if len(few) > self.bins:
            shares = [i / self.bins for i in range(1, self.bins + 1)]
            few = [(v,) for v in value.agg(F.percentile_approx("v", shares, 10_000)).first()[0]]
        return np.unique([v for (v,) in few])

    def _packed(self, df: DataFrame, columns: list[str], edges: list[np.ndarray], label: str, weight: str | None, base: float) -> DataFrame:
        rows = df.select(
            *[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(columns)],
            F.col(label).cast("double").alias("label"),
            (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        ).dropna(subset=["label", "weight"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = [batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(columns))]
                # A value above the last edge (possible in validation rows) shares its bin; a missing one has the bin after it.
                bins = [np.where(np.isnan(v), len(e), np.minimum(np.searchsorted(e, v), max(len(e) - 1, 0))) for v, e in zip(x, edges)]
                cells = np.stack(bins, axis=1).astype(np.uint8 if self.bins < 255 else np.uint16)
                for at in range(0, batch.num_rows, BLOCK):
                    part = slice(at, at + BLOCK)
                    y, w = (batch.column(c).to_numpy(zero_copy_only=False)[part] for c in ("label", "weight"))
                    yield _block(cells[part], y, w, np.full(len(y), base))

        return freeze(rows.mapInArrow(pack, BLOCKS), "blocks")

    def _unpack(self, batches: Iterator[pa.RecordBatch], width: int, fresh: list[Tree], missing: np.ndarray):
        """(bins by column, missing by column, label, weight, margin with ``fresh`` trees added) of each block."""
        for batch in batches:
            for row in batch.to_pylist():
                cells = np.frombuffer(row["bins"], np.uint8 if self.bins < 255 else np.uint16).reshape(-1, width)
                y, w, margin = (np.frombuffer(row[c], "<f8") for c in ("label", "weight", "margin"))
                columns = [np.ascontiguousarray(c) for c in cells.T]
                gone = [_some(c == m) for c, m in zip(columns, missing)]
                for tree in fresh:
                    margin = margin + tree.chosen(columns, tree.bin, gone, tree.value)
                yield columns, gone, y, w, margin

    def _rewritten(self, blocks: DataFrame, fresh: list[Tree], more: float) -> DataFrame:
        width, missing = self._width, self._missing

        def add(batches):
            for columns, _, y, w, margin in self._unpack(batches, width, fresh, missing):
                yield _block(np.stack(columns, axis=1), y, w, margin + more)

        return freeze(blocks.mapInArrow(add, BLOCKS), "blocks")

    def _loss(self, blocks: DataFrame, fresh: list[Tree]) -> float:
        width, missing, loss = self._width, self._missing, self.loss

        def run(batches):
            for _, _, y, w, margin in self._unpack(batches, width, fresh, missing):
                yield pa.RecordBatch.from_pydict({"loss": [_gradients(loss, margin, y, w)[2]], "weight": [float(w.sum())]})

        return blocks.mapInArrow(run, "loss double, weight double").agg(F.sum("loss") / F.sum("weight")).first()[0]

    def _grow(self, blocks: DataFrame, fresh: list[Tree], columns: list[str], edges: list[np.ndarray]) -> tuple[Tree, float]:
        tree, signs = Tree.root(self.depth), [self.monotone.get(c, 0) for c in columns]
        bounds, open_nodes, leaves, first_loss = {0: (-np.inf, np.inf)}, [0], 1, 0.0
        for level in range(self.depth):
            sums, loss = self._sums(blocks, fresh, tree, open_nodes, len(columns))
            first_loss = first_loss if level else loss
            found = []
            for node in open_nodes:
                if level == 0:
                    g, h = sums[node][0].sum(axis=0)[:2]
                    tree.value[0] = self._value(g, h, bounds[0])
                split = self._split(sums[node], signs, edges, bounds[node], tree.value[node])
                if split:
                    found.append((split["gain"], node, split))
            found.sort(key=lambda s: (-s[0], s[1]))
            if self.leaves:
                found = found[: max(0, self.leaves - leaves)]
            leaves += len(found)
            open_nodes = []
            for _, node, s in found:
                tree.feature[node], tree.bin[node], tree.missing_left[node] = s["feature"], s["bin"], s["missing_left"]
                tree.threshold[node] = float(edges[s["feature"]][s["bin"]])
                low, high = bounds[node]
                middle, sign = (s["left"] + s["right"]) / 2, signs[s["feature"]]
                sides = [(low, high), (low, high)]
                if sign:
                    sides = [(low, middle), (middle, high)] if sign > 0 else [(middle, high), (low, middle)]
                for child, value, side in ((2 * node + 1, s["left"], sides[0]), (2 * node + 2, s["right"], sides[1])):
                    tree.value[child], bounds[child] = value, side
                    open_nodes.append(child)
            if not open_nodes:
                break
        tree.value = [v * self.rate for v in tree.value]
        return tree, first_loss

    def _sums(self, blocks: DataFrame, fresh: list[Tree], tree: Tree, nodes: list[int], width: int) -> tuple[dict[int, list[np.ndarray]], float]:
        """Sums of (gradient, second derivative, rows) per open node, column and bin, and the loss before this tree."""
        missing, loss, count = self._missing, self.loss, self.bins + 1
        place = np.full(len(tree.feature), -1)
        place[nodes] = np.arange(len(nodes))

        def run(batches):
            out, lost = np.zeros((len(nodes), width, count, 3)), 0.0
            for columns, gone, y, w, margin in self._unpack(batches, width, fresh, missing):
                g, h, own = _gradients(loss, margin, y, w)
                lost += own
                at = tree.chosen(columns, tree.bin, gone, place)
                keep = at >= 0
                if not keep.all():
                    at, g, h, columns = at[keep], g[keep], h[keep], [c[keep] for c in columns]
                for k in range(width):
                    key = at * count + columns[k]
                    for j, v in enumerate((g, h, None)):
                        out[:, k, :, j] += np.bincount(key, v, minlength=len(nodes) * count).reshape(len(nodes), count)
            where = np.flatnonzero(out[..., 2].ravel())
            flat = out.reshape(-1, 3)[where]
            yield pa.RecordBatch.from_arrays([pa.array(where), *map(pa.array, flat.T)], names=["at", "g", "h", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([lost]), pa.array([0.0]), pa.array([0.0])], names=["at", "g", "h", "n"])

        parts = blocks.mapInArrow(run, "at long, g double, h double, n double")
        sums, lost = np.zeros((len(nodes) * width * count, 3)), 0.0
        for at, *values in parts.groupBy("at").agg(F.sum("g"), F.sum("h"), F.sum("n")).collect():
            if at < 0:
                lost = values[0]
            else:
                sums[at] = values
        sums = sums.reshape(len(nodes), width, count, 3)
        return {node: list(sums[k]) for k, node in enumerate(nodes)}, lost

    def _value(self, g: float, h: float, bounds: tuple[float, float]) -> float:
        pull = np.sign(g) * np.maximum(np.abs(g) - self.l1, 0)
        return np.clip(-pull / (h + self.l2), *bounds)

    def _cost(self, g, h, value):
        return g * value + (h + self.l2) * value * value / 2 + self.l1 * np.abs(value)

    def _split(self, sums: list[np.ndarray], signs: list[int], edges: list[np.ndarray], bounds: tuple[float, float], value: float) -> dict | None:
        """The allowed split of largest gain (ties: first column, then smallest threshold, then missing values to the right)."""
        best = None
        for k, (own, sign, edge) in enumerate(zip(sums, signs, edges)):
            last = len(edge)
            if not last:
                continue
            total, lost = own.sum(axis=0), own[last]
            upto = own[:last].cumsum(axis=0)
            for missing_left in (False, True):
                left = upto + lost if missing_left else upto
                right = total - left
                a, b = self._value(left[:, 0], left[:, 1], bounds), self._value(right[:, 0], right[:, 1], bounds)
                gain = self._cost(total[0], total[1], value) - self._cost(left[:, 0], left[:, 1], a) - self._cost(right[:, 0], right[:, 1], b)
                fits = (left[:, 2] > 0.5) & (right[:, 2] > 0.5) & (np.minimum(left[:, 1], right[:, 1]) >= self.least_weight) & (sign * (b - a) >= 0)
                gain = np.where(fits, gain, -np.inf)
                at = int(gain.argmax())
                if gain[at] > max(self.least_gain, 1e-12) and (best is None or gain[at] > best["gain"]):
                    best = {"gain": float(gain[at]), "feature": k, "bin": at, "missing_left": missing_left, "left": float(a[at]), "right": float(b[at])}
                if not lost[2]:
                    break
        return best


def _some(marks: np.ndarray) -> np.ndarray | None:
    return marks if marks.any() else None


def _block(cells: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    data = [cells.tobytes(), *[c.astype("<f8").tobytes() for c in columns]]
    return pa.RecordBatch.from_arrays([pa.array([d], pa.binary()) for d in data], names=["bins", "label", "weight", "margin"])


def blocks_total(blocks: DataFrame) -> tuple[float, float]:
    """Sums of the weights and of the weighted labels."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                y, w = (np.frombuffer(row[c], "<f8") for c in ("label", "weight"))
                yield pa.RecordBatch.from_pydict({"w": [float(w.sum())], "y": [float((w * y).sum())]})

    found = blocks.mapInArrow(run, "w double, y double").agg(F.sum("w"), F.sum("y")).first()
    return found[0] or 0.0, found[1] or 0.0
