"""Boosted symmetric trees for a mean and its uncertainty, trained by Spark jobs.

A row's target is taken as normal around a mean ``mu`` with the standard
deviation ``exp(s)``.  Every tree adds a step to both at once: its leaves hold
the averaged natural gradient of the Gaussian likelihood, ``y - mu`` for the
mean and ``(z^2 - 1) / 2`` for ``s``, with ``z = (y - mu) / exp(s)``.

All nodes of a level share one split (``x > border``), so a leaf is the number
made of a row's answers, first level highest.  Per level one aggregate sums
gradients by (feature, leaf, bin): each task adds up its rows before anything is
shuffled, and the driver receives features x leaves x bins sums, whatever the
number of rows.  Rows are binned once and packed into blocks; every
``REFRESH`` rounds the blocks are written again with the state reached, so a
pass evaluates few trees and a lost executor costs one pass.

The first pass of a round also measures the rows set aside for validation:
their errors by round are the curve.  Training stops ``patience`` rounds after
the curve's minimum, and the ensemble is cut there.

Missing values (null, NaN) are a bin of their own below all others.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.session import stored

REFRESH = 16
#: Gains closer than this share are equal; the first feature and border win.
TIE = 1e-9
#: The largest step of the log deviation in one round, before the learning rate.
LARGEST_STEP = 1.0
_HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)


@dataclass
class Tree:
    """``splits`` are (feature, bin): a row goes right where its bin is greater."""

    splits: list[tuple[int, int]]
    leaves: list[tuple[float, float]]
    covers: list[int]

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins), np.int64)
        for f, b in self.splits:
            out = out << 1 | (bins[:, f] > b)
        return out


@dataclass
class Ensemble:
    """Trees up to the best round, and the validation errors of all rounds."""

    features: list[str]
    borders: list[list[float]]
    start: tuple[float, float]
    trees: list[Tree] = field(default_factory=list)
    curve: list[dict] = field(default_factory=list)

    @property
    def best_iteration(self) -> int:
        return len(self.trees)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Ensemble:
        kept = json.loads(text)
        trees = [Tree([tuple(s) for s in t["splits"]], [tuple(v) for v in t["leaves"]], t["covers"]) for t in kept.pop("trees")]
        return Ensemble(**kept | {"start": tuple(kept["start"]), "trees": trees})


def save(model: Ensemble, spark: SparkSession, path: str) -> None:
    """Writes a model, a small text, to a new folder."""
    spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.text(path)


def load(spark: SparkSession, path: str) -> Ensemble:
    return Ensemble.from_json(spark.read.text(path, wholetext=True).first()[0].strip())


def to_bins(values: np.ndarray, borders: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin 0 for missing values, else 1 and the number of borders below the value."""
    out = np.zeros(values.shape, np.uint8)
    for f, cuts in enumerate(borders):
        known = ~np.isnan(values[:, f])
        out[known, f] = 1 + np.searchsorted(np.array(cuts, float), values[known, f], side="left")
    return out


def _values(features: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width) if width else np.zeros((len(column), 0))


_BLOCK = "y binary, check binary, bins binary, mu binary, s binary"
_NAMES = ["y", "check", "bins", "mu", "s"]


def _packed(y: np.ndarray, check: np.ndarray, bins: np.ndarray, mu: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in (y, check, bins, mu, s)], _NAMES)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    kinds = (float, np.uint8, np.uint8, float, float)
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in _NAMES]):
            y, check, bins, mu, s = (np.frombuffer(p, k) for p, k in zip(row, kinds))
            yield y, check.astype(bool), bins.reshape(len(y), width), mu, s


def _advanced(bins: np.ndarray, mu: np.ndarray, s: np.ndarray, trees: Sequence[Tree]) -> tuple[np.ndarray, np.ndarray]:
    for tree in trees:
        steps = np.array(tree.leaves)[tree.leaf(bins)]
        mu, s = mu + steps[:, 0], s + steps[:, 1]
    return mu, s


def _sums(blocks: DataFrame, width: int, n_bins: int, trees: list[Tree], splits: list[tuple[int, int]]) -> dict:
    """(n, sum of y - mu, of z, of (z^2 - 1) / 2) of the training rows by (feature, leaf, bin); errors of the others by (-1, 0, 0)."""
    partial, n_leaves = Tree(splits, [], []), 1 << len(splits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, errors = np.zeros((4, width, n_leaves * n_bins)), np.zeros(4)
        for y, check, bins, mu, s in _blocks(batches, width):
            mu, s = _advanced(bins, mu, s, trees)
            z = (y - mu) * np.exp(-s)
            if not splits:
                errors += [check.sum(), ((y - mu)[check] ** 2).sum(), (0.5 * z**2 + s + _HALF_LOG_2PI)[check].sum(), 0]
            own = ~check
            weights = (None, (y - mu)[own], z[own], 0.5 * (z[own] ** 2 - 1))
            base = partial.leaf(bins[own]) * n_bins
            for f in range(width):
                cells = base + bins[own, f]
                for k, w in enumerate(weights):
                    total[k, f] += np.bincount(cells, w, n_leaves * n_bins)
        feature, cell = np.nonzero(total[0])
        columns = [np.append(feature, -1), np.append(cell // n_bins, 0), np.append(cell % n_bins, 0), *(np.append(total[k, feature, cell], errors[k]) for k in range(4))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "leaf", "bin", "n", "g", "z", "v"])

    parts = blocks.mapInArrow(run, "feature long, leaf long, bin long, n double, g double, z double, v double")
    rows = parts.groupBy("feature", "leaf", "bin").agg(*[F.sum(c).alias(c) for c in "ngzv"]).collect()
    return {(r["feature"], r["leaf"], r["bin"]): (r["n"], r["g"], r["z"], r["v"]) for r in rows}


def _best_split(sums: np.ndarray, borders: Sequence[Sequence[float]], l2: float, min_rows: int) -> tuple[int, int] | None:
    """The (feature, bin) with the largest gain; ``sums`` is (feature, leaf, bin, 4)."""
    left = np.cumsum(sums, axis=2)
    whole = left[:, :, -1:, :]

    def worth(part: np.ndarray) -> np.ndarray:
        return (part[..., 2] ** 2 + part[..., 3] ** 2) / (part[..., 0] + l2)

    small = (np.minimum(left[..., 0], (whole - left)[..., 0]) >= min_rows).any(axis=1)
    gains = np.where(small, (worth(left) + worth(whole - left) - worth(whole)).sum(axis=1), -1.0)
    best, found = 0.0, None
    for f, cuts in enumerate(borders):
        for b in range(len(cuts) + 1):
            if gains[f, b] > best * (1 + TIE) + 1e-12:
                best, found = float(gains[f, b]), (f, b)
    return found


def _grow(blocks: DataFrame, model: Ensemble, since: list[Tree], n_bins: int, depth: int, rate: float, l2: float, min_rows: int) -> tuple[Tree | None, dict]:
    width, splits, errors, node = len(model.features), [], {}, None
    for level in range(depth):
        found = _sums(blocks, width, n_bins, since, splits)
        n, square, likelihood, _ = found.pop((-1, 0, 0), (0, 0, 0, 0))
        if level == 0 and n:
            errors = {"rows": int(n), "rmse": math.sqrt(square / n), "negative_log_likelihood": likelihood / n}
        sums = np.zeros((width, 1 << level, n_bins, 4))
        for (f, leaf, b), values in found.items():
            sums[f, leaf, b] = values
        split = _best_split(sums, model.borders, l2, min_rows)
        if split is None:
            break
        splits.append(split)
        f, b = split
        node = np.stack([sums[f, :, : b + 1].sum(axis=1), sums[f, :, b + 1 :].sum(axis=1)], axis=1).reshape(-1, 4)
    if node is None:
        return None, errors
    n = node[:, 0] + l2
    steps = np.divide(node[:, [1, 3]], n[:, None], out=np.zeros((len(node), 2)), where=n[:, None] > 0)
    steps[:, 1] = np.clip(steps[:, 1], -LARGEST_STEP, LARGEST_STEP)
    return Tree(splits, [tuple(v) for v in (rate * steps).tolist()], node[:, 0].astype(int).tolist()), errors


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round of the smallest error so far (the first of equals), and whether ``patience`` rounds have passed since."""
    best = min(range(len(errors)), key=lambda k: errors[k]) if errors else 0
    return best, len(errors) - 1 - best >= patience


def quantile_borders(df: DataFrame, features: Sequence[str], n_borders: int, error: float = 0.001) -> list[list[float]]:
    """Up to ``n_borders`` borders per feature from mergeable quantile sketches of one pass."""
    known = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(str(k)) for k, c in enumerate(features)])
    shares = [(k + 1) / (n_borders + 1) for k in range(n_borders)]
    found = known.approxQuantile([str(k) for k in range(len(features))], shares, error) if features else []
    return [sorted({q for q in cuts if math.isfinite(q)}) for cuts in found]


def fit(
    df: DataFrame, target: str, features: Sequence[str], validation: Column, iterations: int = 200, depth: int = 6, rate: float = 0.15,
    l2: float = 3.0, min_rows: int = 10, patience: int = 25, n_borders: int = 128, borders: Sequence[Sequence[float]] | None = None,
) -> Ensemble:
    """Trains on the rows of ``df`` that have a target and where ``validation`` is not true, and stops by the others.

    Without validation rows all rounds are kept.  No rows give a model without trees.
    """
    if not 0 < n_borders < 255 or any(len(c) >= 255 for c in borders or []):
        raise ValueError("between 1 and 254 borders per feature")
    width = len(features)
    check = F.coalesce(validation, F.lit(False))
    rows = df.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    train = rows.where(~check)
    cuts = [sorted(map(float, c)) for c in borders] if borders is not None else quantile_borders(train, features, n_borders)
    moments = train.agg(F.avg(F.col(target).cast("double")), F.stddev_pop(F.col(target).cast("double"))).first()
    start = (float(moments[0] or 0.0), math.log(max(float(moments[1] or 0.0), 1e-6)))
    model = Ensemble(list(features), cuts, start)
    n_bins = max([len(c) for c in cuts], default=0) + 2

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
                bins = to_bins(_matrix(batch.column("x"), width), cuts)
                flags = batch.column("check").to_numpy(zero_copy_only=False).astype(np.uint8)
                yield _packed(y, flags, bins, np.full(len(y), start[0]), np.full(len(y), start[1]))

    picked = rows.select(F.col(target).cast("double").alias("y"), check.alias("check"), _values(features).alias("x"))
    blocks = stored(picked.mapInArrow(pack, _BLOCK), "boosting")
    trees: list[Tree] = []
    since: list[Tree] = []
    while True:
        tree, errors = _grow(blocks, model, since, n_bins, depth, rate, l2, min_rows)
        if errors:
            model.curve.append({"iteration": len(trees), **errors})
            best, over = best_round([c["negative_log_likelihood"] for c in model.curve], patience)
            model.trees = trees[:best]
        else:
            model.trees, over = list(trees), False
        if tree is None or over or len(trees) >= iterations:
            return model
        trees.append(tree)
        since.append(tree)
        if len(since) >= REFRESH:
            passed = list(since)

            def refresh(batches: Iterator[pa.RecordBatch], passed=passed) -> Iterator[pa.RecordBatch]:
                for y, check, bins, mu, s in _blocks(batches, width):
                    yield _packed(y, check.astype(np.uint8), bins, *_advanced(bins, mu, s, passed))

            blocks, since = stored(blocks.mapInArrow(refresh, _BLOCK), "boosting"), []


def curve_table(model: Ensemble, spark: SparkSession) -> DataFrame:
    """(iteration, rows, rmse, negative_log_likelihood, is_best), one row per round."""
    rows = [(c["iteration"], c["rows"], c["rmse"], c["negative_log_likelihood"], c["iteration"] == model.best_iteration) for c in model.curve]
    return spark.createDataFrame(rows, "iteration int, rows long, rmse double, negative_log_likelihood double, is_best boolean")


def leaf_weights(tree: Tree, inside: frozenset[int]) -> np.ndarray:
    """(leaf, leaf): how a row of the first leaf spreads over all leaves when only features ``inside`` are known.

    Where a split's feature is not known, both sides count by their training
    rows, and by half where a node has none.
    """
    depth, n = len(tree.splits), len(tree.covers)
    leaves = np.arange(n)
    out = np.ones((n, n))
    covers = np.array(tree.covers, float)
    for level, (f, _) in enumerate(tree.splits):
        child = leaves >> (depth - 1 - level)
        if f in inside:
            out *= child[:, None] % 2 == child[None, :] % 2
        else:
            sizes = np.bincount(child, covers)
            parents = np.bincount(child >> 1, covers)
            own, parent = sizes[child], parents[child >> 1]
            out *= np.divide(own, parent, out=np.full(n, 0.5), where=parent > 0)[None, :]
    return out


def shapley_tables(tree: Tree) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The tree's features, exact contributions (leaf, feature, 2) and the expected step (2).

    A row's contributions depend on its leaf alone, so they are a table per
    tree, over all coalitions of the at most ``depth`` features in it.
    """
    own = sorted({f for f, _ in tree.splits})
    steps = np.array(tree.leaves).reshape(len(tree.covers), 2)
    value = {frozenset(c): leaf_weights(tree, frozenset(c)) @ steps for k in range(len(own) + 1) for c in combinations(own, k)}
    out = np.zeros((len(tree.covers), len(own), 2))
    for at, f in enumerate(own):
        for coalition, base in value.items():
            if f not in coalition:
                share = 1 / (len(own) * math.comb(len(own) - 1, len(coalition)))
                out[:, at] += share * (value[coalition | {f}] - base)
    return own, out, value[frozenset()][0]


def predict(df: DataFrame, model: Ensemble, keep: Sequence[str]) -> DataFrame:
    """``keep`` and prediction, variance, contributions and log_deviation_contributions, bias and log_deviation_bias.

    Contributions are arrays in the order of ``model.features``; with the bias,
    which is the expected prediction over the training rows, they add up to the
    prediction (and to the log of its standard deviation).
    """
    width = len(model.features)
    tables = [shapley_tables(t) for t in model.trees]
    expected = sum((t[2] for t in tables), np.array(model.start))
    trees, borders, start = model.trees, model.borders, model.start
    added = "prediction double, variance double, contributions array<double>, log_deviation_contributions array<double>, bias double, log_deviation_bias double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            bins = to_bins(_matrix(batch.column("_x"), width), borders)
            total, shares = np.tile(np.array(start, float), (n, 1)), np.zeros((n, width, 2))
            for tree, (own, table, _) in zip(trees, tables):
                leaf = tree.leaf(bins)
                total += np.array(tree.leaves)[leaf]
                shares[:, own] += table[leaf]
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(shares[:, :, k].ravel())) for k in (0, 1)]
            new = [pa.array(total[:, 0]), pa.array(np.exp(2 * total[:, 1])), *lists, *(pa.array(np.full(n, float(e))) for e in expected)]
            names = [c.split()[0] for c in added.split(", ")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), *new], [*batch.schema.names[: len(keep)], *names])

    picked = df.select(*keep, _values(model.features).alias("_x"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[: len(keep)])
    return picked.mapInArrow(run, f"{fields}, {added}" if fields else added)
