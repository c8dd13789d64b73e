"""Boosted regression trees over binned inputs.

Squared error sees the rows of a cell (one bin of every input) only as their number and sum, so a table of any size
is first summed up by cell; trees on the cells are those on the rows.  ``bins ** inputs`` bounds the cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the sketches that place the bin edges
_NOISE = 1e-12  # of the squared rest: a gain below it is a rounding error


@dataclass(frozen=True)
class Bins:
    """Edges of each input; a value on an edge lies in the bin below it."""

    inputs: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    count: int

    @classmethod
    def of(cls, df: DataFrame, inputs: Sequence[str], count: int) -> Bins:
        """Quantiles of every input, from one pass."""
        shares = [number / count for number in range(1, count)]
        found = df.agg(*[F.percentile_approx(name, shares, ACCURACY).alias(f"_{i}") for i, name in enumerate(inputs)]).first()
        return cls(tuple(inputs), tuple(tuple(sorted(set(edges or ()))) for edges in found), count)

    @property
    def cells(self) -> int:
        return self.count ** len(self.inputs)

    def cell(self) -> Column:
        """Number of the cell of a row."""
        number = F.lit(0).cast("long")
        for name, edges in zip(self.inputs, self.edges):
            above = [(F.col(name) > edge).cast("long") for edge in edges]
            number = number * self.count + reduce(add, above, F.lit(0).cast("long"))
        return number

    def codes(self, cells: np.ndarray) -> np.ndarray:
        """Bin of each input (rows) in each cell (columns)."""
        powers = self.count ** np.arange(len(self.inputs) - 1, -1, -1, dtype=np.int64)
        return cells[None, :] // powers[:, None] % self.count


def _tree(codes: np.ndarray, bins: int, count: np.ndarray, rest: np.ndarray, depth: int, least: int) -> np.ndarray:
    """Mean rest in the leaf of each cell; a node of under ``least`` rows is not split."""
    node = np.zeros(len(count), np.int64)
    cells = np.arange(len(count))
    noise = _NOISE * (rest**2 / np.maximum(count, 1)).sum()
    for _ in range(depth):
        if node.max(initial=0) >= len(count):
            node = np.unique(node, return_inverse=True)[1]
        nodes = int(node.max(initial=0)) + 1
        gain, feature, cut = np.full(nodes, noise), np.full(nodes, -1), np.zeros(nodes, np.int64)
        for number, code in enumerate(codes):
            place = node * bins + code
            left, low = (np.bincount(place, values, nodes * bins).reshape(nodes, bins).cumsum(axis=1) for values in (count, rest))
            whole, both = left[:, -1:], low[:, -1:]
            right, high = whole - left, both - low
            possible = (left > 0) & (right > 0) & (whole >= least)
            gained = low**2 / np.maximum(left, 1) + high**2 / np.maximum(right, 1) - both**2 / np.maximum(whole, 1)
            gained = np.where(possible, gained, 0.0)
            at = gained.argmax(axis=1)
            most = gained[np.arange(nodes), at]
            better = most > gain
            gain[better], feature[better], cut[better] = most[better], number, at[better]
        if (feature < 0).all():
            break
        chosen = feature[node]
        node = node * 2 + ((chosen >= 0) & (codes[chosen, cells] > cut[node]))
    held, sums = np.bincount(node, count), np.bincount(node, rest)
    return (sums / np.maximum(held, 1))[node]


def boosted_cells(
    codes: np.ndarray, bins: int, count: np.ndarray, total: np.ndarray, stages: Sequence[int], depth: int, least: int, rate: float
) -> np.ndarray:
    """Predictions of every cell (columns) after each number of trees in ``stages`` (rows).

    One run of the most trees scores the smaller numbers on its way.  Cells without rows are predicted too.
    """
    count, total = count.astype(float), total.astype(float)
    value = np.full(len(count), total.sum() / max(count.sum(), 1.0))
    shown = {}
    for number in range(1, max(stages) + 1):
        value = value + rate * _tree(codes, bins, count, total - count * value, depth, least)
        if number in stages:
            shown[number] = value
    return np.array([shown[number] for number in stages])


def sums_by_cell(df: DataFrame, bins: Bins, target: str, *by: str) -> DataFrame:
    """``cell``, ``n`` and ``total`` of the target."""
    return df.groupBy(*by, bins.cell().alias("cell")).agg(F.count(target).alias("n"), F.sum(target).alias("total"))


def fold_predictions(
    sums: DataFrame, bins: Bins, folds: int, stages: Sequence[int], points: Sequence[tuple[int, int, float]]
) -> DataFrame:
    """``fold``, ``cell``, ``shown``: for the cells of each fold, the predictions of trees fitted on the other folds.

    ``shown`` lists them by point (depth, least rows to split, rate), then stage.  Each fold and point is a task of its own, over the
    bounded table of sums.
    """

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        point, fold = int(part["point"].iloc[0]), int(part["held"].iloc[0])
        cells, place = np.unique(part["cell"].to_numpy(), return_inverse=True)
        own = (part["fold"] == fold).to_numpy()
        count, total = (np.bincount(place[~own], part[name].to_numpy()[~own], len(cells)) for name in ("n", "total"))
        found = boosted_cells(bins.codes(cells), bins.count, count, total, stages, *points[point])
        asked = place[own]
        return pd.DataFrame({"fold": fold, "cell": cells[asked], "point": point, "shown": list(found[:, asked].T)})

    # Every task reads all sums: their number is bounded by the spec, not by the rows behind them.
    shared = sums
    for name, count in (("held", folds), ("point", len(points))):
        shared = shared.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    fitted = shared.groupBy("held", "point").applyInPandas(fit, "fold int, cell long, point int, shown array<double>")
    listed = fitted.groupBy("fold", "cell").agg(F.sort_array(F.collect_list(F.struct("point", "shown"))).alias("listed"))
    return listed.select("fold", "cell", F.flatten("listed.shown").alias("shown"))


def model_cells(sums: DataFrame, bins: Bins, trees: int, point: tuple[int, int, float]) -> DataFrame:
    """``cell``, ``prediction`` for all cells there can be."""

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        cells = np.arange(bins.cells)
        count, total = (np.bincount(part["cell"], part[name], len(cells)) for name in ("n", "total"))
        found = boosted_cells(bins.codes(cells), bins.count, count, total, [trees], *point)
        return pd.DataFrame({"cell": cells, "prediction": found[0]})

    whole = sums.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return whole.groupBy().applyInPandas(fit, "cell long, prediction double")
