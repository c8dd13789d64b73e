"""Trees over sums by cell against trees over rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators.boosted import Bins, boosted_cells, fold_predictions, model_cells, sums_by_cell
from gridtide.plans.training import TrainingSpec


def _by_rows(rows, rest, depth, least):
    """Mean rest of the leaf of each row, by trying every cut of every input."""
    out, best = np.full(len(rest), rest.mean()), 1e-9
    if depth == 0 or len(rest) < least:
        return out
    for column in range(rows.shape[1]):
        for cut in np.unique(rows[:, column])[:-1]:
            left = rows[:, column] <= cut
            gain = sum(rest[side].sum() ** 2 / side.sum() for side in (left, ~left)) - rest.sum() ** 2 / len(rest)
            if gain > best * (1 + 1e-9):
                best, chosen = gain, left
    if best > 1e-9:
        for side in (chosen, ~chosen):
            out[side] = _by_rows(rows[side], rest[side], depth - 1, least)
    return out


def _boosted_rows(rows, target, trees, depth, least, rate):
    value = np.full(len(target), target.mean())
    for _ in range(trees):
        value = value + rate * _by_rows(rows, target - value, depth, least)
    return value


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    inputs = rng.integers(0, 4, (400, 3))
    target = inputs[:, 0] * 3.0 + inputs[:, 1] * inputs[:, 2] + rng.normal(size=400)
    return inputs, target


@pytest.mark.parametrize(("depth", "least", "rate"), [(1, 2, 0.5), (3, 40, 0.3), (6, 2, 0.1)])
def test_cells_equal_rows(rows, depth, least, rate):
    inputs, target = rows
    bins = Bins(("a", "b", "c"), ((0, 1, 2),) * 3, 4)
    cells = inputs @ np.array([16, 4, 1])
    count, total = np.bincount(cells, minlength=64), np.bincount(cells, target, 64)
    found = boosted_cells(bins.codes(np.arange(64)), 4, count, total, [2, 7], depth, least, rate)
    for trees, values in zip((2, 7), found):
        assert values[cells] == pytest.approx(_boosted_rows(inputs, target, trees, depth, least, rate))


def test_folds_are_predicted_by_the_others(spark, rows):
    inputs, target = rows
    fold = np.arange(400) % 3
    data = [(int(f), *map(float, values), float(y)) for f, values, y in zip(fold, inputs, target)]
    df = spark.createDataFrame(data, "fold int, a double, b double, c double, y double").repartition(3)
    bins = Bins.of(df, ["a", "b", "c"], 16)
    assert bins.edges == ((0.0, 1.0, 2.0, 3.0),) * 3
    sums = sums_by_cell(df, bins, "y", "fold")
    points = [(2, 2, 0.5), (3, 30, 0.2)]
    shown = {(row.fold, row.cell): row.shown for row in fold_predictions(sums, bins, 3, [1, 5], points).collect()}
    own = df.withColumn("cell", bins.cell()).select("fold", "cell", "a", "b", "c").distinct().collect()
    assert {(row.fold, row.cell) for row in own} == set(shown)
    for held in range(3):
        others = fold != held
        expected = [_boosted_rows(inputs[others], target[others], trees, *point) for point in points for trees in (1, 5)]
        known = {tuple(row): number for number, row in enumerate(inputs[others].tolist())}
        for row in own:
            place = known.get((row.a, row.b, row.c))
            if row.fold == held and place is not None:
                assert shown[held, row.cell] == pytest.approx([values[place] for values in expected])
    model = model_cells(sums, bins, 5, points[0])
    assert model.count() == 16**3 and model.where(F.col("prediction").isNull()).count() == 0


def test_cells_are_bounded_by_the_spec():
    with pytest.raises(ValueError, match="fewer bins"):
        TrainingSpec(inputs=("a", "b", "c", "d", "e"))
    with pytest.raises(ValueError, match="Unknown"):
        TrainingSpec(grid={"depth": [3]})
    assert len(TrainingSpec().points()) == 16
