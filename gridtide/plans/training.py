"""Chronological split and grid search of a boosted-tree regression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.operators.boosted import Bins, fold_predictions, model_cells, sums_by_cell
from gridtide.operators.ordered import ROWS_PER_BLOCK, OrderedBlocks, total_order
from gridtide.operators.quality import forecast_scores
from gridtide.session import scratch_path, share_code
from gridtide.sources.files import read_parquet, replace_parquet, write_parquet

# What a parameter is where the grid leaves it out.
DEFAULTS = {"n_estimators": 100, "max_depth": 3, "min_samples_split": 2, "learning_rate": 0.1}
MAX_PREDICTIONS = 1 << 22  # folds x cells x points: what the search broadcasts, 32 MB


@dataclass(frozen=True)
class TrainingSpec:
    # Target, features, grid and evaluation of the declared model.
    target: str = "load_actual"
    inputs: tuple[str, ...] = ("solar_actual", "wind_actual", "wind_offshore")
    dropped: tuple[str, ...] = ("load_forecast",)
    train_share: float = 0.8
    folds: int = 3
    grid: Mapping[str, Sequence[float]] = field(
        default_factory=lambda: {
            "n_estimators": [200, 500],
            "max_depth": [5, 8],
            "min_samples_split": [5, 10],
            "learning_rate": [0.01, 0.05],
        }
    )
    time: str = "time"
    bins: int = 32

    def __post_init__(self) -> None:
        if unknown := sorted(set(self.grid) - set(DEFAULTS)):
            raise ValueError(f"Unknown parameters {unknown} in the grid.")
        if self.folds * self.bins ** len(self.inputs) * len(self.points()) > MAX_PREDICTIONS:
            raise ValueError(f"{len(self.inputs)} inputs of {self.bins} bins make too many cells: take fewer bins.")
        if both := sorted(set(self.inputs) & set(self.dropped)):
            raise ValueError(f"Columns {both} are inputs and dropped.")

    def points(self) -> list[dict[str, float]]:
        """The whole grid, numbers of trees last."""
        names = [*(name for name in DEFAULTS if name != "n_estimators"), "n_estimators"]
        values = [self.grid.get(name, [DEFAULTS[name]]) for name in names]
        return [dict(zip(names, point)) for point in product(*values)]


@dataclass(frozen=True)
class BinnedTrees:
    """Fitted trees as the prediction of every cell of the binned inputs."""

    bins: Bins
    cells: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``.  Cells are bounded by the spec, so their table is broadcast."""
        own = F.col("_cell") == F.col("cell")
        return df.withColumn("_cell", self.bins.cell()).join(F.broadcast(self.cells), own).drop("_cell", "cell")


@dataclass(frozen=True)
class TrainingResult:
    model: BinnedTrees
    best: dict[str, float]
    cv_mae: float
    points: DataFrame
    predictions: DataFrame
    scores: DataFrame


def chronological_split(
    df: DataFrame,
    share: float,
    folds: int = 1,
    time: str = "time",
    tiebreak: Sequence[str] | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add ``part`` (``train`` for the first ``floor(share * rows)`` rows in time order, else ``test``)
    and ``fold`` (contiguous stretches of the training rows of equal size; null in the test part).

    The cut rows are found exactly.  Rows equal in the whole order stay on one side.
    """
    if not 0.0 < share <= 1.0 or folds < 1:
        raise ValueError("The share has to be in (0, 1] and there has to be a fold.")
    blocks = OrderedBlocks.fit(df, total_order(df, [time], tiebreak), rows_per_block)
    training = int(df.count() * share)
    if training < folds:
        raise ValueError(f"{training} training rows are too few for {folds} folds.")
    keys = blocks.key_at(df, [training * fold // folds for fold in range(1, folds + 1)])
    fold = F
    for number, key in enumerate(keys):
        fold = fold.when(blocks.up_to(key), number)
    return df.withColumn("fold", fold).withColumn("part", F.when(F.col("fold").isNull(), "test").otherwise("train"))


def train(df: DataFrame, spec: TrainingSpec = TrainingSpec()) -> TrainingResult:
    """Search the whole grid on contiguous folds by mean absolute error, refit, score the held-out part.

    Rows that lack the target or an input take no part.  The split is stored once.  Trees are fitted on sums by cell and
    fold; errors are of the rows.  Points that differ in the number of trees share their fits.  Bin edges are quantiles of all
    training rows.  Of points with equal error the first stays.
    """
    spark = df.sparkSession
    share_code(spark)
    used = df.drop(*spec.dropped).select(spec.time, spec.target, *spec.inputs).dropna()
    path = scratch_path(spark, "split")
    write_parquet(chronological_split(used, spec.train_share, spec.folds, spec.time), path)
    parted = read_parquet(spark, path)
    known = parted.where(F.col("part") == "train")
    bins = Bins.of(known, spec.inputs, spec.bins)
    sums_path = scratch_path(spark, "sums")
    write_parquet(sums_by_cell(known, bins, spec.target, "fold"), sums_path)
    sums = read_parquet(spark, sums_path)

    points = spec.points()
    trees = list(dict.fromkeys(point["n_estimators"] for point in points))
    fits = list(dict.fromkeys(_fit_of(point) for point in points))
    shown = fold_predictions(sums, bins, spec.folds, trees, fits)
    judged = known.withColumn("cell", bins.cell()).join(F.broadcast(shown), ["fold", "cell"])
    errors = [F.avg(F.abs(F.col(spec.target) - F.get("shown", F.lit(i)))).alias(f"_{i}") for i in range(len(points))]
    by_fold = judged.groupBy("fold").agg(*errors)
    found = by_fold.agg(*[F.avg(f"_{i}").alias(f"_{i}") for i in range(len(points))]).first()
    position = min(range(len(points)), key=found.__getitem__)

    chosen = points[position]
    cells_path = scratch_path(spark, "trees")
    write_parquet(model_cells(sums, bins, chosen["n_estimators"], _fit_of(chosen)), cells_path)
    model = BinnedTrees(bins, read_parquet(spark, cells_path))
    predictions = model.transform(parted.where(F.col("part") == "test")).select(spec.time, spec.target, "prediction")
    searched = [(*(float(point[name]) for name in DEFAULTS), error) for point, error in zip(points, found)]
    return TrainingResult(
        model=model,
        best={name: chosen[name] for name in spec.grid},
        cv_mae=found[position],
        points=spark.createDataFrame(searched, ", ".join(f"{name} double" for name in (*DEFAULTS, "mae"))),
        predictions=predictions,
        scores=forecast_scores(predictions, actual=spec.target, forecast="prediction"),
    )


def _fit_of(point: Mapping[str, float]) -> tuple[int, int, float]:
    return point["max_depth"], point["min_samples_split"], point["learning_rate"]


def save_predictions(result: TrainingResult, path: str) -> int:
    return replace_parquet(result.predictions, path)
