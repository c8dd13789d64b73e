"""Run stages from the command line: ``python -m gridtide STAGE --sources sources.json --root PATH``.

The JSON file maps source names to ``raw_file``, ``timestamp``, ``frequency`` and ``columns`` (raw and clean names).
"""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Sequence

from gridtide.plans import stages
from gridtide.plans.training import TrainingSpec, save_predictions, train
from gridtide.session import build_session
from gridtide.sources.files import read_parquet, replace_parquet
from gridtide.sources.spec import SourceSpec

logger = logging.getLogger(__name__)

STAGES = {
    "ingestion": stages.run_ingestion,
    "preprocessing": stages.run_preprocessing,
    "marts": stages.run_marts,
    "all": stages.run_all,
}


def read_sources(path: str) -> list[SourceSpec]:
    with open(path, encoding="utf-8") as file:
        return [SourceSpec.from_mapping(name, entry) for name, entry in json.load(file).items()]


def run_training(spark, specs: Sequence[SourceSpec], layout: stages.Layout, spec: TrainingSpec = TrainingSpec()):
    """Train on the stored features of every source; store held-out predictions and scores."""
    for source in specs:
        stored = read_parquet(spark, layout.features(source.name), "preprocessing")
        result = train(stored, spec)
        save_predictions(result, layout.predictions(source.name))
        replace_parquet(result.scores, layout.scores(source.name))
        logger.info("%s: best %s, cross-validated MAE %.3f", source.name, result.best, result.cv_mae)


def read_training(path: str) -> TrainingSpec:
    """Training settings from a JSON file; what it leaves out keeps its default."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    return TrainingSpec(**{name: tuple(value) if isinstance(value, list) else value for name, value in given.items()})


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gridtide", description=__doc__)
    parser.add_argument("stage", choices=[*STAGES, "training"])
    parser.add_argument("--sources", required=True, help="JSON file of source declarations")
    parser.add_argument("--root", required=True, help="root of the tables on shared storage")
    parser.add_argument("--training", help="JSON file of training settings")
    chosen = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark, sources, layout = build_session(), read_sources(chosen.sources), stages.Layout(chosen.root.rstrip("/"))
    if chosen.stage == "training":
        run_training(spark, sources, layout, read_training(chosen.training) if chosen.training else TrainingSpec())
    else:
        STAGES[chosen.stage](spark, sources, layout)


if __name__ == "__main__":
    main()
