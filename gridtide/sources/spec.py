"""Declaration of a source: where the raw file is and what its columns become."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceSpec:
    name: str
    raw_file: str
    timestamp: str
    columns: tuple[tuple[str, str], ...]  # (raw name, clean name)
    frequency: str = "hourly"

    def __post_init__(self) -> None:
        raws, cleans = [raw for raw, _ in self.columns], [clean for _, clean in self.columns]
        if len(set(raws)) < len(raws) or len(set(cleans)) < len(cleans):
            raise ValueError(f"Source '{self.name}' maps a column twice.")
        if self.timestamp not in raws:
            raise ValueError(f"Source '{self.name}' does not map its timestamp column '{self.timestamp}'.")

    @classmethod
    def from_mapping(cls, name: str, entry: Mapping[str, Any]) -> SourceSpec:
        """Build from a plain mapping, as read from a JSON or YAML file."""
        columns = tuple((pair["raw"], pair["clean"]) for pair in entry["columns"])
        return cls(name, entry["raw_file"], entry["timestamp"], columns, entry.get("frequency", "hourly"))

    @property
    def raw_columns(self) -> list[str]:
        return [raw for raw, _ in self.columns]

    def raw_type(self, raw: str) -> T.DataType:
        if raw not in self.raw_columns:
            return T.StringType()
        return T.TimestampType() if raw == self.timestamp else T.DoubleType()

    def require(self, present: Iterable[str]) -> None:
        missing = sorted(set(self.raw_columns) - set(present))
        if missing:
            raise ValueError(f"Source '{self.name}' lacks the columns {missing}.")


# Column names of the public hourly power data set and their clean names.
POWER_LOAD_COLUMNS = (
    ("utc_timestamp", "time"),
    ("DE_load_actual_entsoe_transparency", "load_actual"),
    ("DE_load_forecast_entsoe_transparency", "load_forecast"),
    ("DE_solar_generation_actual", "solar_actual"),
    ("DE_wind_generation_actual", "wind_actual"),
    ("DE_wind_onshore_generation_actual", "wind_onshore"),
    ("DE_wind_offshore_generation_actual", "wind_offshore"),
)


def power_load_source(raw_file: str, name: str = "load") -> SourceSpec:
    return SourceSpec(name, raw_file, "utc_timestamp", POWER_LOAD_COLUMNS)
