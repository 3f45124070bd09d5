"""Observation sources behind one interface, so a job does not depend on the store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from brisa.operators import panel
from brisa.schema import POLLUTANT_NAMES
from brisa.sources import readers


class ObsSource(Protocol):
    def fetch(self, pollutant: str, start, end, stations: Sequence[str] | None = None) -> DataFrame:
        """Rows ``(fecha, pollutant, id_est, val)`` of one pollutant, both ends included."""


@dataclass
class ParquetObs:
    spark: SparkSession
    path: str

    def fetch(self, pollutant: str, start, end, stations: Sequence[str] | None = None) -> DataFrame:
        return panel.fetch(readers.scan_obs(self.spark, self.path), pollutant, start, end, stations)


@dataclass
class JdbcObs:
    """One table per pollutant (``cont_<code>``) behind a JDBC URL."""

    spark: SparkSession
    url: str
    parts: int = 64
    options: dict[str, str] = field(default_factory=dict)

    def fetch(self, pollutant: str, start, end, stations: Sequence[str] | None = None) -> DataFrame:
        if pollutant not in POLLUTANT_NAMES:
            raise ValueError(f"unknown pollutant code {pollutant!r}")
        d = readers.jdbc_obs(self.spark, self.url, f"cont_{pollutant}", pollutant, str(start), str(end), self.parts, **self.options)
        return panel.fetch(d, pollutant, start, end, stations)
