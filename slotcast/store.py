"""The five tables under one root folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .files import exists
from .operators import tables
from .schemas import TABLES, Layout


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def layout(self, name: str) -> Layout:
        return TABLES[name]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(
        self, name: str, first_day: str | None = None, last_day: str | None = None
    ) -> DataFrame:
        return tables.read_table(self.spark, self.path(name), TABLES[name], first_day, last_day)

    def last_day(self, name: str) -> str | None:
        """The newest day of a table, from its folder names; None if it has none."""
        return tables.last_day(self.spark, self.path(name), TABLES[name])

    def day_files(self, name: str) -> DataFrame:
        """(day, files): a digest of each day's file names."""
        return tables.day_files(self.spark, self.path(name), TABLES[name])

    def read_days(self, name: str, days: Sequence[str]) -> DataFrame:
        """The given days only; no other folder is listed."""
        return tables.read_days(self.spark, self.path(name), TABLES[name], days)

    def append(self, name: str, df: DataFrame) -> None:
        tables.append(df, self.path(name), TABLES[name])

    def upsert(self, name: str, df: DataFrame, newest_by: str | None = None) -> None:
        tables.upsert(df, self.path(name), TABLES[name], newest_by=newest_by)

    def truncate(self, *names: str) -> None:
        for name in names or TABLES:
            tables.truncate(self.spark, self.path(name), TABLES[name])

    def drop_expired(self, as_of: str) -> dict[str, list[str]]:
        return {
            name: tables.drop_expired(self.spark, self.path(name), layout, as_of)
            for name, layout in TABLES.items()
            if exists(self.spark, self.path(name))
        }
