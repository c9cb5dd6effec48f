"""Access to the nine tables, from parquet folders, a catalog database or given DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from waybill.sources.schemas import SCHEMAS

#: Tables that only some sources have; reports use them where given.
OPTIONAL = {"shipments_current": "the current state of shipments, as kept by ``waybill.sources.current``"}


class Tables:
    """The tables by name, as attributes: ``tables.routes_new``. Nothing is read until asked for."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        unknown = set(frames) - set(SCHEMAS) - set(OPTIONAL)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self._frames = dict(frames)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Tables:
        def reader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")

        return cls({name: reader(name) for name in SCHEMAS})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Tables:
        def reader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.table(f"{database}.{name}")

        return cls({name: reader(name) for name in SCHEMAS})

    def __contains__(self, name: str) -> bool:
        return name in self._frames

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if not isinstance(frame, DataFrame):
            frame = self._frames[name] = frame()
        return frame

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._frames:
            raise AttributeError(name)
        return self[name]

    def names(self) -> list[str]:
        return [n for n in SCHEMAS if n in self._frames]

    def replace(self, **frames: DataFrame) -> Tables:
        return Tables({**self._frames, **frames})
