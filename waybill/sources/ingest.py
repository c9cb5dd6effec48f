"""CSV files to typed parquet tables: read as text, clean, align, check, replace."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import astuple, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    LongType,
    TimestampNTZType,
)

from waybill.functions import cleaning
from waybill.sources.publish import write_table
from waybill.sources.schemas import CLOCK_COLUMNS, SCHEMAS, required_columns

log = logging.getLogger(__name__)


class MissingColumn(ValueError):
    """A required column is absent from the source."""


class RejectedValues(ValueError):
    """A strict load met text that does not fit the declared type, or a NULL required value."""


@dataclass(frozen=True)
class Outcome:
    table_name: str
    status: str
    rows_read: int | None = None
    rows_written: int | None = None
    rejected: int | None = None
    message: str | None = None

    @property
    def reconciled(self) -> bool:
        return self.status == "loaded" and self.rows_read == self.rows_written


OUTCOME_SCHEMA = (
    "table_name string, status string, rows_read long, rows_written long, rejected long, "
    "message string"
)


def read_raw(spark: SparkSession, path: str, quoted_newlines: bool = True) -> DataFrame:
    """A headered CSV file or folder with every column as text.

    A file with newlines inside quotes can only be read by one task. Where the exports hold none,
    ``quoted_newlines=False`` lets Spark split large files.
    """
    return (
        spark.read.option("header", True)
        .option("multiLine", quoted_newlines)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def align(raw: DataFrame, table: str) -> DataFrame:
    """The declared columns in order: extra ones dropped, missing nullable ones NULL."""
    missing = [c for c in required_columns(table) if c not in raw.columns]
    if missing:
        raise MissingColumn(f"{table}: required columns missing: {missing}")
    return raw.select(*[
        (cleaning.blank_to_null(F.col(f.name)) if f.name in raw.columns
         else F.lit(None).cast("string")).alias(f.name)
        for f in SCHEMAS[table]
    ])


def _parsed(name: str, kind: DataType, table: str) -> Column:
    text = F.col(name)
    if name in CLOCK_COLUMNS.get(table, ()):
        return cleaning.time_on_date(cleaning.parse_date(F.col("route_date")), text)
    if isinstance(kind, DateType):
        return cleaning.parse_date(text)
    if isinstance(kind, TimestampNTZType):
        return cleaning.parse_timestamp(text)
    if isinstance(kind, LongType):
        return cleaning.parse_long(text)
    if isinstance(kind, DoubleType):
        return cleaning.parse_double(text)
    return text


def clean(aligned: DataFrame, table: str) -> DataFrame:
    """Text columns to the declared types; unreadable text becomes NULL."""
    return aligned.select(*[
        _parsed(f.name, f.dataType, table).alias(f.name) for f in SCHEMAS[table]
    ])


def _reject_counts(table: str) -> list[Column]:
    """Per column: text that does not parse, and NULLs in required columns."""
    counts = []
    for f in SCHEMAS[table]:
        bad = F.col(f.name).isNotNull() & _parsed(f.name, f.dataType, table).isNull()
        if not f.nullable:
            bad = bad | F.col(f.name).isNull()
        counts.append(F.count_if(bad).alias(f.name))
    return counts


def rejects(aligned: DataFrame, table: str) -> DataFrame:
    """One row per column: table_name, column_name, rejected."""
    rows = F.array(*[
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.col(f.name).alias("rejected"),
        )
        for f in SCHEMAS[table]
    ])
    return aligned.agg(*_reject_counts(table)).select(F.inline(rows))


def load_table(
    spark: SparkSession,
    table: str,
    source: str,
    target: str,
    strict: bool = True,
    quoted_newlines: bool = True,
    partition_by: Iterable[str] = (),
) -> Outcome:
    """Replace ``target`` with the cleaned source. A strict load with any reject writes nothing."""
    try:
        raw = read_raw(spark, source, quoted_newlines)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("%s: source %s does not exist, skipped", table, source)
        return Outcome(table, "missing", message=f"no source at {source}")
    aligned = align(raw, table)
    counts = aligned.agg(
        F.count(F.lit(1)).alias("_rows"), *_reject_counts(table)
    ).first().asDict()
    rows_read = counts.pop("_rows")
    rejected = {c: n for c, n in counts.items() if n}
    if strict and rejected:
        raise RejectedValues(f"{table}: rejected values: {rejected}")
    written = Observation(f"load {table}")
    typed = clean(aligned, table).observe(written, F.count(F.lit(1)).alias("rows"))
    write_table(typed, target, partition_by=partition_by)
    return Outcome(table, "loaded", rows_read, written.get["rows"], sum(rejected.values()))


def load_all(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    tables: Iterable[str] = tuple(SCHEMAS),
    strict: bool = True,
    quoted_newlines: bool = True,
) -> list[Outcome]:
    """Load ``<source_root>/<table>.csv`` for each table; a bad table does not stop the others.

    A missing required column does stop the run.
    """
    outcomes = []
    for table in tables:
        source, target = f"{source_root}/{table}.csv", f"{target_root}/{table}"
        try:
            outcome = load_table(spark, table, source, target, strict, quoted_newlines)
        except MissingColumn:
            raise
        except (RejectedValues, PySparkException, Py4JJavaError, OSError) as error:
            log.error("%s: load failed: %s", table, error)
            outcome = Outcome(table, "failed", message=str(error))
        outcomes.append(outcome)
    return outcomes


def outcomes_frame(spark: SparkSession, outcomes: Iterable[Outcome]) -> DataFrame:
    return spark.createDataFrame([astuple(o) for o in outcomes], OUTCOME_SCHEMA)
