"""Data-quality checks as aggregates: all checks on a table share one scan of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.cleaning import digit_pattern
from waybill.functions.measures import count_if, safe_pct


@dataclass(frozen=True)
class Check:
    """A named pair of aggregates: how many records were looked at, how many are wrong."""

    name: str
    errors: Column
    total: Column

    @classmethod
    def rows(cls, name: str, wrong: Column, among: Column | None = None) -> Check:
        """Rows for which ``wrong`` is true, among all rows or those where ``among`` is true."""
        if among is None:
            return cls(name, count_if(wrong), F.count(F.lit(1)))
        return cls(name, count_if(among & wrong), count_if(among))

    @classmethod
    def duplicates(cls, name: str, key: str) -> Check:
        return cls(name, F.count(key) - F.count_distinct(key), F.count(key))


def run_checks(df: DataFrame, checks: Sequence[Check], label: str = "audit_check") -> DataFrame:
    """One row per check: label, total_records, error_count, error_pct."""
    measured = df.agg(
        *[c.total.alias(f"total_{i}") for i, c in enumerate(checks)],
        *[c.errors.alias(f"errors_{i}") for i, c in enumerate(checks)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(c.name).alias(label),
            F.col(f"total_{i}").alias("total_records"),
            F.col(f"errors_{i}").alias("error_count"),
        )
        for i, c in enumerate(checks)
    ])
    return measured.select(F.inline(rows)).withColumn(
        "error_pct", safe_pct(F.col("error_count"), F.col("total_records"))
    )


def not_in_domain(c: Column, allowed: Sequence) -> Column:
    """Outside the allowed values; NULL is outside."""
    return ~F.coalesce(c.isin(list(allowed)), F.lit(False))


def null_profile(df: DataFrame) -> DataFrame:
    """Columns that hold NULLs: column_name, null_count, null_pct."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(c) for c in df.columns])
    per_column = counts.unpivot("total", df.columns, "column_name", "present")
    nulls = F.col("total") - F.col("present")
    return per_column.filter(nulls > 0).select(
        "column_name", nulls.alias("null_count"), safe_pct(nulls, F.col("total")).alias("null_pct")
    )


def key_duplication(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key, over all rows; a NULL key counts as surplus."""
    total, unique = F.count(F.lit(1)), F.count_distinct(key)
    return df.agg(
        total.alias("total_records"),
        unique.alias("distinct_keys"),
        (total - unique).alias("duplicate_count"),
        safe_pct(total - unique, total).alias("duplicate_pct"),
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL values of ``column`` that the parent lacks.

    Both sides are reduced to distinct keys first, so a key with very many rows weighs as one.
    """
    wanted = child.filter(F.col(column).isNotNull()).select(F.col(column).alias("key")).distinct()
    known = parent.select(F.col(key).alias("key")).distinct()
    return wanted.join(known, "key", "left_anti")


def format_patterns(df: DataFrame, column: str) -> DataFrame:
    """Digit patterns of a text column with their share of the non-NULL values."""
    values = df.filter(F.col(column).isNotNull())
    total = values.agg(F.count(F.lit(1)).alias("total")).scalar()
    counts = values.groupBy(digit_pattern(F.col(column)).alias("pattern")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counts.select("pattern", "row_count", safe_pct(F.col("row_count"), total).alias("pct"))


def violation_sample(
    df: DataFrame, wrong: Column, columns: Sequence[str], order_by: Sequence[str], n: int = 5
) -> DataFrame:
    """The first ``n`` violating rows in key order."""
    return df.filter(wrong).select(*columns).orderBy(*order_by).limit(n)


def labelled(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Constant label columns in front."""
    return df.select(*[F.lit(v).alias(k) for k, v in labels.items()], "*")
