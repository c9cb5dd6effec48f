"""Deliveries by UTC and by local hour, and audits of the logged hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import count_if, safe_pct
from waybill.functions.times import hour_of, hour_truncated, shift_hour
from waybill.operators.scope import ReportScope
from waybill.sources.tables import Tables

LATE_FROM = 20


def _delivery_hours(
    tables: Tables, scope: ReportScope | None, event_type: str, late_from: int
) -> DataFrame:
    """Delivery counts per country, offset and hour.

    Events are counted per route and hour before they meet the routes, then per hub and hour, so
    neither a busy route nor a busy hub gathers its events in one task. A whole-hour offset moves
    every event of an hour alike, which lets the local hour come from the UTC hour.
    """
    hour = hour_of(F.col("event_timestamp"))
    per_route = (
        tables.shipment_events_new.filter(F.col("event_type") == event_type)
        .groupBy("route_id", hour.alias("hour_utc"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            count_if(hour_truncated(F.col("event_hour_utc"), hour, late_from)).alias("truncated"),
        )
    )
    routes = tables.routes_new if scope is None else scope.routes(tables)
    per_hub = (
        per_route.join(routes.select("route_id", "center_id"), "route_id")
        .groupBy("center_id", "hour_utc")
        .agg(F.sum("events").alias("events"), F.sum("truncated").alias("truncated"))
    )
    hubs = tables.distribution_centers.select("center_id", "country", "timezone_offset")
    return per_hub.join(hubs, "center_id").withColumn(
        "hour_local", shift_hour(F.col("hour_utc"), F.col("timezone_offset"))
    )


def late_night_by_country(
    tables: Tables,
    scope: ReportScope | None,
    late_from: int = LATE_FROM,
    event_type: str = "delivered",
) -> DataFrame:
    """``scope=None`` takes the deliveries of all routes."""
    hours = _delivery_hours(tables, scope, event_type, late_from)
    zero, events = F.lit(0), F.col("events")
    total = F.sum("events")
    utc = F.sum(F.when(F.col("hour_utc") >= late_from, events).otherwise(zero))
    local = F.sum(F.when(F.col("hour_local") >= late_from, events).otherwise(zero))
    truncated = F.sum("truncated")
    return (
        hours.groupBy("country", "timezone_offset")
        .agg(
            total.alias("total_deliveries"),
            utc.alias(f"deliveries_utc_after_{late_from}"),
            safe_pct(utc, total).alias(f"pct_utc_after_{late_from}"),
            local.alias(f"deliveries_local_after_{late_from}"),
            safe_pct(local, total).alias(f"pct_local_after_{late_from}"),
            truncated.alias("corrupt_records_count"),
            safe_pct(truncated, total).alias("corruption_pct"),
        )
        .orderBy("country", "timezone_offset")
    )


def local_hour_profile(
    tables: Tables,
    scope: ReportScope | None,
    opens: int = 8,
    closes: int = 20,
    event_type: str = "delivered",
) -> DataFrame:
    """Events per country and local hour; ``in_hours`` marks ``opens <= hour < closes``.

    Events without a timestamp have no hour and stay out.
    """
    local = F.col("hour_local")
    return (
        _delivery_hours(tables, scope, event_type, LATE_FROM)
        .filter(F.col("hour_utc").isNotNull())
        .groupBy("country", "hour_local")
        .agg(F.sum("events").alias("events"))
        .withColumn("in_hours", (local >= opens) & (local < closes))
        .orderBy("country", "hour_local")
    )


def hour_corruption_matrix(tables: Tables, from_hour: int | None = None) -> DataFrame:
    """Events by true and logged hour; ``from_hour`` keeps the later true hours only."""
    matrix = (
        tables.shipment_events_new.select(
            hour_of(F.col("event_timestamp")).alias("true_hour_utc"),
            F.col("event_hour_utc").alias("logged_hour_utc"),
        )
        .groupBy("true_hour_utc", "logged_hour_utc")
        .agg(F.count(F.lit(1)).alias("total_events"))
    )
    bad = hour_truncated(F.col("logged_hour_utc"), F.col("true_hour_utc"), LATE_FROM)
    matrix = matrix.withColumn(
        "corrupt_records", F.when(bad, F.col("total_events")).otherwise(F.lit(0))
    ).withColumn("corruption_pct", safe_pct(F.col("corrupt_records"), F.col("total_events")))
    if from_hour is not None:
        matrix = matrix.filter(F.col("true_hour_utc") >= from_hour)
    return matrix.orderBy("true_hour_utc", "logged_hour_utc")


def hour_corruption_overall(tables: Tables) -> DataFrame:
    true_hour = hour_of(F.col("event_timestamp"))
    bad = count_if(hour_truncated(F.col("event_hour_utc"), true_hour, LATE_FROM))
    total = F.count(F.lit(1))
    return tables.shipment_events_new.agg(
        total.alias("total_rows"),
        bad.alias("total_corrupt_rows"),
        safe_pct(bad, total).alias("overall_corruption_pct"),
    )
