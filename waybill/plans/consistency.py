"""Carrier consistency: stale routes, inverted or missing times, overlaps, expired contracts.

Every function covers all partners; ``partner_id`` and the date bounds narrow it. ``period``
(``week``, ``month``, ``quarter``, ``year``) adds the first day of the route's period as a key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import count_if, safe_pct
from waybill.operators.overlap import overlap_counts
from waybill.operators.scope import ReportScope
from waybill.sources.tables import Tables

MAX_ERROR_PCT = 5.0

_ACTUAL_START = "actual_route_start_time"
_ACTUAL_END = "actual_route_end_time"


def _routes(
    tables: Tables,
    partner_id: str | None,
    start: date | str | None,
    end: date | str | None,
    period: str | None = None,
) -> DataFrame:
    scope = ReportScope(
        route_type=None, route_status=None, start=start, end=end, partner_id=partner_id
    )
    routes = scope.routes(tables).filter(F.col("partner_id").isNotNull())
    return routes.withColumn("period", F.trunc("route_date", period)) if period else routes


def _stale(as_of: date | str | None) -> Column:
    """Still in progress; with ``as_of`` only when the route's day lies before it."""
    open_route = F.col("route_status") == "IN_PROGRESS"
    return open_route if as_of is None else open_route & (F.col("route_date") < F.lit(as_of).cast("date"))


def _completed() -> Column:
    return F.col("route_status") == "COMPLETED"


def _inverted() -> Column:
    return _completed() & (F.col(_ACTUAL_END) < F.col(_ACTUAL_START))


def _untimed() -> Column:
    return _completed() & (F.col(_ACTUAL_START).isNull() | F.col(_ACTUAL_END).isNull())


def _out_of_contract() -> Column:
    return (F.col("route_date") > F.col("contract_end_date")) | (F.col("active_flag") == 0)


def stale_closure(
    tables: Tables,
    partner_id: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    as_of: date | str | None = None,
) -> DataFrame:
    total = F.count("route_id")
    stale, completed = count_if(_stale(as_of)), count_if(_completed())
    return _routes(tables, partner_id, start, end).groupBy("partner_id").agg(
        total.alias("total_routes"),
        stale.alias("stale_routes_count"),
        safe_pct(stale, total).alias("stale_routes_pct"),
        completed.alias("completed_routes_count"),
        safe_pct(completed, total).alias("route_closure_rate"),
    )


def gps_chronology(
    tables: Tables,
    partner_id: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    completed = count_if(_completed())
    inverted, untimed = count_if(_inverted()), count_if(_untimed())
    return _routes(tables, partner_id, start, end).groupBy("partner_id").agg(
        F.count("route_id").alias("total_routes"),
        completed.alias("completed_routes"),
        inverted.alias("chrono_violations_count"),
        safe_pct(inverted, completed).alias("chrono_violations_pct"),
        untimed.alias("gps_sync_failures_count"),
        safe_pct(untimed, completed).alias("gps_sync_failures_pct"),
    )


def _overlap_sums(routes: DataFrame, *keys: str) -> DataFrame:
    counts = overlap_counts(routes, keys=[*keys, "route_date"], per=keys)
    return counts.select(
        *keys,
        (F.col("as_a") + F.col("as_b")).alias("overlapping_routes_estimate"),
        F.col("multi_hub").alias("multi_hub_overlaps_count"),
        F.col("impossible_vehicle").alias("impossible_vehicle_allocations_count"),
    )


_OVERLAP_COLUMNS = (
    "overlapping_routes_estimate",
    "multi_hub_overlaps_count",
    "impossible_vehicle_allocations_count",
)


def overlap_summary(
    tables: Tables,
    partner_id: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """One row for every partner of the partner table; zeros where nothing overlaps."""
    sums = _overlap_sums(_routes(tables, partner_id, start, end), "partner_id")
    partners = tables.partners.select("partner_id")
    if partner_id is not None:
        partners = partners.filter(F.col("partner_id") == partner_id)
    return partners.join(sums, "partner_id", "left").fillna(0, subset=list(_OVERLAP_COLUMNS))


def contract_violations(
    tables: Tables,
    partner_id: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Routes after the contract ended or with an inactive partner (flag 0; -1 is not inactive)."""
    contracts = tables.partners.select(
        "partner_id", "partner_name", "active_flag", "contract_end_date"
    )
    return (
        _routes(tables, partner_id, start, end)
        .groupBy("partner_id", "route_date")
        .agg(F.count("route_id").alias("routes"))
        .join(contracts, "partner_id")
        .filter(_out_of_contract())
        .groupBy("partner_id", "partner_name", "contract_end_date")
        .agg(
            F.sum("routes").alias("routes_after_expiration_count"),
            F.min("route_date").alias("earliest_violation_date"),
            F.max("route_date").alias("latest_violation_date"),
        )
    )


def consistency_profile(
    tables: Tables,
    partner_id: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    as_of: date | str | None = None,
    period: str | None = None,
) -> DataFrame:
    """Route counts per partner (and period), joined only after they are counted.

    Whether a route is out of contract depends on its partner and day alone, so routes are counted
    per day before they meet the partner table.
    """
    keys = (["period"] if period else []) + ["partner_id"]
    routes = _routes(tables, partner_id, start, end, period)
    contracts = tables.partners.select(
        "partner_id", "partner_name", "active_flag", "contract_end_date"
    )
    counted = routes.groupBy(*keys).agg(
        F.count_distinct("route_id").alias("total"),
        count_if(_stale(as_of)).alias("stale"),
        count_if(_completed()).alias("completed"),
        count_if(_inverted()).alias("inverted"),
        count_if(_untimed()).alias("untimed"),
    )
    expired = (
        routes.groupBy(*keys, "route_date")
        .agg(F.count(F.lit(1)).alias("routes"))
        .join(contracts, "partner_id")
        .filter(_out_of_contract())
        .groupBy(*keys)
        .agg(F.sum("routes").alias("expired"))
    )
    overlaps = _overlap_sums(routes, *keys)
    total, completed = F.col("total"), F.col("completed")
    return (
        counted.join(contracts.select("partner_id", "partner_name"), "partner_id")
        .join(expired, keys, "left")
        .join(overlaps, keys, "left")
        .fillna(0, subset=["expired", *_OVERLAP_COLUMNS])
        .select(
            *keys,
            "partner_name",
            total.alias("total_routes_assigned"),
            F.col("stale").alias("stale_in_progress_count"),
            safe_pct(F.col("stale"), total).alias("stale_in_progress_pct"),
            completed.alias("completed_routes_count"),
            F.col("inverted").alias("chrono_violations_count"),
            safe_pct(F.col("inverted"), completed).alias("chrono_violations_pct"),
            F.col("untimed").alias("gps_sync_failures_count"),
            safe_pct(F.col("untimed"), completed).alias("gps_sync_failures_pct"),
            *_OVERLAP_COLUMNS,
            F.col("expired").alias("contract_expired_routes_count"),
            safe_pct(F.col("expired"), total).alias("contract_expired_routes_pct"),
        )
    )


def partner_exclusion(
    tables: Tables,
    partner_id: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    max_error_pct: float = MAX_ERROR_PCT,
) -> DataFrame:
    """Stale routes, inverted routes and impossible vehicles over the routes of a partner."""
    errors = (
        F.col("stale_in_progress_count")
        + F.col("chrono_violations_count")
        + F.col("impossible_vehicle_allocations_count")
    )
    share = F.try_divide(errors, F.col("total_routes_assigned")) * 100
    return consistency_profile(tables, partner_id, start, end).select(
        "partner_id",
        errors.alias("combined_error_count"),
        F.round(share, 2).alias("combined_error_pct"),
        F.coalesce(share > max_error_pct, F.lit(False)).alias("excluded"),
    )


def flagged_partners(
    tables: Tables, max_error_pct: float = MAX_ERROR_PCT,
    start: date | str | None = None, end: date | str | None = None,
) -> DataFrame:
    """Partners left out of official reports for their error rate."""
    flags = partner_exclusion(tables, start=start, end=end, max_error_pct=max_error_pct)
    return flags.filter("excluded").select("partner_id")


def deprecated_partners(tables: Tables) -> DataFrame:
    return tables.partners.filter(F.col("active_flag") == -1).select("partner_id")


def route_status_breakdown(tables: Tables, partner_id: str | None = None) -> DataFrame:
    return _routes(tables, partner_id, None, None).groupBy("partner_id", "route_status").agg(
        F.count(F.lit(1)).alias("total_routes"),
        F.sum("estimated_stops").alias("total_estimated_stops"),
        F.sum("actual_stops").alias("total_actual_stops"),
        F.round(F.avg("route_distance_km"), 2).alias("avg_distance_km"),
    )


def partner_duplication(tables: Tables, partner_id: str | None = None) -> DataFrame:
    """Repeated shipment rows on the routes of a partner; counted per shipment before the join."""
    owners = _routes(tables, partner_id, None, None).select("route_id", "partner_id")
    counted = tables.shipments_new.groupBy("route_id", "shipment_id").agg(
        F.count("shipment_id").alias("rows")
    )
    raw, unique = F.sum("rows"), F.count_distinct("shipment_id")
    joined = counted.join(owners, "route_id")
    return joined.groupBy("partner_id").agg(
        raw.alias("total_raw_shipments"),
        unique.alias("unique_shipments"),
        (raw - unique).alias("duplicate_count"),
        safe_pct(raw - unique, raw).alias("duplicate_pct"),
    )
