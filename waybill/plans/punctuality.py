"""On-time handling: did a route end as planned, and did it take no longer than planned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import count_if, safe_pct
from waybill.functions.times import hour_of, whole_minutes
from waybill.operators.scope import ReportScope
from waybill.sources.tables import Tables

FLEET_KEYS = ("country", "partner_id", "partner_name", "vehicle_type_name")
ROUTE_TIMES = (
    "planned_route_start_time",
    "planned_route_end_time",
    "actual_route_start_time",
    "actual_route_end_time",
)
LOW_OTH_PCT = 75.0


def _timed_routes(tables: Tables, scope: ReportScope) -> DataFrame:
    """Routes with all four times, neither interval inverted, reduced to the two verdicts."""
    p0, p1, a0, a1 = (F.col(c) for c in ROUTE_TIMES)
    routes = scope.routes(tables).dropna(subset=list(ROUTE_TIMES)).filter((a1 >= a0) & (p1 >= p0))
    return routes.select(
        "route_id",
        "route_date",
        "center_id",
        "partner_id",
        "vehicle_type_id",
        hour_of(p1).alias("planned_end_hour"),
        (a1 <= p1).alias("end_on_time"),
        (whole_minutes(a0, a1) <= whole_minutes(p0, p1)).alias("duration_on_time"),
    )


def _counts(routes: DataFrame, *keys: str) -> DataFrame:
    return routes.groupBy(*keys).agg(
        F.count("route_id").alias("n"),
        count_if(F.col("end_on_time")).alias("n_end"),
        count_if(F.col("duration_on_time")).alias("n_duration"),
    )


def _measures() -> list:
    n, n_end, n_duration = F.sum("n"), F.sum("n_end"), F.sum("n_duration")
    end_pct, duration_pct = safe_pct(n_end, n), safe_pct(n_duration, n)
    return [
        n.alias("total_routes"),
        n_end.alias("on_time_end_count"),
        end_pct.alias("oth_end_time_pct"),
        n_duration.alias("on_time_duration_count"),
        duration_pct.alias("oth_duration_pct"),
        F.round(duration_pct - end_pct, 2).alias("oth_metric_gap"),
    ]


def oth_by_fleet(
    tables: Tables, scope: ReportScope, keys: Sequence[str] = FLEET_KEYS
) -> DataFrame:
    """``keys`` may add ``planned_end_hour`` or ``route_date``.

    Routes are counted per hub, partner and vehicle first; the three dimensions meet only counts.
    """
    extra = [k for k in keys if k in ("planned_end_hour", "route_date")]
    counts = _counts(
        _timed_routes(tables, scope), "center_id", "partner_id", "vehicle_type_id", *extra
    )
    return (
        counts.join(tables.partners.select("partner_id", "partner_name"), "partner_id")
        .join(tables.vehicle_types.select("vehicle_type_id", "vehicle_type_name"), "vehicle_type_id")
        .join(tables.distribution_centers.select("center_id", "country"), "center_id")
        .groupBy(*keys)
        .agg(*_measures())
    )


def oth_by_hour(tables: Tables, scope: ReportScope) -> DataFrame:
    counts = _counts(_timed_routes(tables, scope), "planned_end_hour")
    return counts.groupBy("planned_end_hour").agg(*_measures()).orderBy("planned_end_hour")


def network_oth(tables: Tables, scope: ReportScope) -> DataFrame:
    return _counts(_timed_routes(tables, scope)).agg(*_measures())


def oth_underperforming(
    tables: Tables, scope: ReportScope, below_pct: float = LOW_OTH_PCT
) -> DataFrame:
    low = (F.col("oth_end_time_pct") < below_pct) | (F.col("oth_duration_pct") < below_pct)
    return oth_by_fleet(tables, scope).filter(low).orderBy("country", "oth_end_time_pct")


def oth_top_gap(
    tables: Tables, scope: ReportScope, k: int = 10, min_routes: int = 50
) -> DataFrame:
    """The ``k`` fleets that lose the most between duration and end time, given enough routes."""
    return (
        oth_by_fleet(tables, scope)
        .filter(F.col("total_routes") >= min_routes)
        .orderBy(
            F.desc("oth_metric_gap"),
            F.desc("total_routes"),
            "country",
            "partner_id",
            "vehicle_type_name",
        )
        .limit(k)
    )
