"""The network indicator card and its country table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.operators.scope import ReportScope
from waybill.plans.effectiveness import network_effectiveness
from waybill.plans.local_time import hour_corruption_overall
from waybill.plans.productivity import network_productivity, productivity_by_country
from waybill.plans.punctuality import network_oth
from waybill.sources.tables import Tables


def network_kpis(tables: Tables, scope: ReportScope) -> DataFrame:
    """One row; every percentage is a ratio of sums over the whole scope.

    A partner is active in the report unless it is deprecated or excluded by the scope.
    """
    partners = tables.partners.select("partner_id")
    reported = tables.partners.filter(
        F.coalesce(F.col("active_flag") != -1, F.lit(True))
    ).select("partner_id")
    if scope.exclude_partners is not None:
        excluded = scope.exclude_partners.select("partner_id")
        reported = reported.join(excluded, "partner_id", "left_anti")
    parts = [
        network_productivity(tables, scope).select(
            "stops_efficiency_pct", "capacity_utilization_pct"
        ),
        network_effectiveness(tables, scope).select("success_rate_pct"),
        network_oth(tables, scope).select("oth_end_time_pct", "oth_duration_pct", "oth_metric_gap"),
        hour_corruption_overall(tables).select(
            F.col("overall_corruption_pct").alias("hour_corruption_pct")
        ),
        reported.agg(F.count(F.lit(1)).alias("active_partners")),
        partners.agg(F.count(F.lit(1)).alias("total_partners")),
    ]
    columns = [c for part in parts for c in part.columns]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for c in columns])


def country_kpis(tables: Tables, scope: ReportScope) -> DataFrame:
    """Productivity by country under any filter of the scope."""
    return productivity_by_country(tables, scope)
