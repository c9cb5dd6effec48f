"""Delivery success: delivered shipments over shipments, each at its latest state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions.measures import count_if, safe_pct
from waybill.operators.latest import current_shipments
from waybill.operators.scope import ReportScope
from waybill.sources.tables import Tables

DELIVERED = "delivered"
_PARTNER_KEYS = ("country", "partner_id", "partner_name")


def _outcomes_per_route(tables: Tables) -> DataFrame:
    """Shipment counts per route, so that a route with very many shipments joins as one row."""
    return (
        current_shipments(tables)
        .groupBy("route_id")
        .agg(
            F.count("shipment_id").alias("shipments"),
            count_if(F.col("last_status_detail") == DELIVERED).alias("delivered"),
        )
    )


def _outcomes(tables: Tables, scope: ReportScope, *route_columns: str) -> DataFrame:
    routes = scope.routes(tables).select("route_id", *route_columns)
    per_route = routes.join(_outcomes_per_route(tables), "route_id")
    return per_route.groupBy(*route_columns).agg(
        F.sum("shipments").alias("shipments"), F.sum("delivered").alias("delivered")
    )


def _success_measures() -> list:
    total, delivered = F.sum("shipments"), F.sum("delivered")
    return [
        total.alias("total_shipments"),
        delivered.alias("delivered_shipments"),
        safe_pct(delivered, total).alias("success_rate_pct"),
    ]


def effectiveness_by_country(
    tables: Tables, scope: ReportScope, country_of: str = "center"
) -> DataFrame:
    """``country_of`` takes the country from the route's hub (``center``) or from its ``partner``."""
    hubs = tables.distribution_centers
    if country_of == "center":
        joined = _outcomes(tables, scope, "center_id").join(
            hubs.select("center_id", "country"), "center_id"
        )
    elif country_of == "partner":
        joined = (
            _outcomes(tables, scope, "center_id", "partner_id")
            .join(hubs.select("center_id"), "center_id")
            .join(tables.partners.select("partner_id", "country"), "partner_id")
        )
    else:
        raise ValueError(f"country_of must be 'center' or 'partner', not {country_of!r}")
    summary = joined.groupBy("country").agg(*_success_measures())
    return summary.orderBy(F.desc("success_rate_pct"), "country")


def network_effectiveness(tables: Tables, scope: ReportScope) -> DataFrame:
    hubs = tables.distribution_centers.select("center_id")
    return _outcomes(tables, scope, "center_id").join(hubs, "center_id").agg(*_success_measures())


def effectiveness_by_partner(
    tables: Tables, scope: ReportScope, country_of: str = "center"
) -> DataFrame:
    outcomes = _outcomes(tables, scope, "center_id", "partner_id")
    hub_columns = ["center_id"] + (["country"] if country_of == "center" else [])
    partner_columns = ["partner_id", "partner_name"] + (
        ["country"] if country_of == "partner" else []
    )
    return (
        outcomes.join(tables.distribution_centers.select(*hub_columns), "center_id")
        .join(tables.partners.select(*partner_columns), "partner_id")
        .groupBy(*_PARTNER_KEYS)
        .agg(*_success_measures())
        .orderBy("country", F.desc("success_rate_pct"), "partner_id")
    )


def effectiveness_outliers(
    tables: Tables,
    scope: ReportScope,
    fewer_than: int = 100,
    above_pct: float = 95.0,
    below_pct: float = 70.0,
) -> DataFrame:
    rate = F.col("success_rate_pct")
    odd = (F.col("total_shipments") < fewer_than) | (rate > above_pct) | (rate < below_pct)
    return (
        effectiveness_by_partner(tables, scope)
        .filter(odd)
        .orderBy("total_shipments", "country", "partner_id")
    )


def partner_extremes(tables: Tables, scope: ReportScope, n: int = 1) -> DataFrame:
    """The ``n`` best and ``n`` worst partners of every country."""
    rates = effectiveness_by_partner(tables, scope)
    sides = {
        "best": [F.desc_nulls_last("success_rate_pct"), F.asc("partner_id")],
        "worst": [F.asc_nulls_last("success_rate_pct"), F.asc("partner_id")],
    }
    ranked = [
        rates.withColumn("rank", F.row_number().over(Window.partitionBy("country").orderBy(*order)))
        .filter(F.col("rank") <= n)
        .select("country", F.lit(side).alias("side"), F.col("rank").cast("long").alias("rank"),
                "partner_id", "partner_name", "total_shipments", "success_rate_pct")
        for side, order in sides.items()
    ]
    return ranked[0].unionByName(ranked[1])


def homogeneity(
    rates: DataFrame,
    rate_column: str = "success_rate_pct",
    baseline: float | None = None,
    tolerance: float = 0.5,
) -> DataFrame:
    """How close group rates lie together: spread and how many fall inside ``baseline`` +- band.

    Without a baseline the band lies around the mean of the rates.
    """
    rate = F.col(rate_column)
    if baseline is None:
        middle = rates.agg(F.avg(rate).alias("m")).scalar()
    else:
        middle = F.lit(float(baseline))
    return rates.agg(
        F.count(rate).alias("group_count"),
        F.min(rate).alias("min_rate"),
        F.max(rate).alias("max_rate"),
        F.round(F.max(rate) - F.min(rate), 2).alias("spread"),
        F.round(F.stddev_samp(rate), 4).alias("stddev_rate"),
        count_if(F.abs(rate - middle) <= tolerance).alias("in_band_count"),
    )
