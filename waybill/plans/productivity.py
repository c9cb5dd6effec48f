"""Stops efficiency and capacity use of routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import count_if, safe_pct
from waybill.operators.latest import current_shipments, latest_shipments
from waybill.operators.scope import ReportScope
from waybill.sources.tables import Tables

LOW_STOPS_RATIO = 0.60


def shipments_per_route(tables: Tables) -> DataFrame:
    """Distinct shipments per route, each counted on the route of its latest record."""
    latest = current_shipments(tables)
    return latest.groupBy("route_id").agg(F.count("shipment_id").alias("shipment_count"))


def _productivity_measures() -> list:
    stops, planned = F.sum("actual_stops"), F.sum("estimated_stops")
    carried, capacity = F.sum("shipment_count"), F.sum("max_capacity_units")
    return [
        F.count_distinct("route_id").alias("total_completed_routes"),
        planned.alias("total_estimated_stops"),
        stops.alias("total_actual_stops"),
        safe_pct(stops, planned).alias("stops_efficiency_pct"),
        carried.alias("total_shipments_carried"),
        capacity.alias("total_max_capacity"),
        safe_pct(carried, capacity).alias("capacity_utilization_pct"),
    ]


def _loaded_routes(tables: Tables, scope: ReportScope) -> DataFrame:
    """Routes with hub, vehicle and shipment count; a route without a vehicle is left out."""
    routes = scope.routes(tables).select(
        "route_id", "center_id", "vehicle_type_id", "estimated_stops", "actual_stops"
    )
    return (
        routes.join(tables.distribution_centers.select("center_id", "country"), "center_id")
        .join(
            tables.vehicle_types.select("vehicle_type_id", "max_capacity_units"), "vehicle_type_id"
        )
        .join(shipments_per_route(tables), "route_id", "left")
    )


def productivity_by_country(tables: Tables, scope: ReportScope) -> DataFrame:
    summary = _loaded_routes(tables, scope).groupBy("country").agg(*_productivity_measures())
    return summary.orderBy(F.desc("stops_efficiency_pct"), "country")


def network_productivity(tables: Tables, scope: ReportScope) -> DataFrame:
    """The same measures over all countries together, as ratios of sums."""
    return _loaded_routes(tables, scope).agg(*_productivity_measures())


def underperforming_by_country(
    tables: Tables, scope: ReportScope, below: float = LOW_STOPS_RATIO
) -> DataFrame:
    """Share of routes under the stops ratio; routes without a vehicle count too."""
    low = F.try_divide("actual_stops", "estimated_stops") < below
    routes = F.count_distinct("route_id")
    return (
        scope.routes(tables)
        .select("route_id", "center_id", low.alias("low"))
        .join(tables.distribution_centers.select("center_id", "country"), "center_id")
        .groupBy("country")
        .agg(
            routes.alias("total_completed_routes"),
            count_if(F.col("low")).alias("underperforming_routes_count"),
            safe_pct(count_if(F.col("low")), routes).alias("underperforming_pct"),
        )
        .orderBy(F.desc("underperforming_pct"), "country")
    )


def worst_routes(
    tables: Tables,
    scope: ReportScope,
    country: str,
    k: int = 5,
    below: float = LOW_STOPS_RATIO,
    keep_unassigned: bool = False,
) -> DataFrame:
    """The ``k`` routes of a country with the lowest stops efficiency.

    The top-k is settled on the route table alone, so only ``k`` routes meet the shipments.
    ``keep_unassigned`` also lists routes without a (known) vehicle.
    """
    ratio = F.try_divide("actual_stops", "estimated_stops")
    hubs = tables.distribution_centers.filter(F.col("country") == country)
    vehicles = tables.vehicle_types.select(
        "vehicle_type_id", "vehicle_type_name", "max_capacity_units"
    )
    order = [F.asc("stops_efficiency_pct"), F.desc("estimated_stops"), F.asc("route_id")]
    worst = (
        scope.routes(tables)
        .filter(ratio < below)
        .join(hubs.select("center_id"), "center_id")
        .join(vehicles, "vehicle_type_id", "left" if keep_unassigned else "inner")
        .join(tables.partners.select("partner_id", "partner_name"), "partner_id", "left")
        .select(
            "route_id",
            "partner_name",
            "vehicle_type_name",
            "estimated_stops",
            "actual_stops",
            safe_pct(F.col("actual_stops"), F.col("estimated_stops")).alias("stops_efficiency_pct"),
            F.col("max_capacity_units").alias("vehicle_capacity"),
        )
        .orderBy(*order)
        .limit(k)
    )
    # A shipment counts on the route of its latest record, so all records of any shipment that ever
    # touched one of the k routes take part; no other shipment can matter.
    touched = tables.shipments_new.join(worst.select("route_id"), "route_id", "left_semi")
    records = tables.shipments_new.join(touched.select("shipment_id"), "shipment_id", "left_semi")
    carried = (
        latest_shipments(records)
        .groupBy("route_id")
        .agg(F.count("shipment_id").alias("shipment_count"))
    )
    return (
        worst.join(carried, "route_id", "left")
        .select(
            "route_id",
            "partner_name",
            "vehicle_type_name",
            "estimated_stops",
            "actual_stops",
            "stops_efficiency_pct",
            F.coalesce("shipment_count", F.lit(0)).alias("shipments_carried"),
            "vehicle_capacity",
        )
        .orderBy(*order)
    )


def packages_per_stop(tables: Tables, scope: ReportScope) -> DataFrame:
    carried, stops = F.col("total_shipments_carried"), F.col("total_actual_stops")
    return productivity_by_country(tables, scope).select(
        "country",
        "total_shipments_carried",
        "total_actual_stops",
        F.round(F.try_divide(carried, stops), 4).alias("packages_per_stop"),
    )


def dedup_impact(tables: Tables, scope: ReportScope) -> DataFrame:
    """Shipments carried per country with and without keeping only the latest record."""
    raw = tables.shipments_new.groupBy("route_id").agg(F.count("shipment_id").alias("raw_count"))
    hubs = tables.distribution_centers.select("center_id", "country")
    raw_sum, kept_sum = F.sum("raw_count"), F.sum("shipment_count")
    return (
        scope.routes(tables)
        .select("route_id", "center_id")
        .join(hubs, "center_id")
        .join(raw, "route_id", "left")
        .join(shipments_per_route(tables), "route_id", "left")
        .groupBy("country")
        .agg(
            F.coalesce(raw_sum, F.lit(0)).alias("shipment_rows"),
            F.coalesce(kept_sum, F.lit(0)).alias("shipments_deduplicated"),
            (F.coalesce(raw_sum, F.lit(0)) - F.coalesce(kept_sum, F.lit(0))).alias("rows_removed"),
            safe_pct(raw_sum - F.coalesce(kept_sum, F.lit(0)), raw_sum).alias("rows_removed_pct"),
        )
    )
