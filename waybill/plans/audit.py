"""Data-quality reports over the logistics tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import count_if, safe_pct
from waybill.functions.times import hour_mismatch
from waybill.operators import checks
from waybill.operators.checks import Check, labelled, run_checks
from waybill.operators.overlap import adjacent_overlaps
from waybill.sources.schemas import PRIMARY_KEYS
from waybill.sources.tables import Tables

MAX_STOP_RATIO = 1.5
UNASSIGNED = "UNASSIGNED"

# Fixed values of the domain.
CENTER_FLAGS = (0, 1)
FUEL_TYPES = ("FUEL", "ELECTRIC", "HUMAN")


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def inverted() -> Column:
    return F.col("actual_route_end_time") < F.col("actual_route_start_time")


def _wrong_hour() -> Column:
    return hour_mismatch(F.col("event_hour_utc"), F.col("event_timestamp"))


def unified_audit(tables: Tables) -> DataFrame:
    timed = F.col("event_timestamp").isNotNull()
    per_table = [
        run_checks(
            tables.shipments_new,
            [Check.duplicates("shipments_new PK Duplication", "shipment_id")],
        ),
        run_checks(
            tables.routes_new,
            [
                Check.rows("routes_new Chrono Violations", inverted()),
                Check.rows("routes_new Missing Partners", F.col("partner_id").isNull()),
            ],
        ),
        run_checks(
            tables.shipment_events_new,
            [Check.rows("shipment_events_new Hour Corruption", _wrong_hour(), timed)],
        ),
        run_checks(
            tables.partners,
            [Check.rows("partners Deprecated Contracts", F.col("active_flag") == -1)],
        ),
    ]
    return _stack(per_table).orderBy(F.desc("error_pct"), "audit_check")


def compare_generations(tables: Tables) -> DataFrame:
    """The same three checks over the control and the production tables."""
    timed = F.col("event_timestamp").isNotNull()
    frames = []
    for generation, suffix in (("Control", ""), ("Production", "_new")):
        found = [
            run_checks(tables[f"shipments{suffix}"],
                       [Check.duplicates("PK Duplication", "shipment_id")]),
            run_checks(tables[f"routes{suffix}"], [Check.rows("Chrono Violations", inverted())]),
            run_checks(tables[f"shipment_events{suffix}"],
                       [Check.rows("Hour Corruption", _wrong_hour(), timed)]),
        ]
        frames += [labelled(f, {"generation": generation}) for f in found]
    return _stack(frames).orderBy(F.desc("error_pct"), "audit_check", "generation")


def table_profile(tables: Tables) -> DataFrame:
    return _stack(
        tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(tables[name].columns)).cast("long").alias("column_count"),
        )
        for name in tables.names()
    )


def key_duplication(tables: Tables) -> DataFrame:
    return _stack(
        labelled(
            checks.key_duplication(tables[name], PRIMARY_KEYS[name]),
            {"table_name": name, "key_column": PRIMARY_KEYS[name]},
        )
        for name in tables.names()
    )


def null_profile(tables: Tables) -> DataFrame:
    return _stack(
        labelled(checks.null_profile(tables[name]), {"table_name": name})
        for name in tables.names()
    )


def domain_checks(tables: Tables) -> DataFrame:
    rules = {
        "distribution_centers": ("active_flag", CENTER_FLAGS),
        "vehicle_types": ("fuel_type", FUEL_TYPES),
    }
    return _stack(
        labelled(
            run_checks(
                tables[name],
                [Check.rows(column, checks.not_in_domain(F.col(column), allowed))],
                label="column_name",
            ),
            {"table_name": name},
        )
        for name, (column, allowed) in rules.items()
    )


def _range_rules() -> dict[str, dict[str, Column]]:
    def outside(column: str, low: int, high: int) -> Column:
        return (F.col(column) < low) | (F.col(column) > high)

    routes = {"route_distance_km below 0": F.col("route_distance_km") < 0}
    shipments = {
        "delivery_attempt_count below 0": F.col("delivery_attempt_count") < 0,
        "delivery_attempt_count above 10": F.col("delivery_attempt_count") > 10,
    }
    events = {"event_hour_utc outside 0-23": outside("event_hour_utc", 0, 23)}
    return {
        "distribution_centers": {
            "timezone_offset beyond 12": F.abs("timezone_offset") > 12,
            "operational hours outside 0-23": outside("operational_hours_start", 0, 23)
            | outside("operational_hours_end", 0, 23),
        },
        "partners": {
            "sla_compliance_pct outside 0-100": outside("sla_compliance_pct", 0, 100),
            "average_delivery_time_hours not above 0": F.col("average_delivery_time_hours") <= 0,
        },
        "vehicle_types": {"max_capacity_units not above 0": F.col("max_capacity_units") <= 0},
        "routes": routes,
        "routes_new": routes,
        "shipments": shipments,
        "shipments_new": shipments,
        "shipment_events": events,
        "shipment_events_new": events,
    }


def range_checks(tables: Tables) -> DataFrame:
    return _stack(
        labelled(
            run_checks(
                tables[name], [Check.rows(rule, c) for rule, c in rules.items()], label="rule"
            ),
            {"table_name": name},
        )
        for name, rules in _range_rules().items()
        if name in tables
    )


def distinct_offsets(tables: Tables) -> DataFrame:
    return tables.distribution_centers.select("timezone_offset").distinct()


def inflated_stops() -> Column:
    return F.col("actual_stops") > F.col("estimated_stops") * MAX_STOP_RATIO


def stop_inflation(tables: Tables) -> DataFrame:
    return _stack(
        run_checks(tables[name], [Check.rows(name, inflated_stops())], label="table_name")
        for name in ("routes", "routes_new")
        if name in tables
    )


_REFERENCES = (
    ("routes", "partner_id", "partners", "partner_id"),
    ("routes", "vehicle_type_id", "vehicle_types", "vehicle_type_id"),
    ("routes_new", "partner_id", "partners", "partner_id"),
    ("routes_new", "vehicle_type_id", "vehicle_types", "vehicle_type_id"),
    ("shipment_events", "shipment_id", "shipments_new", "shipment_id"),
    ("shipment_events_new", "shipment_id", "shipments_new", "shipment_id"),
)


def orphan_report(tables: Tables) -> DataFrame:
    """Distinct keys without a parent per reference, with the first of them as a sample."""
    return _stack(
        labelled(
            checks.orphan_keys(tables[child], column, tables[parent], key).agg(
                F.count("key").alias("orphan_keys"), F.min("key").alias("sample_key")
            ),
            {"table_name": child, "column_name": column, "parent_table": parent},
        )
        for child, column, parent, key in _REFERENCES
        if child in tables and parent in tables
    )


def unassigned_routes(tables: Tables) -> DataFrame:
    """Routes per partner with a bucket of their own for routes without one."""
    no_partner, no_vehicle = F.col("partner_id").isNull(), F.col("vehicle_type_id").isNull()
    return tables.routes_new.groupBy(
        F.coalesce("partner_id", F.lit(UNASSIGNED)).alias("partner_id")
    ).agg(
        F.count(F.lit(1)).alias("total_routes"),
        count_if(no_vehicle).alias("routes_without_vehicle"),
        count_if(no_partner | no_vehicle).alias("unassigned_routes"),
        safe_pct(count_if(no_partner | no_vehicle), F.count(F.lit(1))).alias("unassigned_pct"),
    )


def inverted_sample(tables: Tables, n: int = 5) -> DataFrame:
    columns = ["route_id", "actual_route_start_time", "actual_route_end_time"]
    return checks.violation_sample(tables.routes_new, inverted(), columns, ["route_id"], n)


def adjacent_overlaps_by_partner(tables: Tables) -> DataFrame:
    return (
        adjacent_overlaps(tables.routes_new)
        .groupBy("partner_id")
        .agg(F.sum("overlap_count").alias("overlap_count"))
    )


def text_formats(frames: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """Digit patterns of text columns: ``columns`` lists them per frame."""
    return _stack(
        labelled(
            checks.format_patterns(frames[name], column),
            {"table_name": name, "column_name": column},
        )
        for name, wanted in columns.items()
        for column in wanted
    )
