"""The nine declared tables. A non-nullable field is a required column."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "string": StringType(),
    "long": LongType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampNTZType(),
}

#: Columns that arrive as clock times and are placed on ``route_date`` when loaded.
CLOCK_COLUMNS = {
    "routes": (
        "planned_route_start_time",
        "planned_route_end_time",
        "actual_route_start_time",
        "actual_route_end_time",
    ),
}


def _table(spec: str) -> StructType:
    fields = []
    for item in spec.split():
        name, kind = item.split(":")
        required = kind.endswith("!")
        fields.append(StructField(name, _TYPES[kind.rstrip("!")], nullable=not required))
    return StructType(fields)


_ROUTES = """
    route_id:string! partner_id:string vehicle_type_id:string center_id:string route_date:date
    route_type:string route_status:string
    planned_route_start_time:timestamp planned_route_end_time:timestamp
    actual_route_start_time:timestamp actual_route_end_time:timestamp
    route_distance_km:double estimated_stops:long actual_stops:long
"""

SCHEMAS: dict[str, StructType] = {
    "distribution_centers": _table("""
        center_id:string! center_name:string country:string region:string center_type:string
        active_flag:long operational_hours_start:long operational_hours_end:long
        max_daily_capacity_units:long established_date:date timezone_offset:long
    """),
    "partners": _table("""
        partner_id:string! partner_name:string partner_type:string country:string active_flag:long
        contract_start_date:date contract_end_date:date
        average_delivery_time_hours:double sla_compliance_pct:double
    """),
    "vehicle_types": _table("""
        vehicle_type_id:string! vehicle_type_name:string max_capacity_units:long fuel_type:string
        active_flag:long
    """),
    "routes": _table(_ROUTES),
    "routes_new": _table(_ROUTES),
    "shipments": _table("""
        shipment_id:string! route_id:string partner_id:string shipment_date:date
        shipment_status:string status_change_timestamp:timestamp delivery_attempt_count:long
        last_status_detail:string
    """),
    "shipments_new": _table("""
        shipment_id:string! route_id:string last_status_detail:string delivery_attempt_count:long
        status_change_timestamp:timestamp
    """),
    "shipment_events": _table("""
        event_id:string! shipment_id:string center_id:string event_type:string
        event_timestamp:timestamp event_hour_utc:long
    """),
    "shipment_events_new": _table("""
        event_id:string! shipment_id:string route_id:string event_type:string
        event_timestamp:timestamp event_hour_utc:long
    """),
}

PRIMARY_KEYS: dict[str, str] = {
    name: next(f.name for f in schema if not f.nullable) for name, schema in SCHEMAS.items()
}


def required_columns(table: str) -> list[str]:
    return [f.name for f in SCHEMAS[table] if not f.nullable]
