"""The registered queries in SQL, over the same derived tables."""

from __future__ import annotations

import re

START, END = "1996-01-01", "1999-12-31"

_NATION = "nation JOIN region ON n_regionkey = r_regionkey"


def _at(minutes: str) -> str:
    return f"day::TIMESTAMP + ({minutes}) * INTERVAL 1 MINUTE"


def _clock(minutes: str) -> str:
    m = f"((({minutes}) % 1440 + 1440) % 1440)"
    text = f"lpad(({m} // 60)::VARCHAR, 2, '0') || ':' || lpad(({m} % 60)::VARCHAR, 2, '0')"
    return f"{text} || ':00'"


def _control_at(minutes: str) -> str:
    return f"day::TIMESTAMP + ((({minutes}) % 1440 + 1440) % 1440) * INTERVAL 1 MINUTE"


_ROUTE_COLUMNS = """
    route_id, partner_id, vehicle_type_id, center_id, day AS route_date, route_type, route_status,
    {0} AS planned_route_start_time, {1} AS planned_route_end_time,
    {2} AS actual_route_start_time, {3} AS actual_route_end_time,
    route_distance_km, estimated_stops, actual_stops
"""

_ROUTE_MINUTES = ("planned_from", "planned_to", "actual_from", "actual_to")

CTES = {
    "distribution_centers": f"""
        SELECT 'DC-' || n_nationkey AS center_id, n_name AS center_name, r_name AS country,
               'Zone ' || (n_nationkey % 3) AS region,
               CASE WHEN n_nationkey % 2 = 0 THEN 'HUB' ELSE 'SPOKE' END AS center_type,
               (CASE WHEN n_nationkey % 8 = 5 THEN 2 WHEN n_nationkey % 8 = 6 THEN NULL
                     ELSE 1 END)::BIGINT AS active_flag,
               (6 + n_nationkey % 4)::BIGINT AS operational_hours_start,
               (18 + n_nationkey % 8)::BIGINT AS operational_hours_end,
               (1000 + 50 * n_nationkey)::BIGINT AS max_daily_capacity_units,
               DATE '2010-01-01' + (n_nationkey * 37)::INTEGER AS established_date,
               (-(3 + n_nationkey % 4))::BIGINT AS timezone_offset
        FROM {_NATION}""",
    "partners": f"""
        SELECT 'PT-' || s_suppkey AS partner_id, s_name AS partner_name,
               CASE WHEN s_suppkey % 3 = 0 THEN 'INTERNAL' ELSE 'EXTERNAL' END AS partner_type,
               r_name AS country,
               CASE WHEN s_suppkey % 50 = 7 THEN -1 WHEN s_suppkey % 10 = 3 THEN 0 ELSE 1 END
                   AS active_flag,
               DATE '1995-01-01' AS contract_start_date,
               CASE WHEN s_suppkey % 4 = 0 THEN DATE '1999-06-30' END AS contract_end_date,
               (s_suppkey % 40) / 2.0::DOUBLE AS average_delivery_time_hours,
               s_acctbal / 100.0::DOUBLE AS sla_compliance_pct
        FROM supplier JOIN ({_NATION}) ON s_nationkey = n_nationkey""",
    "vehicle_types": """
        SELECT p_brand AS vehicle_type_id, 'Van ' || p_brand AS vehicle_type_name,
               max(p_size)::BIGINT AS max_capacity_units,
               CASE substr(p_brand, 7)::BIGINT % 4 WHEN 0 THEN 'FUEL' WHEN 1 THEN 'ELECTRIC'
                    WHEN 2 THEN 'HUMAN' ELSE 'STEAM' END AS fuel_type,
               1::BIGINT AS active_flag
        FROM part GROUP BY p_brand""",
    "order_base": """
        SELECT o_orderkey AS k, o_orderdate::DATE AS day, 'RTE-' || o_orderkey AS route_id,
               CASE WHEN o_orderkey % 50 = 0 THEN NULL
                    WHEN o_orderkey % 97 = 0 THEN 'PT-X' || (o_orderkey % 5)
                    ELSE 'PT-' || (o_custkey % (SELECT count(*) FROM supplier)) END AS partner_id,
               CASE WHEN o_orderkey % 33 = 0 THEN NULL WHEN o_orderkey % 77 = 5 THEN 'Brand#99'
                    ELSE 'Brand#' || (1 + (o_orderkey * 7) % 25) END AS vehicle_type_id,
               'DC-' || c_nationkey AS center_id,
               CASE WHEN o_orderkey % 5 = 0 THEN 'PICKUP' ELSE 'DELIVERY' END AS route_type,
               CASE WHEN o_orderstatus = 'P' THEN 'IN_PROGRESS' ELSE 'COMPLETED' END
                   AS route_status,
               ((o_orderkey * 17) % 900 - 30) / 4.0::DOUBLE AS route_distance_km,
               5 + o_orderkey % 40 AS estimated_stops,
               360 + (o_orderkey * 37) % 360 AS planned_from
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "order_planned": "SELECT *, planned_from + 120 + (k * 53) % 480 AS planned_to FROM order_base",
    "order_started": """
        SELECT *, CASE WHEN k % 17 = 0 THEN NULL ELSE planned_from + (k * 7) % 90 END AS actual_from
        FROM order_planned""",
    "order_routes": """
        SELECT *,
               CASE WHEN k % 29 = 0 THEN actual_from - 30
                    ELSE planned_to + (k * 13) % 240 - 120 END AS actual_to,
               CASE WHEN k % 41 = 0 THEN estimated_stops * 2
                    ELSE (estimated_stops * (50 + (k * 11) % 60)) // 100 END AS actual_stops
        FROM order_started""",
    "routes_new": "SELECT "
    + _ROUTE_COLUMNS.format(*[_at(m) for m in _ROUTE_MINUTES])
    + " FROM order_routes",
    "routes": "SELECT "
    + _ROUTE_COLUMNS.format(*[_control_at(m) for m in _ROUTE_MINUTES])
    + " FROM order_routes",
    "shipped": """
        SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supplier_key,
               'SHP-' || l_orderkey || '-' || l_linenumber AS shipment_id,
               'RTE-' || (l_orderkey + l_partkey % 2) AS route_id,
               CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'delivered' END
                   AS last_status_detail,
               CASE WHEN l_partkey % 211 = 0 THEN -1 WHEN l_partkey % 223 = 0 THEN 12
                    ELSE l_quantity::BIGINT % 5 END AS delivery_attempt_count,
               l_shipdate::TIMESTAMP AS status_change_timestamp
        FROM lineitem""",
    "shipments_new": """
        SELECT shipment_id, route_id, last_status_detail, delivery_attempt_count,
               status_change_timestamp FROM shipped""",
    "shipments": """
        SELECT shipment_id || '-' || (part_key % 10) AS shipment_id, route_id,
               'PT-' || supplier_key AS partner_id, status_change_timestamp::DATE AS shipment_date,
               CASE WHEN last_status_detail = 'delivered' THEN 'CLOSED' ELSE 'OPEN' END
                   AS shipment_status,
               status_change_timestamp, delivery_attempt_count, last_status_detail
        FROM shipped""",
    "timed": "SELECT *, CASE WHEN event_id % 103 = 0 THEN NULL ELSE ts END AS stamp FROM events",
    "tracked": """
        SELECT event_id AS event_key, user_id, 'EVT-' || event_id AS event_id,
               'SHP-' || (event_id % ((SELECT count(*) FROM orders) + 500)) || '-'
                   || (1 + event_id % 7) AS shipment_id,
               'RTE-' || (event_id % (SELECT count(*) FROM orders)) AS route_id,
               CASE event_type WHEN 'purchase' THEN 'delivered' WHEN 'error' THEN 'delivery_attempt'
                    WHEN 'signup' THEN 'picked_up' ELSE 'in_transit' END AS event_type,
               stamp AS event_timestamp, hour(stamp) AS true_hour
        FROM timed""",
    "shipment_events_new": """
        SELECT event_id, shipment_id, route_id, event_type, event_timestamp,
               CASE WHEN true_hour >= 20 AND event_key % 50 <> 0 THEN 0
                    WHEN event_key % 31 = 0 THEN true_hour + 1 ELSE true_hour END AS event_hour_utc
        FROM tracked""",
    "shipment_events": """
        SELECT event_id, shipment_id, 'DC-' || (user_id % 25) AS center_id, event_type,
               event_timestamp,
               CASE WHEN event_key % 101 = 0 THEN NULL WHEN event_key % 97 = 0 THEN 0
                    ELSE true_hour END AS event_hour_utc
        FROM tracked""",
    # ---- shared steps of the reports
    "latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY
                status_change_timestamp DESC NULLS LAST, delivery_attempt_count DESC NULLS LAST,
                route_id DESC, last_status_detail DESC) AS rn
            FROM shipments_new) WHERE rn = 1""",
    "per_route": "SELECT route_id, count(shipment_id) AS shipment_count FROM latest GROUP BY 1",
    "scoped": f"""
        SELECT * FROM routes_new WHERE route_type = 'DELIVERY' AND route_status = 'COMPLETED'
            AND route_date BETWEEN DATE '{START}' AND DATE '{END}'""",
    "outcomes": """
        SELECT c.country, p.country AS partner_country, r.partner_id, p.partner_name,
               s.shipment_id, s.last_status_detail
        FROM latest s JOIN scoped r USING (route_id)
        JOIN distribution_centers c USING (center_id)
        LEFT JOIN partners p ON r.partner_id = p.partner_id""",
    "punctual": """
        SELECT *, hour(planned_route_end_time) AS planned_end_hour,
               actual_route_end_time <= planned_route_end_time AS end_ok,
               date_sub('minute', actual_route_start_time, actual_route_end_time)
                 <= date_sub('minute', planned_route_start_time, planned_route_end_time)
                 AS duration_ok
        FROM scoped
        WHERE actual_route_end_time >= actual_route_start_time
          AND planned_route_end_time >= planned_route_start_time""",
    "fleet_rows": """
        SELECT c.country, r.partner_id, p.partner_name, v.vehicle_type_name, r.planned_end_hour,
               r.route_date, r.route_id, r.end_ok, r.duration_ok
        FROM punctual r JOIN partners p USING (partner_id)
        JOIN vehicle_types v USING (vehicle_type_id)
        JOIN distribution_centers c USING (center_id)""",
    "deliveries": """
        SELECT c.country, c.timezone_offset, hour(e.event_timestamp) AS hour_utc,
               hour(e.event_timestamp + c.timezone_offset * INTERVAL 1 HOUR) AS hour_local,
               e.event_hour_utc AS logged
        FROM shipment_events_new e JOIN scoped r USING (route_id)
        JOIN distribution_centers c USING (center_id)
        WHERE e.event_type = 'delivered'""",
    "overlapping": """
        SELECT a.partner_id, a.route_date, a.route_id AS id_a, b.route_id AS id_b,
               a.center_id AS center_id_a, b.center_id AS center_id_b,
               a.vehicle_type_id AS vehicle_type_id_a, b.vehicle_type_id AS vehicle_type_id_b,
               a.actual_route_start_time AS start_a, b.actual_route_start_time AS start_b,
               a.actual_route_end_time AS end_a, b.actual_route_end_time AS end_b
        FROM routes_new a JOIN routes_new b
          ON a.partner_id = b.partner_id AND a.route_date = b.route_date AND a.route_id < b.route_id
        WHERE b.actual_route_start_time < a.actual_route_end_time
          AND b.actual_route_end_time > a.actual_route_start_time""",
}


def count_if(cond: str) -> str:
    return f"(count(*) FILTER (WHERE {cond}))::BIGINT"


def pct(num: str, den: str) -> str:
    return f"round(({num})::DOUBLE / nullif(({den}), 0) * 100, 2)"


def _needs(sql: str) -> list[str]:
    """The CTEs a statement refers to, each after the ones it builds on."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                ordered.append(name)

    visit(sql)
    return ordered


def with_tables(sql: str) -> str:
    parts = [f"{name} AS ({CTES[name]})" for name in _needs(sql)]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql
