"""The registered queries: each a report on the derived tables, with the same report in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from driver.oracles import END, START, count_if, pct, with_tables
from driver.standin import StandIn
from waybill.functions import cleaning
from waybill.functions.times import hour_of
from waybill.operators.latest import (
    SHIPMENT_ORDER,
    SHIPMENT_TIE_BREAK,
    latest_record,
    latest_record_agg,
)
from waybill.operators.overlap import overlap_counts, overlaps_per_interval
from waybill.operators.scope import ReportScope
from waybill.plans import audit, consistency, effectiveness, kpi, local_time, productivity
from waybill.plans import punctuality as oth
from waybill.plans.registry import run_metric
from waybill.sources import current, ingest, publish
from waybill.sources.schemas import PRIMARY_KEYS, SCHEMAS

SCOPE = ReportScope(start=START, end=END)
DATES = {"start_date": START, "end_date": END}
BOUNDS = f"BETWEEN DATE '{START}' AND DATE '{END}'"
CARRIER = "PT-7"
#: Stale routes alone exceed the usual limit in the derived data; this one splits the partners.
ERROR_LIMIT = 37.0


@dataclass(frozen=True)
class Query:
    build: Callable[[StandIn], DataFrame]
    sql: str

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain(self.build(StandIn(spark, folder)))

    def oracle(self) -> str:
        return with_tables(self.sql)


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, which both engines print alike."""
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, (DateType, TimestampNTZType)) else F.col(f.name)
        for f in df.schema
    ])


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str) -> Callable:
    def add(build: Callable[[StandIn], DataFrame]) -> Callable:
        QUERIES[name] = Query(build, sql)
        return build

    return add


# ---------------------------------------------------------------- productivity

_PRODUCTIVITY = f"""
    count(DISTINCT r.route_id)::BIGINT AS total_completed_routes,
    sum(r.estimated_stops)::BIGINT AS total_estimated_stops,
    sum(r.actual_stops)::BIGINT AS total_actual_stops,
    {pct("sum(r.actual_stops)", "sum(r.estimated_stops)")} AS stops_efficiency_pct,
    sum(s.shipment_count)::BIGINT AS total_shipments_carried,
    sum(v.max_capacity_units)::BIGINT AS total_max_capacity,
    {pct("sum(s.shipment_count)", "sum(v.max_capacity_units)")} AS capacity_utilization_pct
"""
_LOADED = """
    FROM scoped r JOIN distribution_centers c USING (center_id)
    JOIN vehicle_types v USING (vehicle_type_id)
    LEFT JOIN per_route s USING (route_id)
"""
_BY_COUNTRY = f"SELECT c.country, {_PRODUCTIVITY} {_LOADED} GROUP BY c.country"


@query("productivity_by_country", _BY_COUNTRY)
def _(s: StandIn) -> DataFrame:
    return productivity.productivity_by_country(s.tables(), SCOPE)


@query("tool_route_productivity", _BY_COUNTRY)
def _(s: StandIn) -> DataFrame:
    return run_metric(s.tables(), "route_productivity", **DATES)


@query(
    "underperforming_by_country",
    f"""SELECT c.country, count(DISTINCT r.route_id)::BIGINT AS total_completed_routes,
        {count_if("actual_stops / nullif(estimated_stops, 0) < 0.6")}
            AS underperforming_routes_count,
        {pct(count_if("actual_stops / nullif(estimated_stops, 0) < 0.6"),
             "count(DISTINCT r.route_id)")} AS underperforming_pct
    FROM scoped r JOIN distribution_centers c USING (center_id) GROUP BY c.country""",
)
def _(s: StandIn) -> DataFrame:
    return productivity.underperforming_by_country(s.tables(), SCOPE)


@query(
    "worst_routes",
    f"""SELECT r.route_id, p.partner_name, v.vehicle_type_name, r.estimated_stops, r.actual_stops,
        {pct("r.actual_stops", "r.estimated_stops")} AS stops_efficiency_pct,
        coalesce(s.shipment_count, 0)::BIGINT AS shipments_carried,
        v.max_capacity_units AS vehicle_capacity
    {_LOADED} LEFT JOIN partners p ON r.partner_id = p.partner_id
    WHERE c.country = 'ASIA' AND r.actual_stops / nullif(r.estimated_stops, 0) < 0.6
    ORDER BY stops_efficiency_pct, r.estimated_stops DESC, r.route_id LIMIT 5""",
)
def _(s: StandIn) -> DataFrame:
    return productivity.worst_routes(s.tables(), SCOPE, "ASIA")


@query(
    "packages_per_stop",
    f"""SELECT c.country, sum(s.shipment_count)::BIGINT AS total_shipments_carried,
        sum(r.actual_stops)::BIGINT AS total_actual_stops,
        round(sum(s.shipment_count)::DOUBLE / nullif(sum(r.actual_stops), 0), 4)
            AS packages_per_stop
    {_LOADED} GROUP BY c.country""",
)
def _(s: StandIn) -> DataFrame:
    return productivity.packages_per_stop(s.tables(), SCOPE)


@query(
    "dedup_impact",
    f"""SELECT c.country, coalesce(sum(w.n), 0)::BIGINT AS shipment_rows,
        coalesce(sum(s.shipment_count), 0)::BIGINT AS shipments_deduplicated,
        (coalesce(sum(w.n), 0) - coalesce(sum(s.shipment_count), 0))::BIGINT AS rows_removed,
        {pct("sum(w.n) - coalesce(sum(s.shipment_count), 0)", "sum(w.n)")} AS rows_removed_pct
    FROM scoped r JOIN distribution_centers c USING (center_id)
    LEFT JOIN (SELECT route_id, count(shipment_id) AS n FROM shipments_new GROUP BY 1) w
        USING (route_id)
    LEFT JOIN per_route s USING (route_id)
    GROUP BY c.country""",
)
def _(s: StandIn) -> DataFrame:
    return productivity.dedup_impact(s.tables(), SCOPE)


# ---------------------------------------------------------------- deduplication

_LATEST = """SELECT shipment_id, route_id, last_status_detail, delivery_attempt_count,
    status_change_timestamp::VARCHAR AS status_change_timestamp FROM latest"""


@query("dedup_latest", _LATEST)
def _(s: StandIn) -> DataFrame:
    return latest_record(s.shipments_new(), ["shipment_id"], SHIPMENT_ORDER, SHIPMENT_TIE_BREAK)


@query("dedup_latest_agg", _LATEST)
def _(s: StandIn) -> DataFrame:
    return latest_record_agg(s.shipments_new(), ["shipment_id"], SHIPMENT_ORDER, SHIPMENT_TIE_BREAK)


#: Two loads of the shipment records: the first holds every record stamped before this day and an
#: older state (a day earlier, in transit, no attempt) of every later one; the second the later ones.
LOAD_SPLIT = "1995-06-17"


def _current_from_two_loads(s: StandIn) -> DataFrame:
    records = s.shipments_new()
    later = F.col("status_change_timestamp") >= F.lit(LOAD_SPLIT).cast("timestamp_ntz")
    newer = records.where(later)
    older_state = newer.select(
        "shipment_id", "route_id", F.lit("in_transit").alias("last_status_detail"), F.lit(0).cast("long").alias("delivery_attempt_count"),
        (F.col("status_change_timestamp") - F.expr("INTERVAL 1 DAY")).alias("status_change_timestamp"),
    )
    first = records.where(~later | F.col("status_change_timestamp").isNull()).unionByName(older_state)
    name = f"shipments_current_{uuid.uuid4().hex[:12]}"
    current.create(first, name)
    return current.merge(newer, name)


@query("current_state_merge", _LATEST)
def _(s: StandIn) -> DataFrame:
    return _current_from_two_loads(s)


# ---------------------------------------------------------------- effectiveness

_SUCCESS = f"""count(shipment_id)::BIGINT AS total_shipments,
    {count_if("last_status_detail = 'delivered'")} AS delivered_shipments,
    {pct(count_if("last_status_detail = 'delivered'"), "count(shipment_id)")} AS success_rate_pct"""
_BY_PARTNER = f"""SELECT country, partner_id, partner_name, {_SUCCESS} FROM outcomes
    WHERE partner_name IS NOT NULL GROUP BY 1, 2, 3"""


@query("effectiveness_by_country", f"SELECT country, {_SUCCESS} FROM outcomes GROUP BY 1")
def _(s: StandIn) -> DataFrame:
    return effectiveness.effectiveness_by_country(s.tables(), SCOPE)


@query("effectiveness_by_country_current", f"SELECT country, {_SUCCESS} FROM outcomes GROUP BY 1")
def _(s: StandIn) -> DataFrame:
    tables = s.tables().replace(shipments_current=_current_from_two_loads(s))
    return effectiveness.effectiveness_by_country(tables, SCOPE)


@query(
    "effectiveness_partner_country",
    f"""SELECT partner_country AS country, {_SUCCESS} FROM outcomes
    WHERE partner_country IS NOT NULL GROUP BY 1""",
)
def _(s: StandIn) -> DataFrame:
    return effectiveness.effectiveness_by_country(s.tables(), SCOPE, country_of="partner")


@query("effectiveness_by_partner", _BY_PARTNER)
def _(s: StandIn) -> DataFrame:
    return effectiveness.effectiveness_by_partner(s.tables(), SCOPE)


@query("tool_delivery_effectiveness", _BY_PARTNER)
def _(s: StandIn) -> DataFrame:
    return run_metric(s.tables(), "delivery_effectiveness", **DATES)


@query(
    "effectiveness_outliers",
    _BY_PARTNER + " HAVING total_shipments < 100 OR success_rate_pct > 95 OR success_rate_pct < 70",
)
def _(s: StandIn) -> DataFrame:
    return effectiveness.effectiveness_outliers(s.tables(), SCOPE)


@query(
    "partner_extremes",
    f"""SELECT country, side, rank::BIGINT AS rank, partner_id, partner_name, total_shipments,
        success_rate_pct
    FROM (
        SELECT *, 'best' AS side, row_number() OVER (PARTITION BY country
            ORDER BY success_rate_pct DESC NULLS LAST, partner_id) AS rank FROM ({_BY_PARTNER})
        UNION ALL
        SELECT *, 'worst' AS side, row_number() OVER (PARTITION BY country
            ORDER BY success_rate_pct ASC NULLS LAST, partner_id) AS rank FROM ({_BY_PARTNER})
    ) WHERE rank <= 2""",
)
def _(s: StandIn) -> DataFrame:
    return effectiveness.partner_extremes(s.tables(), SCOPE, n=2)


@query(
    "homogeneity_check",
    f"""SELECT count(success_rate_pct)::BIGINT AS group_count, min(success_rate_pct) AS min_rate,
        max(success_rate_pct) AS max_rate,
        round(max(success_rate_pct) - min(success_rate_pct), 2) AS spread,
        round(stddev_samp(success_rate_pct), 4) AS stddev_rate,
        {count_if("abs(success_rate_pct - m) <= 5")} AS in_band_count
    FROM (SELECT *, avg(success_rate_pct) OVER () AS m FROM ({_BY_PARTNER}))""",
)
def _(s: StandIn) -> DataFrame:
    rates = effectiveness.effectiveness_by_partner(s.tables(), SCOPE)
    return effectiveness.homogeneity(rates, tolerance=5.0)


# ---------------------------------------------------------------- punctuality

_END_PCT = pct(count_if("end_ok"), "count(*)")
_DURATION_PCT = pct(count_if("duration_ok"), "count(*)")
_OTH = f"""count(route_id)::BIGINT AS total_routes, {count_if("end_ok")} AS on_time_end_count,
    {_END_PCT} AS oth_end_time_pct, {count_if("duration_ok")} AS on_time_duration_count,
    {_DURATION_PCT} AS oth_duration_pct,
    round({_DURATION_PCT} - {_END_PCT}, 2) AS oth_metric_gap"""
_FLEET = "country, partner_id, partner_name, vehicle_type_name"


def _by_fleet(where: str = "true") -> str:
    return f"SELECT {_FLEET}, {_OTH} FROM fleet_rows WHERE {where} GROUP BY {_FLEET}"


_BY_HOUR = f"""SELECT planned_end_hour::BIGINT AS planned_end_hour, {_OTH} FROM punctual
    GROUP BY planned_end_hour"""


@query("oth_by_fleet", _by_fleet())
def _(s: StandIn) -> DataFrame:
    return oth.oth_by_fleet(s.tables(), SCOPE)


@query("oth_by_hour", _BY_HOUR)
def _(s: StandIn) -> DataFrame:
    return oth.oth_by_hour(s.tables(), SCOPE)


@query(
    "tool_oth_schedule",
    f"""SELECT {_FLEET}, planned_end_hour::BIGINT AS planned_end_hour, {_OTH} FROM fleet_rows
    GROUP BY {_FLEET}, planned_end_hour""",
)
def _(s: StandIn) -> DataFrame:
    return run_metric(s.tables(), "oth_schedule", **DATES)


@query(
    "oth_underperforming",
    _by_fleet() + " HAVING oth_end_time_pct < 75 OR oth_duration_pct < 75",
)
def _(s: StandIn) -> DataFrame:
    return oth.oth_underperforming(s.tables(), SCOPE)


@query(
    "oth_top_gap",
    f"""SELECT * FROM ({_by_fleet()}) WHERE total_routes >= 3
    ORDER BY oth_metric_gap DESC, total_routes DESC, country, partner_id, vehicle_type_name
    LIMIT 10""",
)
def _(s: StandIn) -> DataFrame:
    return oth.oth_top_gap(s.tables(), SCOPE, k=10, min_routes=3)


@query(
    "report_format",
    f"""SELECT printf('%02d:00', planned_end_hour) AS planned_end_hour,
        format('{{:,}}', total_routes) AS total_routes,
        printf('%.2f%%', oth_end_time_pct) AS oth_end_time_pct,
        printf('%.2f%%', oth_duration_pct) AS oth_duration_pct,
        printf('%+.2f', oth_metric_gap) AS oth_metric_gap
    FROM ({_BY_HOUR})""",
)
def _(s: StandIn) -> DataFrame:
    report = oth.oth_by_hour(s.tables(), SCOPE).drop("on_time_end_count", "on_time_duration_count")
    return publish.formatted(report, {
        "planned_end_hour": "clock_hour",
        "total_routes": "thousands",
        "oth_end_time_pct": "percent",
        "oth_duration_pct": "percent",
        "oth_metric_gap": "signed",
    })


@query(
    "publish_idempotent",
    f"""SELECT {_FLEET}, route_date::VARCHAR AS route_date, {_OTH},
        strftime(route_date, '%Y-%m') AS route_month
    FROM fleet_rows GROUP BY {_FLEET}, route_date""",
)
def _(s: StandIn) -> DataFrame:
    """Publish, publish again, read back."""
    report = oth.oth_by_fleet(s.tables(), SCOPE, [*oth.FLEET_KEYS, "route_date"])
    report = report.withColumn("route_month", F.substring(F.col("route_date").cast("string"), 1, 7))
    path = f"{publish.work_folder(s.spark)}/oth"
    for _run in range(2):
        publish.publish_partitions(report, path, ["route_month"])
    return publish.read_published(s.spark, path, like=report)


@query(
    "publish_merge",
    f"""SELECT {_FLEET}, route_date::VARCHAR AS route_date,
        (total_routes + CASE WHEN route_date = DATE '1996-01-02' THEN 1000 ELSE 0 END)::BIGINT AS total_routes,
        on_time_end_count, oth_end_time_pct, on_time_duration_count, oth_duration_pct, oth_metric_gap, route_month
    FROM (SELECT {_FLEET}, route_date, {_OTH}, strftime(route_date, '%Y-%m') AS route_month
          FROM fleet_rows GROUP BY {_FLEET}, route_date)
    WHERE route_month NOT LIKE '1997-%'""",
)
def _(s: StandIn) -> DataFrame:
    """Publish all months; then merge a run over 1996-1997 that lacks 1997 and changes one day of 1996."""
    report = oth.oth_by_fleet(s.tables(), SCOPE, [*oth.FLEET_KEYS, "route_date"])
    report = report.withColumn("route_month", F.substring(F.col("route_date").cast("string"), 1, 7))
    keys = [*oth.FLEET_KEYS, "route_date"]
    path = f"{publish.work_folder(s.spark)}/oth"
    publish.merge_partitions(report, path, keys, ["route_month"])
    changed = F.col("route_date") == F.lit("1996-01-02").cast("date")
    second = report.where(F.col("route_month").between("1996-01", "1997-12") & ~F.col("route_month").startswith("1997-")).withColumn(
        "total_routes", (F.col("total_routes") + F.when(changed, 1000).otherwise(0)).cast("long")
    )
    publish.merge_partitions(second.where(changed), path, keys, ["route_month"])  # one changed key first
    publish.merge_partitions(second, path, keys, ["route_month"], period=("1996-01", "1997-12"))
    return publish.read_published(s.spark, path, like=report)


# ---------------------------------------------------------------- local time


def _late(source: str = "deliveries") -> str:
    utc, local, bad = "hour_utc >= 20", "hour_local >= 20", "logged = 0 AND hour_utc >= 20"
    return f"""SELECT country, timezone_offset, count(*)::BIGINT AS total_deliveries,
        {count_if(utc)} AS deliveries_utc_after_20,
        {pct(count_if(utc), "count(*)")} AS pct_utc_after_20,
        {count_if(local)} AS deliveries_local_after_20,
        {pct(count_if(local), "count(*)")} AS pct_local_after_20,
        {count_if(bad)} AS corrupt_records_count,
        {pct(count_if(bad), "count(*)")} AS corruption_pct
    FROM {source} GROUP BY 1, 2"""


@query("late_night_by_country", _late())
def _(s: StandIn) -> DataFrame:
    return local_time.late_night_by_country(s.tables(), SCOPE)


@query("tool_timezone_corruption", _late())
def _(s: StandIn) -> DataFrame:
    return run_metric(s.tables(), "timezone_corruption", **DATES)


@query(
    "local_hour_profile",
    """SELECT country, hour_local::BIGINT AS hour_local, count(*)::BIGINT AS events,
        hour_local >= 8 AND hour_local < 20 AS in_hours
    FROM deliveries WHERE hour_utc IS NOT NULL GROUP BY 1, 2, 4""",
)
def _(s: StandIn) -> DataFrame:
    return local_time.local_hour_profile(s.tables(), SCOPE)


_BAD_HOUR = "event_hour_utc = 0 AND hour(event_timestamp) >= 20"
_MATRIX = f"""SELECT hour(event_timestamp)::BIGINT AS true_hour_utc,
        event_hour_utc::BIGINT AS logged_hour_utc, count(*)::BIGINT AS total_events,
        {count_if(_BAD_HOUR)} AS corrupt_records,
        {pct(count_if(_BAD_HOUR), "count(*)")} AS corruption_pct
    FROM shipment_events_new {{where}} GROUP BY 1, 2"""


@query(
    "hour_corruption_matrix",
    f"""SELECT printf('%02d:00', true_hour_utc) AS true_hour_utc,
        printf('%02d:00', logged_hour_utc) AS logged_hour_utc,
        total_events, corrupt_records, corruption_pct
    FROM ({_MATRIX.format(where="")})""",
)
def _(s: StandIn) -> DataFrame:
    """All hours, also the unknown one, as clock text."""
    matrix = local_time.hour_corruption_matrix(s.tables())
    hours = {"true_hour_utc": "clock_hour", "logged_hour_utc": "clock_hour"}
    return publish.formatted(matrix, hours)


@query("hour_corruption_late", _MATRIX.format(where="WHERE hour(event_timestamp) >= 18"))
def _(s: StandIn) -> DataFrame:
    return local_time.hour_corruption_matrix(s.tables(), from_hour=18)


@query(
    "hour_corruption_overall",
    f"""SELECT count(*)::BIGINT AS total_rows, {count_if(_BAD_HOUR)} AS total_corrupt_rows,
        {pct(count_if(_BAD_HOUR), "count(*)")} AS overall_corruption_pct
    FROM shipment_events_new""",
)
def _(s: StandIn) -> DataFrame:
    return local_time.hour_corruption_overall(s.tables())


# ---------------------------------------------------------------- overlaps


@query(
    "overlap_pairs",
    f"""SELECT partner_id, route_date::VARCHAR AS route_date, route_id,
        count(*)::BIGINT AS overlaps, {count_if("center_id_a <> center_id_b")} AS multi_hub,
        {count_if("center_id_a <> center_id_b AND vehicle_type_id_a = vehicle_type_id_b")}
            AS impossible_vehicle
    FROM (SELECT *, unnest([id_a, id_b]) AS route_id FROM overlapping)
    GROUP BY ALL""",
)
def _(s: StandIn) -> DataFrame:
    return overlaps_per_interval(s.routes_new())


@query(
    "overlap_crowded",
    f"""SELECT a.partner_id, year(a.route_date)::BIGINT AS route_year,
        count(DISTINCT a.route_id)::BIGINT AS as_a, count(DISTINCT b.route_id)::BIGINT AS as_b,
        {count_if("a.center_id <> b.center_id")} AS multi_hub,
        {count_if("a.center_id <> b.center_id AND a.vehicle_type_id = b.vehicle_type_id")}
            AS impossible_vehicle
    FROM routes_new a JOIN routes_new b
      ON a.partner_id = b.partner_id AND year(a.route_date) = year(b.route_date)
     AND a.route_id < b.route_id
    WHERE b.actual_route_start_time < a.actual_route_end_time
      AND b.actual_route_end_time > a.actual_route_start_time
    GROUP BY ALL""",
)
def _(s: StandIn) -> DataFrame:
    routes = s.routes_new().withColumn("route_year", F.year("route_date").cast("long"))
    return overlap_counts(routes, keys=("partner_id", "route_year"), direct_up_to=0)


@query(
    "overlap_adjacent",
    f"""SELECT partner_id, {count_if("actual_route_end_time > following")} AS overlap_count
    FROM (SELECT partner_id, actual_route_end_time,
            lead(actual_route_start_time) OVER (PARTITION BY partner_id, route_date
                ORDER BY actual_route_start_time, route_id) AS following
          FROM routes_new
          WHERE partner_id IS NOT NULL AND actual_route_start_time IS NOT NULL
            AND actual_route_end_time IS NOT NULL)
    GROUP BY partner_id HAVING overlap_count > 0""",
)
def _(s: StandIn) -> DataFrame:
    return audit.adjacent_overlaps_by_partner(s.tables())


def _overlap_sums(*keys: str, where: str = "true") -> str:
    by = ", ".join(keys)
    return f"""SELECT {by},
        (count(DISTINCT id_a) + count(DISTINCT id_b))::BIGINT AS overlapping_routes_estimate,
        {count_if("center_id_a <> center_id_b")} AS multi_hub_overlaps_count,
        {count_if("center_id_a <> center_id_b AND vehicle_type_id_a = vehicle_type_id_b")}
            AS impossible_vehicle_allocations_count
    FROM overlapping WHERE {where} GROUP BY {by}"""


_ZEROED = """coalesce(overlapping_routes_estimate, 0) AS overlapping_routes_estimate,
    coalesce(multi_hub_overlaps_count, 0) AS multi_hub_overlaps_count,
    coalesce(impossible_vehicle_allocations_count, 0) AS impossible_vehicle_allocations_count"""


@query(
    "overlap_summary",
    f"""SELECT partner_id, {_ZEROED}
    FROM partners LEFT JOIN ({_overlap_sums("partner_id")}) USING (partner_id)""",
)
def _(s: StandIn) -> DataFrame:
    return consistency.overlap_summary(s.tables())


# ---------------------------------------------------------------- consistency

_STALE, _DONE = "route_status = 'IN_PROGRESS'", "route_status = 'COMPLETED'"
_INVERTED = f"{_DONE} AND actual_route_end_time < actual_route_start_time"
_UNTIMED = f"{_DONE} AND (actual_route_start_time IS NULL OR actual_route_end_time IS NULL)"
_EXPIRED = "route_date > contract_end_date OR active_flag = 0"
_QUARTER = "date_trunc('quarter', route_date)::DATE::VARCHAR"


def _profile(where: str = "true", period: str | None = None) -> str:
    total = "count(DISTINCT route_id)"
    first = f"{period} AS period, " if period else ""
    keys = "period, partner_id" if period else "partner_id"
    routes = f"""SELECT {first}r.*, p.partner_name, p.active_flag, p.contract_end_date
        FROM routes_new r JOIN partners p USING (partner_id) WHERE {where}"""
    sums = _overlap_sums(f"{period} AS period", "partner_id", where=where) if period else (
        _overlap_sums("partner_id", where=where)
    )
    if period:
        sums = sums.replace(f"GROUP BY {period} AS period", f"GROUP BY {period}")
    return f"""SELECT q.*, {_ZEROED} FROM (
        SELECT {keys}, partner_name, {total}::BIGINT AS total_routes_assigned,
            {count_if(_STALE)} AS stale_in_progress_count,
            {pct(count_if(_STALE), total)} AS stale_in_progress_pct,
            {count_if(_DONE)} AS completed_routes_count,
            {count_if(_INVERTED)} AS chrono_violations_count,
            {pct(count_if(_INVERTED), count_if(_DONE))} AS chrono_violations_pct,
            {count_if(_UNTIMED)} AS gps_sync_failures_count,
            {pct(count_if(_UNTIMED), count_if(_DONE))} AS gps_sync_failures_pct,
            {count_if(_EXPIRED)} AS contract_expired_routes_count,
            {pct(count_if(_EXPIRED), total)} AS contract_expired_routes_pct
        FROM ({routes}) GROUP BY {keys}, partner_name) q
    LEFT JOIN ({sums}) USING ({keys})"""


@query("consistency_profile", _profile())
def _(s: StandIn) -> DataFrame:
    return consistency.consistency_profile(s.tables())


@query(
    "tool_carrier_consistency",
    _profile(f"partner_id = '{CARRIER}' AND route_date {BOUNDS}"),
)
def _(s: StandIn) -> DataFrame:
    return run_metric(s.tables(), "carrier_consistency", partner_id=CARRIER, **DATES)


@query("consistency_all_partners", _profile(period=_QUARTER))
def _(s: StandIn) -> DataFrame:
    """Every partner and quarter, published by quarter and read back."""
    report = consistency.consistency_profile(s.tables(), period="quarter")
    path = f"{publish.work_folder(s.spark)}/consistency"
    publish.publish_partitions(report, path, ["period"])
    return publish.read_published(s.spark, path, like=report)


_EXCLUSION = f"""SELECT partner_id, errors::BIGINT AS combined_error_count,
        {pct("errors", "total_routes_assigned")} AS combined_error_pct,
        errors / total_routes_assigned * 100 > {{limit}} AS excluded
    FROM (SELECT *, stale_in_progress_count + chrono_violations_count
            + impossible_vehicle_allocations_count AS errors FROM ({_profile()}))"""


@query("partner_exclusion", _EXCLUSION.format(limit=5.0))
def _(s: StandIn) -> DataFrame:
    return consistency.partner_exclusion(s.tables())


@query(
    "oth_excluding_flagged",
    _by_fleet(
        f"partner_id NOT IN (SELECT partner_id FROM ({_EXCLUSION.format(limit=ERROR_LIMIT)}) "
        "WHERE excluded)"
    ),
)
def _(s: StandIn) -> DataFrame:
    tables = s.tables()
    flagged = consistency.flagged_partners(tables, ERROR_LIMIT)
    return oth.oth_by_fleet(tables, ReportScope(start=START, end=END, exclude_partners=flagged))


@query(
    "oth_excluding_deprecated",
    _by_fleet("partner_id NOT IN (SELECT partner_id FROM partners WHERE active_flag = -1)"),
)
def _(s: StandIn) -> DataFrame:
    tables = s.tables()
    deprecated = consistency.deprecated_partners(tables)
    return oth.oth_by_fleet(tables, ReportScope(start=START, end=END, exclude_partners=deprecated))


@query(
    "stale_closure",
    f"""SELECT partner_id, count(route_id)::BIGINT AS total_routes,
        {count_if(_STALE)} AS stale_routes_count,
        {pct(count_if(_STALE), "count(route_id)")} AS stale_routes_pct,
        {count_if(_DONE)} AS completed_routes_count,
        {pct(count_if(_DONE), "count(route_id)")} AS route_closure_rate
    FROM routes_new WHERE partner_id IS NOT NULL GROUP BY 1""",
)
def _(s: StandIn) -> DataFrame:
    return consistency.stale_closure(s.tables())


@query(
    "gps_chronology",
    f"""SELECT partner_id, count(route_id)::BIGINT AS total_routes,
        {count_if(_DONE)} AS completed_routes,
        {count_if(_INVERTED)} AS chrono_violations_count,
        {pct(count_if(_INVERTED), count_if(_DONE))} AS chrono_violations_pct,
        {count_if(_UNTIMED)} AS gps_sync_failures_count,
        {pct(count_if(_UNTIMED), count_if(_DONE))} AS gps_sync_failures_pct
    FROM routes_new WHERE partner_id IS NOT NULL GROUP BY 1""",
)
def _(s: StandIn) -> DataFrame:
    return consistency.gps_chronology(s.tables())


@query(
    "contract_violations",
    f"""SELECT partner_id, partner_name, contract_end_date::VARCHAR AS contract_end_date,
        count(route_id)::BIGINT AS routes_after_expiration_count,
        min(route_date)::VARCHAR AS earliest_violation_date,
        max(route_date)::VARCHAR AS latest_violation_date
    FROM routes_new JOIN partners USING (partner_id) WHERE {_EXPIRED}
    GROUP BY partner_id, partner_name, contract_end_date""",
)
def _(s: StandIn) -> DataFrame:
    return consistency.contract_violations(s.tables())


@query(
    "route_status_breakdown",
    """SELECT partner_id, route_status, count(*)::BIGINT AS total_routes,
        sum(estimated_stops)::BIGINT AS total_estimated_stops,
        sum(actual_stops)::BIGINT AS total_actual_stops,
        round(avg(route_distance_km), 2) AS avg_distance_km
    FROM routes_new WHERE partner_id IS NOT NULL GROUP BY 1, 2""",
)
def _(s: StandIn) -> DataFrame:
    return consistency.route_status_breakdown(s.tables())


@query(
    "partner_duplication",
    f"""SELECT r.partner_id, count(s.shipment_id)::BIGINT AS total_raw_shipments,
        count(DISTINCT s.shipment_id)::BIGINT AS unique_shipments,
        (count(s.shipment_id) - count(DISTINCT s.shipment_id))::BIGINT AS duplicate_count,
        {pct("count(s.shipment_id) - count(DISTINCT s.shipment_id)", "count(s.shipment_id)")}
            AS duplicate_pct
    FROM shipments_new s JOIN routes_new r USING (route_id)
    WHERE r.partner_id IS NOT NULL GROUP BY 1""",
)
def _(s: StandIn) -> DataFrame:
    return consistency.partner_duplication(s.tables())


# ---------------------------------------------------------------- network indicators


@query(
    "network_kpis",
    f"""SELECT
        (SELECT stops_efficiency_pct FROM (SELECT {_PRODUCTIVITY} {_LOADED}))
            AS stops_efficiency_pct,
        (SELECT capacity_utilization_pct FROM (SELECT {_PRODUCTIVITY} {_LOADED}))
            AS capacity_utilization_pct,
        (SELECT success_rate_pct FROM (SELECT {_SUCCESS} FROM outcomes)) AS success_rate_pct,
        (SELECT oth_end_time_pct FROM (SELECT {_OTH} FROM punctual)) AS oth_end_time_pct,
        (SELECT oth_duration_pct FROM (SELECT {_OTH} FROM punctual)) AS oth_duration_pct,
        (SELECT oth_metric_gap FROM (SELECT {_OTH} FROM punctual)) AS oth_metric_gap,
        (SELECT {pct(count_if(_BAD_HOUR), "count(*)")} FROM shipment_events_new)
            AS hour_corruption_pct,
        (SELECT {count_if("active_flag <> -1")} FROM partners) AS active_partners,
        (SELECT count(*)::BIGINT FROM partners) AS total_partners""",
)
def _(s: StandIn) -> DataFrame:
    return kpi.network_kpis(s.tables(), SCOPE)


@query(
    "network_kpis_filtered",
    f"""SELECT c.country, {_PRODUCTIVITY} {_LOADED}
    WHERE c.country IN ('ASIA', 'EUROPE') AND r.center_id <= 'DC-3'
      AND r.vehicle_type_id IN ('Brand#3', 'Brand#8', 'Brand#15', 'Brand#22')
      AND (r.partner_id IS NULL
           OR r.partner_id NOT IN (SELECT partner_id FROM partners WHERE active_flag = -1))
    GROUP BY c.country""",
)
def _(s: StandIn) -> DataFrame:
    tables = s.tables()
    scope = ReportScope(
        start=START,
        end=END,
        countries=["ASIA", "EUROPE"],
        centers=["DC-0", "DC-1", "DC-2", "DC-3", *[f"DC-{n}" for n in range(10, 25)]],
        vehicle_types=["Brand#3", "Brand#8", "Brand#15", "Brand#22"],
        exclude_partners=consistency.deprecated_partners(tables),
    )
    return kpi.country_kpis(tables, scope)


# ---------------------------------------------------------------- data quality


def _checked(label: str, name: str, table: str, errors: str, total: str = "count(*)") -> str:
    return f"""SELECT '{name}' AS {label}, ({total})::BIGINT AS total_records,
        ({errors})::BIGINT AS error_count, {pct(errors, total)} AS error_pct FROM {table}"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_DUPLICATES = "count(shipment_id) - count(DISTINCT shipment_id)"
_CHRONO = "actual_route_end_time < actual_route_start_time"
_WRONG_HOUR = "event_hour_utc <> hour(event_timestamp)"


@query(
    "audit_unified",
    _union([
        _checked("audit_check", "shipments_new PK Duplication", "shipments_new", _DUPLICATES,
                 "count(shipment_id)"),
        _checked("audit_check", "routes_new Chrono Violations", "routes_new", count_if(_CHRONO)),
        _checked("audit_check", "routes_new Missing Partners", "routes_new",
                 count_if("partner_id IS NULL")),
        _checked("audit_check", "shipment_events_new Hour Corruption",
                 "shipment_events_new WHERE event_timestamp IS NOT NULL", count_if(_WRONG_HOUR)),
        _checked("audit_check", "partners Deprecated Contracts", "partners",
                 count_if("active_flag = -1")),
    ]),
)
def _(s: StandIn) -> DataFrame:
    return audit.unified_audit(s.tables())


def _generation(name: str, suffix: str) -> list[str]:
    parts = [
        _checked("audit_check", "PK Duplication", f"shipments{suffix}", _DUPLICATES,
                 "count(shipment_id)"),
        _checked("audit_check", "Chrono Violations", f"routes{suffix}", count_if(_CHRONO)),
        _checked("audit_check", "Hour Corruption",
                 f"shipment_events{suffix} WHERE event_timestamp IS NOT NULL",
                 count_if(_WRONG_HOUR)),
    ]
    return [f"SELECT '{name}' AS generation, * FROM ({p})" for p in parts]


@query("audit_compare", _union(_generation("Control", "") + _generation("Production", "_new")))
def _(s: StandIn) -> DataFrame:
    return audit.compare_generations(s.tables())


@query(
    "dq_profile",
    _union([
        f"""SELECT '{t}' AS table_name, count(*)::BIGINT AS row_count,
            {len(schema)}::BIGINT AS column_count FROM {t}"""
        for t, schema in SCHEMAS.items()
    ]),
)
def _(s: StandIn) -> DataFrame:
    return audit.table_profile(s.tables())


@query(
    "dq_pk_duplication",
    _union([
        f"""SELECT '{t}' AS table_name, '{k}' AS key_column, count(*)::BIGINT AS total_records,
            count(DISTINCT {k})::BIGINT AS distinct_keys,
            (count(*) - count(DISTINCT {k}))::BIGINT AS duplicate_count,
            {pct(f"count(*) - count(DISTINCT {k})", "count(*)")} AS duplicate_pct FROM {t}"""
        for t, k in PRIMARY_KEYS.items()
    ]),
)
def _(s: StandIn) -> DataFrame:
    return audit.key_duplication(s.tables())


@query(
    "dq_null_profile",
    "SELECT * FROM (" + _union([
        f"""SELECT '{t}' AS table_name, '{f.name}' AS column_name,
            {count_if(f"{f.name} IS NULL")} AS null_count,
            {pct(count_if(f"{f.name} IS NULL"), "count(*)")} AS null_pct FROM {t}"""
        for t, schema in SCHEMAS.items() for f in schema
    ]) + ") WHERE null_count > 0",
)
def _(s: StandIn) -> DataFrame:
    return audit.null_profile(s.tables())


def _in_table(table: str, part: str) -> str:
    return f"SELECT '{table}' AS table_name, * FROM ({part})"


@query(
    "dq_domain",
    _union([
        _in_table("distribution_centers", _checked(
            "column_name", "active_flag", "distribution_centers",
            count_if("active_flag IS NULL OR active_flag NOT IN (0, 1)"))),
        _in_table("vehicle_types", _checked(
            "column_name", "fuel_type", "vehicle_types",
            count_if("fuel_type IS NULL OR fuel_type NOT IN ('FUEL', 'ELECTRIC', 'HUMAN')"))),
    ]),
)
def _(s: StandIn) -> DataFrame:
    return audit.domain_checks(s.tables())


_HOURS = ("operational_hours_start < 0 OR operational_hours_start > 23 "
          "OR operational_hours_end < 0 OR operational_hours_end > 23")
_RANGES = [
    ("distribution_centers", "timezone_offset beyond 12", "abs(timezone_offset) > 12"),
    ("distribution_centers", "operational hours outside 0-23", _HOURS),
    ("partners", "sla_compliance_pct outside 0-100",
     "sla_compliance_pct < 0 OR sla_compliance_pct > 100"),
    ("partners", "average_delivery_time_hours not above 0", "average_delivery_time_hours <= 0"),
    ("vehicle_types", "max_capacity_units not above 0", "max_capacity_units <= 0"),
]
for _suffix in ("", "_new"):
    _RANGES += [
        (f"routes{_suffix}", "route_distance_km below 0", "route_distance_km < 0"),
        (f"shipments{_suffix}", "delivery_attempt_count below 0", "delivery_attempt_count < 0"),
        (f"shipments{_suffix}", "delivery_attempt_count above 10", "delivery_attempt_count > 10"),
        (f"shipment_events{_suffix}", "event_hour_utc outside 0-23",
         "event_hour_utc < 0 OR event_hour_utc > 23"),
    ]


@query(
    "dq_range_rules",
    _union([_in_table(t, _checked("rule", rule, t, count_if(c))) for t, rule, c in _RANGES]),
)
def _(s: StandIn) -> DataFrame:
    return audit.range_checks(s.tables())


@query("dq_distinct_offsets", "SELECT DISTINCT timezone_offset FROM distribution_centers")
def _(s: StandIn) -> DataFrame:
    return audit.distinct_offsets(s.tables())


@query(
    "dq_stop_inflation",
    _union([
        _checked("table_name", t, t, count_if("actual_stops > estimated_stops * 1.5"))
        for t in ("routes", "routes_new")
    ]),
)
def _(s: StandIn) -> DataFrame:
    return audit.stop_inflation(s.tables())


def _orphans(child: str, column: str, parent: str) -> str:
    return f"""SELECT '{child}' AS table_name, '{column}' AS column_name,
        '{parent}' AS parent_table, count(*)::BIGINT AS orphan_keys, min(key) AS sample_key
    FROM (SELECT DISTINCT {column} AS key FROM {child} WHERE {column} IS NOT NULL) w
    WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = w.key)"""


@query(
    "dq_fk_orphans",
    _union([
        _orphans(child, column, parent)
        for suffix in ("", "_new")
        for child, column, parent in (
            (f"routes{suffix}", "partner_id", "partners"),
            (f"routes{suffix}", "vehicle_type_id", "vehicle_types"),
            (f"shipment_events{suffix}", "shipment_id", "shipments_new"),
        )
    ]),
)
def _(s: StandIn) -> DataFrame:
    return audit.orphan_report(s.tables())


@query(
    "unassigned_bucket",
    f"""SELECT coalesce(partner_id, 'UNASSIGNED') AS partner_id, count(*)::BIGINT AS total_routes,
        {count_if("vehicle_type_id IS NULL")} AS routes_without_vehicle,
        {count_if("partner_id IS NULL OR vehicle_type_id IS NULL")} AS unassigned_routes,
        {pct(count_if("partner_id IS NULL OR vehicle_type_id IS NULL"), "count(*)")}
            AS unassigned_pct
    FROM routes_new GROUP BY 1""",
)
def _(s: StandIn) -> DataFrame:
    return audit.unassigned_routes(s.tables())


@query(
    "dq_violation_sample",
    f"""SELECT route_id, actual_route_start_time::VARCHAR AS actual_route_start_time,
        actual_route_end_time::VARCHAR AS actual_route_end_time
    FROM routes_new WHERE {_CHRONO} ORDER BY route_id LIMIT 5""",
)
def _(s: StandIn) -> DataFrame:
    return audit.inverted_sample(s.tables())


_DAY = "status_change_timestamp::DATE"
_RAW_SHIPMENTS = f"""
    SELECT CASE WHEN order_key % 5 = 0
                THEN day({_DAY}) || '/' || month({_DAY}) || '/' || year({_DAY})
                ELSE {_DAY}::VARCHAR END AS shipment_date,
           CASE WHEN part_key % 7 <> 0
                THEN {_DAY}::VARCHAR || ' ' || lpad((part_key % 24)::VARCHAR, 2, '0') || ':00:00'
                END AS status_change_timestamp
    FROM shipped"""


def _patterns(column: str) -> str:
    return f"""SELECT 'shipments' AS table_name, '{column}' AS column_name, pattern,
        count(*)::BIGINT AS row_count,
        {pct("count(*)", "sum(count(*)) OVER ()")} AS pct
    FROM (SELECT regexp_replace({column}, '[0-9]', 'N', 'g') AS pattern FROM ({_RAW_SHIPMENTS})
          WHERE {column} IS NOT NULL)
    GROUP BY pattern"""


@query(
    "dq_format_patterns", _union([_patterns("shipment_date"), _patterns("status_change_timestamp")])
)
def _(s: StandIn) -> DataFrame:
    return audit.text_formats(
        {"shipments": s.raw_shipments()},
        {"shipments": ["shipment_date", "status_change_timestamp"]},
    )


# ---------------------------------------------------------------- cleaning and ingestion


@query(
    "clean_dates",
    """SELECT route_id, day::VARCHAR AS route_date,
        CASE WHEN k % 89 <> 3 THEN (day::TIMESTAMP + planned_from * INTERVAL 1 MINUTE)::VARCHAR END
            AS planned_route_start_time
    FROM order_routes""",
)
def _(s: StandIn) -> DataFrame:
    started = cleaning.parse_timestamp(F.col("planned_route_start_time"))
    return s.raw_routes().select(
        "route_id",
        cleaning.iso_date(cleaning.parse_date(F.col("route_date"))).alias("route_date"),
        cleaning.iso_timestamp(started).alias("planned_route_start_time"),
    )


@query(
    "clean_time",
    """SELECT route_id, strftime(actual_route_start_time, '%H:%M:%S') AS actual_route_start_time,
        strftime(planned_route_end_time, '%H:%M:%S') AS planned_route_end_time
    FROM routes""",
)
def _(s: StandIn) -> DataFrame:
    return s.raw_control_routes().select("route_id", *[
        cleaning.complete_time(F.col(c)).alias(c)
        for c in ("actual_route_start_time", "planned_route_end_time")
    ])


@query(
    "clean_numeric",
    """SELECT route_id, CASE WHEN k % 127 <> 3 THEN estimated_stops::VARCHAR END
            AS estimated_stops, actual_stops::DOUBLE AS actual_stops FROM order_routes""",
)
def _(s: StandIn) -> DataFrame:
    return s.raw_routes().select(
        "route_id",
        cleaning.parse_long(F.col("estimated_stops")).cast("string").alias("estimated_stops"),
        cleaning.parse_double(F.col("actual_stops")).alias("actual_stops"),
    )


@query(
    "clean_event_hour",
    """SELECT event_id, hour(event_timestamp)::BIGINT AS event_hour_utc
    FROM shipment_events_new WHERE event_timestamp IS NOT NULL""",
)
def _(s: StandIn) -> DataFrame:
    events = s.shipment_events_new().filter(F.col("event_timestamp").isNotNull())
    return events.select("event_id", hour_of(F.col("event_timestamp")).alias("event_hour_utc"))


@query(
    "ingest_align",
    """SELECT route_id, partner_id, vehicle_type_id, center_id, route_date::VARCHAR AS route_date,
        route_type, route_status,
        CASE WHEN k % 89 <> 3 THEN planned_route_start_time::VARCHAR END
            AS planned_route_start_time,
        planned_route_end_time::VARCHAR AS planned_route_end_time,
        actual_route_start_time::VARCHAR AS actual_route_start_time,
        actual_route_end_time::VARCHAR AS actual_route_end_time,
        CAST(NULL AS DOUBLE) AS route_distance_km,
        CASE WHEN k % 127 <> 3 THEN estimated_stops::VARCHAR END AS estimated_stops, actual_stops
    FROM (SELECT r.*, substr(route_id, 5)::BIGINT AS k FROM routes_new r)""",
)
def _(s: StandIn) -> DataFrame:
    typed = ingest.clean(ingest.align(s.raw_routes(), "routes_new"), "routes_new")
    return typed.withColumn("estimated_stops", F.col("estimated_stops").cast("string"))


@query(
    "ingest_rejects",
    "SELECT 'routes_new' AS table_name, column_name, rejected FROM (" + _union([
        f"SELECT '{f.name}' AS column_name, "
        + {
            "planned_route_start_time": count_if("k % 89 = 3"),
            "estimated_stops": count_if("k % 127 = 3"),
        }.get(f.name, "0::BIGINT")
        + " AS rejected FROM order_routes"
        + ("" if f.name in ("planned_route_start_time", "estimated_stops") else " LIMIT 1")
        for f in SCHEMAS["routes_new"]
    ]).replace("LIMIT 1", "GROUP BY 1") + ")",
)
def _(s: StandIn) -> DataFrame:
    return ingest.rejects(ingest.align(s.raw_routes(), "routes_new"), "routes_new")


@query(
    "ingest_reconcile",
    _union([
        """SELECT 'routes_new' AS table_name, 'loaded' AS status, count(*)::BIGINT AS rows_read,
            count(*)::BIGINT AS rows_written, 0::BIGINT AS rejected FROM order_routes""",
        """SELECT 'partners', 'loaded', count(*)::BIGINT, count(*)::BIGINT, 0::BIGINT
            FROM partners""",
        "SELECT 'vehicle_types', 'missing', 0::BIGINT, 0::BIGINT, 0::BIGINT",
        "SELECT 'shipment_events_new', 'failed', 0::BIGINT, 0::BIGINT, 0::BIGINT",
    ]),
)
def _(s: StandIn) -> DataFrame:
    """Write CSV exports, one of them faulty and one absent, and load them."""
    folder = publish.work_folder(s.spark)
    source, target = f"{folder}/csv", f"{folder}/tables"
    faulty = s.shipment_events_new().withColumn("event_hour_utc", F.lit("late"))
    publish.write_csv(s.raw_routes(faults=False), f"{source}/routes_new.csv")
    publish.write_csv(s.partners(), f"{source}/partners.csv")
    publish.write_csv(faulty, f"{source}/shipment_events_new.csv")
    names = ["partners", "vehicle_types", "routes_new", "shipment_events_new"]
    outcomes = ingest.load_all(s.spark, source, target, names)
    frame = ingest.outcomes_frame(s.spark, outcomes)
    return frame.drop("message").fillna(0)
