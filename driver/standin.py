"""Logistics tables derived from the given TPC-H-like tables by fixed integer formulas.

The formulas put in what the reports look for: repeated shipments, inverted and missing times,
overlaps, unknown and absent references, odd flags, truncated hours. ``oracles.py`` states the same
formulas in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import cleaning
from waybill.sources.tables import Tables


GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def _columns(df: DataFrame, **exprs: str) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in exprs.items()])


class StandIn:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            reader = self.spark.read.schema(GIVEN[name])
            self._given[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._given[name]

    def _count(self, name: str):
        return self.given(name).agg(F.count(F.lit(1)).alias("n")).scalar()

    def tables(self) -> Tables:
        return Tables({
            "distribution_centers": self.distribution_centers,
            "partners": self.partners,
            "vehicle_types": self.vehicle_types,
            "routes": self.routes,
            "routes_new": self.routes_new,
            "shipments": self.shipments,
            "shipments_new": self.shipments_new,
            "shipment_events": self.shipment_events,
            "shipment_events_new": self.shipment_events_new,
        })

    def distribution_centers(self) -> DataFrame:
        joined = self.given("nation").join(
            self.given("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return _columns(
            joined.withColumn("n", F.col("n_nationkey").cast("long")),
            center_id="concat('DC-', n)",
            center_name="n_name",
            country="r_name",
            region="concat('Zone ', n % 3)",
            center_type="if(n % 2 = 0, 'HUB', 'SPOKE')",
            active_flag="case when n % 8 = 5 then 2L when n % 8 = 6 then null else 1L end",
            operational_hours_start="6 + n % 4",
            operational_hours_end="18 + n % 8",
            max_daily_capacity_units="1000 + 50 * n",
            established_date="date_add(date'2010-01-01', cast(n * 37 as int))",
            timezone_offset="-(3 + n % 4)",
        )

    def partners(self) -> DataFrame:
        nations = self.given("nation").join(
            self.given("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        joined = self.given("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        return _columns(
            joined,
            partner_id="concat('PT-', s_suppkey)",
            partner_name="s_name",
            partner_type="if(s_suppkey % 3 = 0, 'INTERNAL', 'EXTERNAL')",
            country="r_name",
            active_flag="case when s_suppkey % 50 = 7 then -1L when s_suppkey % 10 = 3 then 0L "
            "else 1L end",
            contract_start_date="date'1995-01-01'",
            contract_end_date="if(s_suppkey % 4 = 0, date'1999-06-30', null)",
            average_delivery_time_hours="(s_suppkey % 40) / 2D",
            sla_compliance_pct="s_acctbal / 100D",
        )

    def vehicle_types(self) -> DataFrame:
        brands = self.given("part").groupBy("p_brand").agg(
            F.max("p_size").cast("long").alias("capacity")
        )
        number = "cast(substr(p_brand, 7) as bigint)"
        return _columns(
            brands,
            vehicle_type_id="p_brand",
            vehicle_type_name="concat('Van ', p_brand)",
            max_capacity_units="capacity",
            fuel_type=f"case {number} % 4 when 0 then 'FUEL' when 1 then 'ELECTRIC' "
            "when 2 then 'HUMAN' else 'STEAM' end",
            active_flag="1L",
        )

    @cached_property
    def _orders(self) -> DataFrame:
        """Orders with their hub and, in minutes of the day, the four times of the route."""
        customer = self.given("customer").select("c_custkey", "c_nationkey")
        orders = self.given("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        based = orders.withColumn("n_suppliers", self._count("supplier")).select(
            F.col("o_orderkey").alias("k"),
            F.col("o_orderdate").cast("date").alias("day"),
            F.expr("concat('RTE-', o_orderkey)").alias("route_id"),
            F.expr(
                "case when o_orderkey % 50 = 0 then null "
                "when o_orderkey % 97 = 0 then concat('PT-X', o_orderkey % 5) "
                "else concat('PT-', o_custkey % n_suppliers) end"
            ).alias("partner_id"),
            F.expr(
                "case when o_orderkey % 33 = 0 then null when o_orderkey % 77 = 5 then 'Brand#99' "
                "else concat('Brand#', 1 + (o_orderkey * 7) % 25) end"
            ).alias("vehicle_type_id"),
            F.expr("concat('DC-', c_nationkey)").alias("center_id"),
            F.expr("if(o_orderkey % 5 = 0, 'PICKUP', 'DELIVERY')").alias("route_type"),
            F.expr("if(o_orderstatus = 'P', 'IN_PROGRESS', 'COMPLETED')").alias("route_status"),
            F.expr("((o_orderkey * 17) % 900 - 30) / 4D").alias("route_distance_km"),
            F.expr("5 + o_orderkey % 40").alias("estimated_stops"),
            F.expr("360 + (o_orderkey * 37) % 360").alias("planned_from"),
        )
        planned = based.withColumn("planned_to", F.expr("planned_from + 120 + (k * 53) % 480"))
        started = planned.withColumn(
            "actual_from", F.expr("if(k % 17 = 0, null, planned_from + (k * 7) % 90)")
        )
        return started.withColumn(
            "actual_to",
            F.expr("if(k % 29 = 0, actual_from - 30, planned_to + (k * 13) % 240 - 120)"),
        ).withColumn(
            "actual_stops",
            F.expr(
                "if(k % 41 = 0, estimated_stops * 2, (estimated_stops * (50 + (k * 11) % 60)) div 100)"
            ),
        )

    def routes_new(self) -> DataFrame:
        def at(minutes: str) -> str:
            return f"timestampadd(MINUTE, {minutes}, cast(day as timestamp_ntz))"

        return _columns(
            self._orders,
            route_id="route_id",
            partner_id="partner_id",
            vehicle_type_id="vehicle_type_id",
            center_id="center_id",
            route_date="day",
            route_type="route_type",
            route_status="route_status",
            planned_route_start_time=at("planned_from"),
            planned_route_end_time=at("planned_to"),
            actual_route_start_time=at("actual_from"),
            actual_route_end_time=at("actual_to"),
            route_distance_km="route_distance_km",
            estimated_stops="estimated_stops",
            actual_stops="actual_stops",
        )

    def raw_control_routes(self) -> DataFrame:
        """The control export: clock times as text, wrapping at midnight, some without seconds."""

        def clock(minutes: str) -> str:
            m = f"pmod({minutes}, 1440)"
            text = f"concat(lpad({m} div 60, 2, '0'), ':', lpad({m} % 60, 2, '0'))"
            return f"if(k % 2 = 0, concat({text}, ':00'), concat(' ', {text}))"

        return _columns(
            self._orders,
            route_id="route_id",
            partner_id="partner_id",
            vehicle_type_id="vehicle_type_id",
            center_id="center_id",
            route_date="day",
            route_type="route_type",
            route_status="route_status",
            planned_route_start_time=clock("planned_from"),
            planned_route_end_time=clock("planned_to"),
            actual_route_start_time=clock("actual_from"),
            actual_route_end_time=clock("actual_to"),
            route_distance_km="route_distance_km",
            estimated_stops="estimated_stops",
            actual_stops="actual_stops",
        )

    def routes(self) -> DataFrame:
        raw = self.raw_control_routes()
        return raw.select(*[
            cleaning.time_on_date(F.col("route_date"), F.col(c)).alias(c)
            if c.endswith("_time") else F.col(c)
            for c in raw.columns
        ])

    @cached_property
    def _shipped(self) -> DataFrame:
        return _columns(
            self.given("lineitem"),
            order_key="l_orderkey",
            part_key="l_partkey",
            supplier_key="l_suppkey",
            shipment_id="concat('SHP-', l_orderkey, '-', l_linenumber)",
            route_id="concat('RTE-', l_orderkey + l_partkey % 2)",
            last_status_detail="if(l_returnflag = 'R', 'returned', 'delivered')",
            delivery_attempt_count="case when l_partkey % 211 = 0 then -1L "
            "when l_partkey % 223 = 0 then 12L else cast(l_quantity as bigint) % 5 end",
            status_change_timestamp="cast(l_shipdate as timestamp_ntz)",
        )

    def shipments_new(self) -> DataFrame:
        return self._shipped.select(
            "shipment_id",
            "route_id",
            "last_status_detail",
            "delivery_attempt_count",
            "status_change_timestamp",
        )

    def shipments(self) -> DataFrame:
        return _columns(
            self._shipped,
            shipment_id="concat(shipment_id, '-', part_key % 10)",
            route_id="route_id",
            partner_id="concat('PT-', supplier_key)",
            shipment_date="cast(status_change_timestamp as date)",
            shipment_status="if(last_status_detail = 'delivered', 'CLOSED', 'OPEN')",
            status_change_timestamp="status_change_timestamp",
            delivery_attempt_count="delivery_attempt_count",
            last_status_detail="last_status_detail",
        )

    @cached_property
    def _tracked(self) -> DataFrame:
        counted = self.given("events").withColumn("n_orders", self._count("orders"))
        timed = counted.withColumn("at", F.expr("if(event_id % 103 = 0, null, ts)"))
        return _columns(
            timed,
            event_key="event_id",
            user_id="user_id",
            event_id="concat('EVT-', event_id)",
            shipment_id="concat('SHP-', event_id % (n_orders + 500), '-', 1 + event_id % 7)",
            route_id="concat('RTE-', event_id % n_orders)",
            event_type="case event_type when 'purchase' then 'delivered' "
            "when 'error' then 'delivery_attempt' when 'signup' then 'picked_up' "
            "else 'in_transit' end",
            event_timestamp="at",
            true_hour="cast(hour(at) as bigint)",
        )

    def shipment_events_new(self) -> DataFrame:
        return _columns(
            self._tracked,
            event_id="event_id",
            shipment_id="shipment_id",
            route_id="route_id",
            event_type="event_type",
            event_timestamp="event_timestamp",
            event_hour_utc="case when true_hour >= 20 and event_key % 50 <> 0 then 0L "
            "when event_key % 31 = 0 then true_hour + 1 else true_hour end",
        )

    def shipment_events(self) -> DataFrame:
        return _columns(
            self._tracked,
            event_id="event_id",
            shipment_id="shipment_id",
            center_id="concat('DC-', user_id % 25)",
            event_type="event_type",
            event_timestamp="event_timestamp",
            event_hour_utc="case when event_key % 101 = 0 then null when event_key % 97 = 0 then 0L "
            "else true_hour end",
        )

    def raw_routes(self, faults: bool = True) -> DataFrame:
        """An export of ``routes_new`` as text: mixed date formats, an extra column, no distances.

        With ``faults`` some dates and stop counts are unreadable.
        """
        dated = self.routes_new().withColumn("k", F.expr("cast(substr(route_id, 5) as bigint)"))

        def day_first(c: str) -> str:
            return f"concat(day({c}), '/', month({c}), '/', year({c}))"

        def stamp(c: str) -> str:
            short = f"concat({day_first(c)}, ' ', hour({c}), ':', lpad(minute({c}), 2, '0'))"
            return (
                f"case k % 3 when 0 then concat({short}, ':00') when 1 then {short} "
                f"else cast({c} as string) end"
            )

        bad_date = "k % 89 = 3" if faults else "false"
        bad_stops = "k % 127 = 3" if faults else "false"
        return _columns(
            dated,
            route_status="route_status",
            route_id="route_id",
            driver_note="concat('note ', k)",
            partner_id="coalesce(partner_id, 'NULL')",
            vehicle_type_id="vehicle_type_id",
            center_id="center_id",
            route_date=f"if(k % 3 = 0, {day_first('route_date')}, cast(route_date as string))",
            route_type="route_type",
            planned_route_start_time=f"if({bad_date}, '31/31/1997', "
            f"{stamp('planned_route_start_time')})",
            planned_route_end_time=stamp("planned_route_end_time"),
            actual_route_start_time=stamp("actual_route_start_time"),
            actual_route_end_time=stamp("actual_route_end_time"),
            estimated_stops=f"case when {bad_stops} then 'many' "
            "when k % 4 = 0 then concat(estimated_stops, '.0') "
            "else cast(estimated_stops as string) end",
            actual_stops="cast(actual_stops as string)",
        )

    def raw_shipments(self) -> DataFrame:
        """Text dates of the control shipments in the formats of the exports."""
        return _columns(
            self._shipped,
            shipment_id="concat(shipment_id, '-', part_key % 10)",
            shipment_date="if(order_key % 5 = 0, concat(day(status_change_timestamp), '/', "
            "month(status_change_timestamp), '/', year(status_change_timestamp)), "
            "cast(cast(status_change_timestamp as date) as string))",
            status_change_timestamp="if(part_key % 7 = 0, null, "
            "concat(cast(cast(status_change_timestamp as date) as string), ' ', "
            "lpad(part_key % 24, 2, '0'), ':00:00'))",
        )
