"""The current state of shipments as a bucketed table, merged load by load."""

import uuid
from datetime import datetime

from driver.queries import QUERIES
from waybill.operators.latest import latest_shipments
from waybill.sources import current

SCHEMA = "shipment_id string, route_id string, last_status_detail string, delivery_attempt_count long, status_change_timestamp timestamp_ntz"
T = datetime


def _exchanges_above(plan, table: str) -> int:
    """Exchanges whose subtree reads the table."""
    count = 0
    stack = [(plan, False)]
    while stack:
        node, below_exchange = stack.pop()
        name = node.nodeName()
        children = node.children()
        kids = [children.apply(i) for i in range(children.size())]
        if not kids and table in node.toString() and below_exchange:
            count += 1
        for kid in kids:
            stack.append((kid, below_exchange or "Exchange" in name))
    return count


def test_merge_equals_latest_of_both_loads(spark):
    first = [
        ("a", "r1", "in_transit", 0, T(2024, 1, 1)), ("a", "r1", "in_transit", 1, T(2024, 1, 2)),
        ("b", "r2", "delivered", 2, T(2024, 1, 3)), ("c", "r3", None, None, None), ("d", "r4", "in_transit", 0, T(2024, 1, 5)),
    ]
    second = [
        ("a", "r9", "delivered", 1, T(2024, 1, 9)), ("b", "r2", "delivered", 2, T(2024, 1, 3)),  # a repeat: a tie
        ("c", "r3", "delivered", 0, T(2024, 1, 1)), ("d", "r4", "returned", 0, T(2024, 1, 4)),  # older: d stays
        ("e", "r5", "delivered", 1, None), (None, "r6", "x", 1, T(2024, 1, 1)),
    ]
    name = f"current_test_{uuid.uuid4().hex[:8]}"
    current.create(spark.createDataFrame(first, SCHEMA), name, buckets=8)
    merged = current.merge(spark.createDataFrame(second, SCHEMA), name)
    want = latest_shipments(spark.createDataFrame(first + second, SCHEMA))
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert spark.catalog.tableExists(name) and len([t for t in spark.catalog.listTables() if t.name.startswith(name)]) == 1


def test_merge_reads_the_table_without_exchange(spark):
    name = f"current_plan_{uuid.uuid4().hex[:8]}"
    rows = [(f"s{i}", f"r{i % 5}", "delivered", i % 3, T(2024, 1, 1 + i % 20)) for i in range(200)]
    current.create(spark.createDataFrame(rows, SCHEMA), name, buckets=8)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = current.merged(spark.table(name), spark.createDataFrame(rows[:50], SCHEMA))._jdf.queryExecution().executedPlan()
        assert _exchanges_above(plan, name) == 0
        assert "Exchange" in plan.toString()  # the load is shuffled into the table's buckets
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_registered_query_equals_deduplication(spark):
    folder = "/root/testdata/sf0.001"
    got = sorted(map(tuple, QUERIES["current_state_merge"].run(spark, folder).collect()), key=str)
    want = sorted(map(tuple, QUERIES["dedup_latest"].run(spark, folder).collect()), key=str)
    assert got == want
    a = sorted(map(tuple, QUERIES["effectiveness_by_country_current"].run(spark, folder).collect()))
    b = sorted(map(tuple, QUERIES["effectiveness_by_country"].run(spark, folder).collect()))
    assert a == b
