import random

from pyspark.sql import functions as F

from tests.frames import at, rows
from waybill.operators.latest import (
    SHIPMENT_ORDER,
    SHIPMENT_TIE_BREAK,
    latest_record,
    latest_record_agg,
    latest_shipments,
)

SCHEMA = (
    "shipment_id string, route_id string, last_status_detail string, "
    "delivery_attempt_count long, status_change_timestamp timestamp_ntz"
)
ARGS = (["shipment_id"], SHIPMENT_ORDER, SHIPMENT_TIE_BREAK)


def records(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_latest_by_time_then_attempts_then_tie_break(spark):
    t1, t2 = at("2025-04-01 10:00:00"), at("2025-04-02 10:00:00")
    df = records(spark, [
        ("A", "R1", "in_transit", 1, t1), ("A", "R2", "delivered", 1, t2),
        ("B", "R1", "failed", 1, t1), ("B", "R1", "delivered", 2, t1),
        ("C", "R1", "x", 1, t1), ("C", "R2", "x", 1, t1),
        ("D", "R1", "known", 1, t1), ("D", "R2", "no time", 9, None),
        ("E", "R1", "no attempts", None, t1), ("E", "R1", "attempts", 0, t1),
    ])
    kept = {r.shipment_id: (r.route_id, r.last_status_detail)
            for r in latest_shipments(df).collect()}
    assert kept == {
        "A": ("R2", "delivered"), "B": ("R1", "delivered"), "C": ("R2", "x"),
        "D": ("R1", "known"), "E": ("R1", "attempts"),
    }


def test_window_form_equals_aggregate_form_and_is_idempotent(spark):
    rnd = random.Random(7)
    data = [
        ("HOT" if rnd.random() < 0.4 else f"S{rnd.randint(0, 60)}", f"R{rnd.randint(0, 5)}",
         rnd.choice(["delivered", "returned", None]), rnd.choice([None, 0, 1, 2]),
         rnd.choice([None, at("2025-04-01 10:00:00"), at("2025-04-02 10:00:00")]))
        for _ in range(600)
    ]
    df = records(spark, data)
    window, agg = latest_record(df, *ARGS), latest_record_agg(df, *ARGS)
    key = lambda r: str(r)
    assert sorted(rows(window), key=key) == sorted(rows(agg), key=key)
    assert sorted(rows(latest_record(window, *ARGS)), key=key) == sorted(rows(window), key=key)
    assert window.count() == df.select("shipment_id").distinct().count()


def test_a_crowded_key_is_cut_before_the_shuffle(spark):
    df = records(spark, [("A", "R1", "x", 1, at("2025-04-01 10:00:00"))])
    plan = latest_shipments(df.filter(F.col("route_id") > "")).groupBy("route_id").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in text and text.count("WindowGroupLimit") == 2
