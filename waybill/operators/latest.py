"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHIPMENT_ORDER = ("status_change_timestamp", "delivery_attempt_count")
SHIPMENT_TIE_BREAK = ("route_id", "last_status_detail")


def latest_record(
    df: DataFrame,
    keys: Sequence[str],
    order_by_desc: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest ``order_by_desc`` (then ``tie_break``) values for every key.

    ``rank <= 1`` lets Spark drop all but one row per key in each map task before the shuffle, so a
    key that holds a large share of the rows costs one row per task downstream.

    The hash of the keys leads the sort: ids that share a long prefix would otherwise be compared in
    full, and it follows from the keys, so the groups stay the same.
    """
    order = [F.col(c).desc_nulls_last() for c in (*order_by_desc, *tie_break)]
    w = Window.partitionBy("_hash", *keys).orderBy(*order)
    ranked = df.withColumn("_hash", F.xxhash64(*keys)).withColumn("_rn", F.row_number().over(w))
    return ranked.filter("_rn = 1").drop("_hash", "_rn")


def latest_record_agg(
    df: DataFrame,
    keys: Sequence[str],
    order_by_desc: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The same result as one aggregate."""
    order = F.struct(*order_by_desc, *tie_break)
    payload = F.struct(*[c for c in df.columns if c not in keys])
    picked = df.groupBy(*keys).agg(F.max_by(payload, order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def latest_shipments(shipments: DataFrame) -> DataFrame:
    """Current state of every shipment."""
    return latest_record(shipments, ["shipment_id"], SHIPMENT_ORDER, SHIPMENT_TIE_BREAK)


def current_shipments(tables) -> DataFrame:
    """The kept current state where the tables hold one (``shipments_current``), else the latest record of the raw loads."""
    if "shipments_current" in tables:
        return tables.shipments_current
    return latest_shipments(tables.shipments_new)
