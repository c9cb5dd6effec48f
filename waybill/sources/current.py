"""The current state of every shipment as a bucketed table, kept up to date load by load.

``create`` keeps the latest record of each shipment of a first load; ``merge`` folds a further load
into it. A load is first reduced to its latest row per shipment (map-side, as ``latest_shipments``
does), then joined in full to the table on ``shipment_id``. The table is bucketed and sorted by
``shipment_id``, so Spark shuffles the load alone into the table's buckets and reads the table
without an exchange; the later of a shipment's two rows wins by the order of ``latest_shipments``
(status time, attempts, then route and status; a null is older than any value). Hence
``merge(create(a), b)`` holds the rows of ``latest_shipments(a ∪ b)``.

The merged state is written as a new bucketed table beside the old one; then the old table is
renamed aside, the new one renamed in, and the old one dropped. If the second rename fails, the old
table is renamed back, so the name always denotes a whole table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.operators.latest import SHIPMENT_ORDER, SHIPMENT_TIE_BREAK, latest_shipments

BUCKETS = 64
KEY = "shipment_id"
COLUMNS = ("shipment_id", "route_id", "last_status_detail", "delivery_attempt_count", "status_change_timestamp")


def _rank(side: str) -> Column:
    """A row's place in the order of ``latest_shipments``: nulls below every value, column by column."""
    return F.struct(*[
        F.struct(F.col(f"{side}.{c}").isNotNull().alias("known"), F.col(f"{side}.{c}").alias("value")).alias(c)
        for c in (*SHIPMENT_ORDER, *SHIPMENT_TIE_BREAK)
    ])


def _write(spark: SparkSession, df: DataFrame, name: str, buckets: int) -> None:
    staged = f"{name}__staged_{uuid.uuid4().hex[:12]}"
    df.write.bucketBy(buckets, KEY).sortBy(KEY).format("parquet").saveAsTable(staged)
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        return
    aside = f"{name}__old_{uuid.uuid4().hex[:12]}"
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {aside}")


def create(records: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """A bucketed table ``name`` with the latest record of every shipment of ``records``."""
    spark = records.sparkSession
    _write(spark, latest_shipments(records.select(*COLUMNS)), name, buckets)
    return spark.table(name)


def merged(state: DataFrame, records: DataFrame) -> DataFrame:
    """The state with a load folded in: per shipment, the later of its kept row and the load's latest."""
    new = latest_shipments(records.select(*COLUMNS)).alias("n")
    joined = state.select(*COLUMNS).alias("s").join(new, F.col(f"s.{KEY}") == F.col(f"n.{KEY}"), "full_outer")
    take_new = F.col(f"s.{KEY}").isNull() | (F.col(f"n.{KEY}").isNotNull() & (_rank("n") > _rank("s")))
    return joined.select(*[F.when(take_new, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in COLUMNS])


def merge(records: DataFrame, name: str) -> DataFrame:
    """Folds a load into the table ``name`` and returns the new table."""
    spark = records.sparkSession
    table = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    buckets = int(table[0]["data_type"]) if table else BUCKETS
    _write(spark, merged(spark.table(name), records), name, buckets)
    return spark.table(name)
