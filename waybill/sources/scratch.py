"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str = "work") -> str:
    """A new path below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Nothing machine-local: a cluster's warehouse is on storage that all executors see. Whoever owns
    the checkpoint folder clears it between runs, as for Spark's own checkpoints.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/waybill-{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str = "work") -> DataFrame:
    """The frame, written once as Parquet in the shared folder and read back; cuts the lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
