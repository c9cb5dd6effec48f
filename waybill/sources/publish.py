"""Writing tables and reports so that a repeated run leaves the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from waybill.functions.measures import DISPLAY
from waybill.sources.scratch import shared_folder


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Replace a parquet table; the old one stays until the new one is written whole.

    The new table is written beside the old one, which also allows ``df`` to read the old one.
    """
    columns = list(partition_by)
    if columns:
        df = df.hint("rebalance", *columns)
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(*columns).parquet(staged)
    except Exception:
        _files(df.sparkSession, staged, lambda fs, new: fs.delete(new, True))
        raise
    _replace(df.sparkSession, staged, path)


def _files(spark: SparkSession, path: str, act: Callable[..., bool]) -> bool:
    """Acts on a path by means of the file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return act(place.getFileSystem(spark._jsc.hadoopConfiguration()), place)


def _replace(spark: SparkSession, staged: str, path: str) -> None:
    """Puts the staged folder at the path: the old one is moved aside first and back on failure."""
    _swap(spark, staged, path)
    spark.catalog.refreshByPath(path)


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    had_old = fs.exists(jvm_path(path))
    if had_old and not fs.rename(jvm_path(path), jvm_path(aside)):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(jvm_path(staged), jvm_path(path)):
        if had_old:
            fs.rename(jvm_path(aside), jvm_path(path))
        raise OSError(f"{staged} holds the new table, but could not be renamed to {path}")
    if had_old:
        fs.delete(jvm_path(aside), True)


def _leaf_partitions(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Relative paths ``a=1/b=2`` of the partition folders below a table's root."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [""]
    for _ in range(depth):
        deeper = []
        for rel in found:
            place = jvm_path(f"{root}/{rel}" if rel else root)
            if not fs.exists(place):
                continue
            for status in fs.listStatus(place):
                name = status.getPath().getName()
                if status.isDirectory() and "=" in name and not name.startswith(("_", ".")):
                    deeper.append(f"{rel}/{name}" if rel else name)
        found = deeper
    return found


def merge_partitions(
    df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], period: tuple[str, str] | None = None
) -> None:
    """Key-level upsert into a partitioned parquet table; running it again changes nothing.

    In every partition the frame has, its rows replace the table's rows with the same ``keys``
    (nulls equal) and the table's other rows stay. With ``period`` (lowest and highest value of the
    first partition column, inclusive, as text), the run covers that period whole: its partitions that
    the frame lacks are cleared. Partitions outside the frame and the period are not touched.

    The merged partitions are written to a staged folder first (the job reads the old ones); then each
    is swapped in by renames, the old one moved aside and back on failure.
    """
    spark = df.sparkSession
    columns = list(partition_by)
    base = path.rstrip("/")
    exists = _files(spark, base, lambda fs, place: fs.exists(place))
    merged = df
    if exists:
        old = spark.read.schema(df.schema).parquet(base).select(*df.columns)
        touched = df.select(*columns).distinct()
        same_part = [old[c].eqNullSafe(touched[c]) for c in columns]
        in_touched = old.join(touched, _all(same_part), "left_semi")
        replaced = df.select(*keys).distinct()
        same_key = [in_touched[k].eqNullSafe(replaced[k]) for k in keys]
        merged = df.unionByName(in_touched.join(replaced, _all(same_key), "left_anti"))
    staged = f"{base}.staged-{uuid.uuid4().hex}"
    merged.hint("rebalance", *columns).write.partitionBy(*columns).parquet(staged)
    new_parts = set(_leaf_partitions(spark, staged, len(columns)))
    if not exists:
        _swap(spark, staged, base)
    else:
        for rel in sorted(new_parts):
            _swap(spark, f"{staged}/{rel}", f"{base}/{rel}")
        if period is not None:
            low, high = period
            for rel in _leaf_partitions(spark, base, len(columns)):
                value = rel.split("/")[0].split("=", 1)[1]
                if rel not in new_parts and low <= value <= high:
                    _files(spark, f"{base}/{rel}", lambda fs, place: fs.delete(place, True))
        _files(spark, staged, lambda fs, place: fs.delete(place, True))
    spark.catalog.refreshByPath(base)


def _all(conditions: list) -> object:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def publish_partitions(df: DataFrame, path: str, partition_by: Iterable[str]) -> None:
    """Replace only the partitions that occur in ``df``; running it again changes nothing.

    The rebalance step gathers each partition into few files and splits one that is too large.
    """
    columns = list(partition_by)
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def read_published(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A published table with the columns and types of the frame it was written from."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered UTF-8 CSV with ISO dates."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def formatted(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Display text for the named columns; see ``DISPLAY`` for the formats."""
    return df.select(*[
        DISPLAY[formats[c]](df[c]).alias(c) if c in formats else df[c] for c in df.columns
    ])


def write_report(
    df: DataFrame, path: str, fmt: str = "parquet", formats: Mapping[str, str] | None = None
) -> None:
    """Store a report as ``parquet`` or ``csv``, with display formats if given."""
    report = formatted(df, formats) if formats else df
    if fmt == "parquet":
        write_table(report, path)
    elif fmt == "csv":
        write_csv(report, path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")


def work_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share; see ``scratch.shared_folder``."""
    return shared_folder(spark)
