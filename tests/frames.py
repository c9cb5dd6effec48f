"""Small frames with the declared schemas."""

from datetime import date, datetime

from pyspark.sql import functions as F

from waybill.sources.schemas import SCHEMAS
from waybill.sources.tables import Tables


def frame(spark, table, *rows):
    """Rows as dicts; absent columns are NULL."""
    schema = SCHEMAS[table]
    nullable = [f.name + " " + f.dataType.simpleString() for f in schema]
    data = [tuple(r.get(f.name) for f in schema) for r in rows]
    return spark.createDataFrame(data, ", ".join(nullable))


def tables(spark, **rows):
    return Tables({name: frame(spark, name, *rows.get(name, ())) for name in SCHEMAS})


def at(text):
    return datetime.fromisoformat(text)


def day(text):
    return date.fromisoformat(text)


def rows(df):
    return [tuple(r) for r in df.collect()]


def dicts(df):
    return [r.asDict() for r in df.collect()]


def evaluate(spark, **columns):
    """Evaluate literal-only columns as one row."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def parsed(spark, parse, *values):
    df = texts(spark, *values).select("i", parse(F.col("v")).alias("x"))
    return [r.x for r in df.orderBy("i").collect()]
