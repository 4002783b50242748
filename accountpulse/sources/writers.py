"""Writers of the merged table and of the long marketplace table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import company_order
from ..functions.weeks import WEEK


def canonical_order(df: DataFrame) -> DataFrame:
    """Week, then company. Only for a sink or a report: a global sort is a shuffle."""
    return df.orderBy(F.col(WEEK).asc_nulls_first(), *company_order())


def _write_csv(df: DataFrame, path: str) -> None:
    text_week = df.withColumn(WEEK, F.date_format(WEEK, "yyyy-MM-dd"))
    text_week.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def _write_by_week(df: DataFrame, path: str, *order: Column) -> None:
    """One folder per week, rows in order inside each file.

    Rows are dealt by ranges of week and company to as many tasks as a shuffle has, so each task
    writes few folders and a week with many companies is spread over several tasks.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(WEEK).asc_nulls_first(), *order]
    dealt = df.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    dealt.write.mode("overwrite").partitionBy(WEEK).parquet(path)


def write_merged(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Overwrite the merged table, as CSV with a header or as Parquet by week."""
    if fmt == "csv":
        _write_csv(canonical_order(df), path)
    elif fmt == "parquet":
        _write_by_week(df, path, *company_order())
    else:
        raise ValueError(f"Unknown format: {fmt}")


def read_by_week(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by week, with the columns it had. A filter on the week reads no other folder."""
    return spark.read.schema(schema).parquet(path).select(schema.fieldNames())


def write_long(df: DataFrame, path: str, fmt: str = "csv") -> bool:
    """Write the long marketplace table unless it is empty; tells whether it was written."""
    if df.isEmpty():
        return False
    order = [*company_order(), F.col("app_name").asc()]
    if fmt == "csv":
        _write_csv(df.orderBy(F.col(WEEK), *order), path)
    else:
        _write_by_week(df, path, *order)
    return True
