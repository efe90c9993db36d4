"""Sinks: parquet stages, JSON lines, month folders, LibSVM, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from topicmill.functions.time import year_month
from topicmill.schema import POST
from topicmill.session import stage


def write_stage(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Save as parquet (an existing path is an error) and return the table."""
    return stage(df, "", path, mode)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def _by_month(posts: DataFrame) -> DataFrame:
    """Rows with `year_month`, dealt so that the adaptive planner cuts a month that
    holds much of the data into many even files and gives small months one each."""
    return posts.withColumn("year_month", year_month(F.col("create_time"))).hint("rebalance", F.col("year_month"))


def write_monthly(posts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Posts in one folder per month, so a month range prunes folders."""
    _by_month(posts).write.mode(mode).partitionBy("year_month").parquet(path)


def rewrite_months(posts: DataFrame, path: str) -> None:
    """Replace the months that `posts` has rows of; the other months' files stay.

    A month's new rows are all of its rows: read it, change it, write it here.
    Rows that come from the same layout must be staged first, since a month is
    gone before its successor is complete.
    """
    writer = _by_month(posts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year_month").parquet(path)


def read_months(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Posts of the months from `first` to `last` (`yyyy-MM`, both included).

    Only these months' folders are listed for the scan. The month comes as a string.
    """
    schema = StructType([*POST.fields, StructField("year_month", StringType())])
    table = spark.read.schema(schema).parquet(path)
    if first is not None:
        table = table.where(F.col("year_month") >= first)
    if last is not None:
        table = table.where(F.col("year_month") <= last)
    return table


def month_volume(posts: DataFrame) -> DataFrame:
    """`(year, month, post_count)` of a month layout, without reading any post column."""
    part = F.split("year_month", "-")
    year, month = (F.try_element_at(part, F.lit(i)).cast("int") for i in (1, 2))
    return posts.groupBy(year.alias("year"), month.alias("month")).agg(F.count("*").alias("post_count"))


def write_libsvm(features: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None) -> None:
    """`label` and `features` in LibSVM text format, in a folder per value of `by`."""
    columns = ["label", "features", *([by] if by else [])]
    rows = features.select(*columns)
    writer = (rows.hint("rebalance", F.col(by)) if by else rows).write.mode(mode).format("libsvm")
    (writer.partitionBy(by) if by else writer).save(path)


def read_libsvm(spark: SparkSession, path: str, width: int) -> DataFrame:
    """`label` and `features` of `width` places, and the folders' column, if any.

    Without the width Spark reads all files to find the largest index, and tables
    of one run could differ in it.
    """
    return spark.read.format("libsvm").option("numFeatures", width).load(path)


def write_model(model, path: str, overwrite: bool = False) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per input partition: `(partition_id, row_count)`."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("row_count"))
