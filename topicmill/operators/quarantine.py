"""Ingest that loses no line: posts on one side, rejected lines with a reason on the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from topicmill.constants import MIN_LINE_LENGTH
from topicmill.operators.parsing import flatten, rejection, with_records
from topicmill.schema import POST, POST_COLUMNS

ACCEPTED = "accepted"
REASONS = ("short", "malformed", "language", "missing")

_TABLE = StructType(
    [
        StructField("value", StringType()),
        *[StructField(f.name, f.dataType) for f in POST.fields],
        StructField("reason", StringType()),
    ]
)


def rejection_of(lines: DataFrame, min_length: int = MIN_LINE_LENGTH, lang: str = "en") -> DataFrame:
    """`lines` with `reason`; other columns than `value` pass through."""
    others = [c for c in lines.columns if c != "value"]
    carried = lines.select("value", F.struct(*others).alias("_line")) if others else lines
    reason = F.coalesce(rejection(min_length, lang), F.lit(ACCEPTED)).alias("reason")
    return with_records(carried).select("value", *(["_line.*"] if others else []), reason)


def judge_lines(lines: DataFrame, min_length: int = MIN_LINE_LENGTH, lang: str = "en") -> DataFrame:
    """Every line once: `reason`, the post's columns where it is `accepted`, and the
    line itself (`value`) where it is not. Each line is parsed once.

    Null lines are `short`, with a null value.
    """
    records = with_records(lines.select("value"))
    reason = F.coalesce(rejection(min_length, lang), F.lit(ACCEPTED))
    judged = records.select("value", *flatten(), reason.alias("reason"))
    ok = F.col("reason") == ACCEPTED
    posts = [F.when(ok, F.col(c)).alias(c) for c in POST_COLUMNS]
    return judged.select(F.when(~ok, F.col("value")).alias("value"), *posts, "reason")


def ingest(lines: DataFrame, path: str, min_length: int = MIN_LINE_LENGTH, lang: str = "en", mode: str = "errorifexists") -> None:
    """Write all lines to one table with a folder per reason, `accepted` among them:
    one pass, and accepted plus rejected lines are the lines that came."""
    judge_lines(lines, min_length, lang).write.mode(mode).partitionBy("reason").parquet(path)


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_TABLE).parquet(path)


def accepted_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts of an ingest; only the folder of accepted lines is read."""
    return _table(spark, path).where(F.col("reason") == ACCEPTED).select(*POST_COLUMNS)


def rejected_lines(spark: SparkSession, path: str, *reasons: str) -> DataFrame:
    """`(value, reason)` of rejected lines; only the named reasons' folders are read."""
    wanted = reasons or REASONS
    return _table(spark, path).where(F.col("reason").isin(*wanted)).select("value", "reason")


def reingest(
    spark: SparkSession,
    path: str,
    output: str,
    mend: Callable[[Column], Column],
    reasons: tuple[str, ...] = ("malformed",),
    min_length: int = MIN_LINE_LENGTH,
    lang: str = "en",
) -> None:
    """Mend the rejected lines of these reasons and ingest them to `output`.

    The first ingest stays as it is, so that a mending rule can be tried again.
    """
    lines = rejected_lines(spark, path, *reasons).select(mend(F.col("value")).alias("value"))
    ingest(lines, output, min_length, lang)


def summary(spark: SparkSession, path: str) -> DataFrame:
    """`(reason, line_count)` of an ingest."""
    return _table(spark, path).groupBy("reason").agg(F.count("*").alias("line_count"))
