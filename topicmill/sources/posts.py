"""Scans: raw text lines, JSON-lines posts, parquet stages."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicmill.schema import POST

# Bytes of scanned files that one task of `spread` gets, and how much larger than
# its file the text of a gzip file is taken to be.
SPREAD_BYTES = 16 << 20
GZIP_EXPANSION = 6.0


def _paths(paths: str | list[str]) -> list[str]:
    """Split a comma-joined list; commas inside `{a,b}` globs stay."""
    if not isinstance(paths, str):
        return list(paths)
    return [p.strip() for p in re.split(r",(?![^{]*})", paths) if p.strip()]


def read_raw_lines(spark: SparkSession, paths: str | list[str], with_files: bool = False) -> DataFrame:
    """Lines of many files, globs or folders as one `value` column.

    Plain and gzip files mix freely, and folders may nest. A gzip file is one task:
    `spread` deals its lines before a costly step. `with_files` adds `file_path` and
    `file_size` of the file each line comes from.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(_paths(paths))
    if with_files:
        return lines.select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
    return lines


def read_posts_json(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Parsed posts from JSON lines an earlier step wrote.

    Numbers are taken for string columns as they stand; fields of a malformed
    line are null, and such lines are dropped by their missing id.
    """
    options = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
    return spark.read.schema(POST).options(**options).json(_paths(paths)).where("tweet_id is not null")


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_bytes(df: DataFrame) -> int:
    """Bytes that the planner expects `df` to have; for a bare scan, of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, scanned: DataFrame | None = None, expansion: float = 1.0, task_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Deal rows over tasks that get about `task_bytes` of the scanned files each.

    For scans of few unsplittable files (gzip, single row groups) before a costly
    narrow step. `scanned` is the bare scan that `df` comes from, where `df` is
    parsed already. The number of tasks follows the size of the files, times
    `expansion` for compressed ones, and is twice the cores at least.
    """
    size = scan_bytes(df if scanned is None else scanned) * expansion
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(least, math.ceil(size / task_bytes)))


def folder_of(file_path: Column) -> Column:
    """The folder a line's file lies in, without the name of the file."""
    return F.regexp_replace(file_path, "/[^/]*$", "")
