"""Tables bucketed by a key, for joins that move no rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from topicmill.session import current_stages, stage_path


def write_bucketed(df: DataFrame, name: str, *keys: str, buckets: int | None = None) -> DataFrame:
    """Write `df` as a table in buckets by the hash of `keys`, each sorted by them.

    Tables with equal keys and numbers of buckets join, group and deduplicate on
    all of these keys without an exchange, however often that is done: the rows are
    moved once, here. `buckets` defaults to the number of shuffle partitions; it
    sets the size of the later tasks, so give bytes / 128 MB for large tables. A key
    that holds a large part of all rows makes one large bucket: for such keys stay
    with plain stages, whose joins the planner can split.

    The files go to the shared folder; the table lives in the session's catalog and
    is dropped with the innermost open `Stages`.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"topicmill_{name}_{uuid.uuid4().hex}"
    path = stage_path(spark, name)
    # Dealt as the buckets are, so that each bucket is one file.
    dealt = df.repartition(count, *keys)
    dealt.write.bucketBy(count, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    scope = current_stages()
    if scope is not None:
        scope.own_table(table)
    return spark.table(table)
