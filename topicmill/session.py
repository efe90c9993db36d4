"""Session settings and the shared folder that staged tables go to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange
    # further up: a hot id or hashtag must not end up in a single task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

SETTINGS = SKEW_SETTINGS | {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "topicmill", **overrides: str) -> SparkSession:
    """A session with the settings above; `overrides` use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    settings = SETTINGS | {key.replace("__", "."): value for key, value in overrides.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_skew_settings(spark: SparkSession) -> None:
    """Turn on skew handling in a session somebody else built."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Batches of rows that go to Python workers hold at most so many bytes, or one
    row: wide rows come by the thousand otherwise, in the executor and in the worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the one the cluster names for
    checkpoints, or else one below the warehouse. Same rule for every master.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise ValueError("no shared folder: set spark.checkpoint.dir, or spark.sql.warehouse.dir")
    return f"{warehouse.rstrip('/')}/stages"


def app_dir(spark: SparkSession) -> str:
    """Folder of all stages of this application."""
    return f"{shared_dir(spark).rstrip('/')}/topicmill/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path for a stage; the innermost open `Stages` deletes it when it ends."""
    path = f"{app_dir(spark)}/{name}-{uuid.uuid4().hex}"
    open_scopes = _SCOPES.get()
    if open_scopes:
        open_scopes[-1].own(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_SCOPES: ContextVar[tuple[Stages, ...]] = ContextVar("topicmill_stages", default=())


class Stages:
    """Stages and bucketed tables with a common end.

    Everything that is staged inside the `with` block is deleted when the block
    ends, also by an error: folders through the file system they are in, tables
    from the catalog. Consume results inside the block, since a DataFrame that
    reads a stage is lazy, or `keep` what is to stay. Blocks nest; each thread
    has its own.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []

    def own(self, path: str) -> None:
        self.paths.append(path)

    def own_table(self, name: str) -> None:
        self.tables.append(name)

    def keep(self, path: str) -> str:
        """Leave this stage where it is; an enclosing block takes it over."""
        self.paths.remove(path)
        outer = _SCOPES.get()[: _SCOPES.get().index(self)]
        if outer:
            outer[-1].own(path)
        return path

    def __enter__(self) -> Stages:
        self._token = _SCOPES.set((*_SCOPES.get(), self))
        return self

    def __exit__(self, *error: object) -> None:
        _SCOPES.reset(self._token)
        for name in self.tables:
            self.spark.sql(f"drop table if exists {name}")
        for path in self.paths:
            delete_path(self.spark, path)
        self.paths, self.tables = [], []


def current_stages() -> Stages | None:
    """The innermost open block, if any."""
    return _SCOPES.get()[-1] if _SCOPES.get() else None


def purge_stages(spark: SparkSession) -> None:
    """Delete all stages of this application: for stages made outside any block,
    once their results have been consumed."""
    delete_path(spark, app_dir(spark))


def stage(df: DataFrame, name: str, path: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Write `df` as parquet and return the written table.

    Cuts the lineage and survives lost executors; the read side prunes columns,
    pushes filters down and knows its true size, so joins pick a broadcast by
    measured bytes. Without a path it is a stage of the innermost open `Stages`.
    """
    target = path or stage_path(df.sparkSession, name)
    df.write.mode(mode).parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
