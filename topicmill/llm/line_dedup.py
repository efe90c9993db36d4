"""Lines that many documents repeat, kept in one: incremental and reversible.

A `LineIndex` is a folder of tables. `postings` has every reference (line key,
document) exactly; `counts` has, per key, how many documents hold it and the
largest of them; `filters` has one cuckoo filter per shard of the keys that enough
documents hold. Inserting documents adds references, raises counts and puts keys
that reach the limit into their shard's filter; deleting documents takes the
references out, counts the touched keys anew, and takes keys that fall below the
limit out of the filter again. So an index that had documents inserted and
deleted gives what one gives that never had them.

Cleaning probes each line's key in the filters. Only lines that may be repeated
leave the task that reads them, as hashes; the exact counts decide about those.
The filters (two bytes a repeated key) are broadcast while their measured size is
below `MOST_BROADCAST`; beyond it line keys go to their shard and stream past its
filter, a hot shard dealt over many tasks.

Keys are 128-bit hashes. A line in a third of all documents is one row per task
in the counts, and its references are dealt by key and document together.
Counts are exact: each document counts once per key, however often it has it.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from topicmill.llm.common import SPACE_BYTES
from topicmill.llm.cuckoo import CuckooFilter
from topicmill.session import stage

# The shortest key that counts, and the documents that make it repeated.
LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3
# Shards of the filters, and tasks that a shard's lines are dealt over when they stream.
SHARDS = 64
DEAL = 16
MOST_BROADCAST = 32 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def line_key(line: bytes, least: int = LEAST_LENGTH) -> bytes | None:
    """Key of a line, or None where it is too short to count."""
    key = line.strip(SPACE_BYTES).translate(_LOWER)
    if len(key) < least:
        return None
    # Bytes that begin a code point: all but those of the form 10xxxxxx.
    if not key.isascii() and len(key.decode("utf-8", "replace")) < least:
        return None
    return key


def _hashes(text: bytes, least: int) -> list[bytes | None]:
    """Hash of each line's key, None where the line does not count."""
    found = []
    for line in text.split(b"\n"):
        key = line_key(line, least)
        found.append(None if key is None else hashlib.md5(key, usedforsecurity=False).digest())
    return found


def _words(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _shard(high):
    """Shard of a key, from bits that the filter's places don't depend on alone."""
    return F.pmod(F.col(high), F.lit(SHARDS)).cast("int")


_REFERENCES = "high long, low long, doc_id long"


def references(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """(high, low, doc_id): distinct keys of the lines of each document."""

    def run(batches):
        for batch in batches:
            digests, owners = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine = {h for h in _hashes((text.as_py() or "").encode("utf-8", "surrogatepass"), least) if h}
                digests += mine
                owners += [doc_id] * len(mine)
            high, low = _words(digests)
            yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low), pa.array(owners, pa.int64())], ["high", "low", "doc_id"])

    known = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return known.mapInArrow(run, _REFERENCES)


class LineIndex:
    """References, counts and filters of the documents put in so far."""

    def __init__(self, spark: SparkSession, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS):
        self.spark, self.least_length, self.least_documents = spark, least_length, least_documents
        empty = spark.createDataFrame([], f"{_REFERENCES}")
        self.postings = empty
        self.counts = empty.select("high", "low").withColumns({"n": F.lit(0).cast("long"), "top": F.lit(0).cast("long")})
        self.filters = spark.createDataFrame([], "shard int, data binary")

    # --- saving --------------------------------------------------------------------

    def save(self, path: str) -> None:
        """Write the index to a folder that is not there yet."""
        for name in ("postings", "counts", "filters"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, **limits: int) -> LineIndex:
        index = cls(spark, **limits)
        for name in ("postings", "counts", "filters"):
            setattr(index, name, spark.read.schema(getattr(index, name).schema).parquet(f"{path}/{name}"))
        return index

    # --- changes ---------------------------------------------------------------------

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with the documents' lines. References that are in already
        don't count again, so inserting a document twice changes nothing."""
        # Distinct by key and document: a line of many documents is dealt to all tasks.
        new = references(docs, self.least_length).distinct()
        if not self.postings.isEmpty():
            new = new.join(self.postings, ["high", "low", "doc_id"], "left_anti")
        new = stage(new, "line_references")
        added = new.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
        if self.counts.isEmpty():
            counts = added.withColumn("was", F.lit(0).cast("long"))
        else:
            both = self.counts.withColumn("was", F.col("n")).unionByName(added.withColumn("was", F.lit(0).cast("long")))
            counts = both.groupBy("high", "low").agg(F.sum("n").alias("n"), F.max("top").alias("top"), F.sum("was").alias("was"))
        return self._with(self.postings.unionByName(new), counts)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose `doc_id` is in `ids`; ids that are
        not in it change nothing. Only keys of deleted documents are counted anew."""
        gone = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
        left = stage(self.postings.join(gone, "doc_id", "left_anti").select("high", "low", "doc_id"), "line_references")
        touched = self.postings.join(gone, "doc_id", "left_semi").select("high", "low").distinct()
        touched = stage(touched, "touched_keys")
        anew = left.join(touched, ["high", "low"], "left_semi").groupBy("high", "low")
        anew = anew.agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
        before = self.counts.join(touched, ["high", "low"], "left_semi").select("high", "low", F.col("n").alias("was"))
        changed = before.join(anew, ["high", "low"], "left").fillna({"n": 0})
        same = self.counts.join(touched, ["high", "low"], "left_anti").withColumn("was", F.col("n"))
        return self._with(left, same.unionByName(changed.select("high", "low", "n", "top", "was")))

    def _with(self, postings: DataFrame, counts: DataFrame) -> LineIndex:
        counts = stage(counts, "line_counts")
        limit = self.least_documents
        crossed = counts.where((F.col("n") >= limit) != (F.col("was") >= limit))
        changes = crossed.select(_shard("high").alias("shard"), "high", "low", (F.col("n") >= limit).alias("comes"))
        index = LineIndex(self.spark, self.least_length, limit)
        index.postings = postings
        index.counts = counts.where("n > 0").select("high", "low", "n", "top")
        index.filters = stage(_changed_filters(self.filters, changes), "line_filters")
        return index

    # --- use -----------------------------------------------------------------------------

    def repeated(self) -> DataFrame:
        """(high, low, top) of keys that enough documents hold."""
        return self.counts.where(F.col("n") >= self.least_documents).select("high", "low", "top")

    def clean(self, docs: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
        """`docs` with n_lines, n_dropped and kept (the lines left, joined by \\n).

        A line goes if enough documents of the index hold its key and this is not
        the largest of them; documents that the index does not have lose it, too. Null and empty texts are one empty line. Rows without
        id neither count nor lose lines; rows that repeat an id are one document.
        Other columns pass through whatever their names, carried as one struct;
        those named like an output are replaced.
        """
        made = ["n_lines", "n_dropped", "kept"]
        columns = [c for c in docs.columns if c not in made]
        carried = docs.select(
            F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text")
        )
        known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        drops = self._drops(known, most_broadcast)
        drops = drops.select(F.col("doc_id").alias("_doc"), "keys")
        marked = carried.join(drops, F.col("_id") == F.col("_doc"), "left").select("row", "_text", "keys")
        least = self.least_length

        def run(batches):
            for batch in batches:
                lines, dropped, kept = [], [], []
                for text, keys in zip(batch.column(1), batch.column(2)):
                    text = (text.as_py() or "").encode("utf-8", "surrogatepass")
                    lines.append(text.count(b"\n") + 1)
                    if keys.is_valid:
                        gone = {struct.pack("<qq", k["high"], k["low"]) for k in keys.as_py()}
                        left = [x for x, h in zip(text.split(b"\n"), _hashes(text, least)) if h not in gone]
                        dropped.append(lines[-1] - len(left))
                        kept.append(b"\n".join(left))
                    else:
                        dropped.append(0)
                        kept.append(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["row", *made],
                )

        counts = [StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept", StringType())]
        found = marked.mapInArrow(run, StructType([marked.schema["row"], *counts]))
        return found.select("row.*", *made)

    def _drops(self, docs: DataFrame, most_broadcast: int) -> DataFrame:
        """(doc_id, keys): keys that each document loses, as halves of their hashes."""
        # One number comes to the driver; the filters only if that is small.
        size = self.filters.agg(F.sum(F.length("data"))).first()[0] or 0
        if size <= most_broadcast:
            suspects = self._probed_in_place(docs)
        else:
            suspects = self._probed_by_shard(docs)
        suspects = stage(suspects.distinct(), "suspect_lines")
        repeated = stage(self.repeated(), "repeated_lines")
        hits = suspects.join(repeated, ["high", "low"]).where(F.col("doc_id") != F.col("top"))
        return hits.groupBy("doc_id").agg(F.collect_list(F.struct("high", "low")).alias("keys"))

    def _probed_in_place(self, docs: DataFrame) -> DataFrame:
        filters = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["data"]) for r in self.filters.collect()})
        least = self.least_length

        def run(batches):
            loaded = {shard: CuckooFilter.load(data) for shard, data in filters.value.items()}
            for batch in batches:
                yield _filtered(batch, loaded)

        return references(docs, least).mapInArrow(run, _REFERENCES)

    def _probed_by_shard(self, docs: DataFrame) -> DataFrame:
        """Keys go to their shard, over `DEAL` tasks, behind a copy of its filter."""
        keys = references(docs, self.least_length).select(
            _shard("high").alias("shard"), F.pmod("doc_id", F.lit(DEAL)).cast("int").alias("deal"), "high", "low", "doc_id",
            F.lit(None).cast("binary").alias("data"),
        )
        none = F.lit(None).cast("long")
        copies = self.filters.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))).alias("deal"), none.alias("high"), none.alias("low"), none.alias("doc_id"), "data"
        )
        dealt = keys.unionByName(copies).repartition("shard", "deal").sortWithinPartitions("shard", "deal", F.col("data").isNull())

        def run(batches):
            place, current = None, CuckooFilter()
            for batch in batches:
                shard, deal = (np.asarray(batch.column(i)) for i in (0, 1))
                # Runs of one shard and deal; a filter comes first in its run.
                edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(deal) != 0)) + 1
                for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
                    if stop == start:
                        continue
                    part = batch.slice(start, stop - start)
                    if place != (shard[start], deal[start]):
                        place, current = (shard[start], deal[start]), CuckooFilter()
                    if part.column(5)[0].is_valid:
                        current = CuckooFilter.load(part.column(5)[0].as_py())
                        part = part.slice(1)
                    if part.num_rows:
                        high, low = (np.asarray(part.column(i)) for i in (2, 3))
                        keep = pa.array(current.contains(high, low))
                        yield pa.RecordBatch.from_arrays([part.column(i).filter(keep) for i in (2, 3, 4)], ["high", "low", "doc_id"])

        return dealt.mapInArrow(run, _REFERENCES)


def _filtered(batch: pa.RecordBatch, filters: dict[int, CuckooFilter]) -> pa.RecordBatch:
    high, low = np.asarray(batch.column(0)), np.asarray(batch.column(1))
    shard = np.mod(high, SHARDS)
    keep = np.zeros(len(high), bool)
    order = np.argsort(shard, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
        if len(rows) and (held := filters.get(int(shard[rows[0]]))) is not None:
            keep[rows] = held.contains(high[rows], low[rows])
    return batch.filter(pa.array(keep))


def _changed_filters(filters: DataFrame, changes: DataFrame) -> DataFrame:
    """Filters after keys came and went; a shard's filter is the only state held."""
    none = F.lit(None)
    old = filters.select("shard", none.cast("long").alias("high"), none.cast("long").alias("low"), none.cast("boolean").alias("comes"), "data")
    new = changes.withColumn("data", none.cast("binary"))
    # Keys that go leave first, so that their slots are free again.
    dealt = old.unionByName(new).repartition("shard").sortWithinPartitions("shard", F.col("data").isNull(), "comes", "high", "low")

    def run(batches):
        place, held = None, CuckooFilter()

        def finished():
            data = held.dump()
            rows = ([place], [data]) if place is not None and data else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary())], ["shard", "data"])

        for batch in batches:
            shard = np.asarray(batch.column(0))
            edges = np.flatnonzero(np.diff(shard)) + 1
            for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
                if stop == start:
                    continue
                part = batch.slice(start, stop - start)
                if place != shard[start]:
                    yield finished()
                    place, held = int(shard[start]), CuckooFilter()
                if part.column(4)[0].is_valid:
                    held = CuckooFilter.load(part.column(4)[0].as_py())
                    part = part.slice(1)
                if part.num_rows:
                    high, low = (np.asarray(part.column(i)) for i in (1, 2))
                    comes = np.asarray(part.column(3))
                    held.delete(high[~comes], low[~comes])
                    held.insert(high[comes], low[comes])
        yield finished()

    return dealt.mapInArrow(run, "shard int, data binary")


def dedup_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """All documents cleaned by an index of themselves."""
    index = LineIndex(docs.sparkSession, least_length, least_documents).insert(docs)
    return index.clean(docs)
