"""Repeated passages, exactly, by super-k-mers of words.

A window is 50 consecutive words of one document; its minimiser is the smallest
hash of its 8-word grams. Consecutive windows with the same minimiser form a
super-k-mer, which travels once, as one packed string, to the bucket of its
minimiser. Equal windows have equal minimisers, so a bucket sees all occurrences
of its windows: it sorts them (by two 64-bit hashes of the words), and the first
of each run is the one in the smallest document. Every word covered by a later
document's window is removed.

Only super-k-mers whose minimiser occurs in two documents or more are packed. A
minimiser in very many places (a passage in a third of all documents) is split:
its windows go by their own hash, the smallest document of each is found by an
aggregate with map-side combine, and a join that the planner can split brings it
back to the occurrences.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.llm.common import RollingHash, Words, shielded, signed, slices
from topicmill.session import stage

WINDOW = 50
GRAM = 8
# Longest super-k-mer in windows: bounds the packed strings of periodic texts.
MOST_WINDOWS = 256
# Super-k-mers of one minimiser from which on its windows go by their own hash.
# It only chooses the route; the result is the same.
SPLIT_FROM = 1000

_WORD_HASHES = (RollingHash(21), RollingHash(22))
_WINDOW_HASHES = (RollingHash(23), RollingHash(24))
_GRAM_HASH = RollingHash(25)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _super_kmers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(minimiser, doc_id, text_key, start, windows) of each document."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                words = Words(part.column(1))
                hashes = words.hashes(_WORD_HASHES[0])
                if len(hashes) < window:
                    continue
                start = np.arange(len(hashes) - gram + 1)
                # Grams across two texts are computed too, but no window has them.
                lowest = sliding_min(_GRAM_HASH.spans(hashes, start, start + gram), window - gram + 1)
                begin, row = words.windows(window)
                if not len(begin):
                    continue
                least = lowest[begin]
                new = np.ones(len(begin), bool)
                new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
                at = np.arange(len(begin)) - np.maximum.accumulate(np.where(new, np.arange(len(begin)), 0))
                new |= at % MOST_WINDOWS == 0
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(begin)))
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(least[first]),
                        part.column(0).cast(pa.int64()).take(pa.array(row[first])),
                        part.column(2).take(pa.array(row[first])),
                        pa.array((begin[first] - words.first[row[first]]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    ["minimiser", "doc_id", "text_key", "start", "windows"],
                )

    return docs.mapInArrow(run, "minimiser long, doc_id long, text_key long, start int, windows int")


_PACKED = "minimiser long, doc_id long, text_key long, start int, packed string"


def _packed(docs: DataFrame, parts: DataFrame, window: int) -> DataFrame:
    """The words of each super-k-mer in `parts` as one string."""
    listed = parts.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("minimiser", "start", "windows")).alias("parts"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, text_key = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                words = batch.column(1)[i].as_py().encode("utf-8", "surrogatepass").split()
                rows = batch.column(3)[i].as_py()
                # A few thousand words at a time: periodic texts pack to many.
                for at in range(0, len(rows), 2000):
                    some = rows[at : at + 2000]
                    text = [b" ".join(words[p["start"] : p["start"] + p["windows"] + window - 1]) for p in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([p["minimiser"] for p in some], pa.int64()),
                            pa.array([doc_id] * len(some), pa.int64()),
                            pa.array([text_key] * len(some), pa.int64()),
                            pa.array([p["start"] for p in some], pa.int32()),
                            pa.array(text, pa.binary()).cast(pa.string()),
                        ],
                        ["minimiser", "doc_id", "text_key", "start", "packed"],
                    )

    found = docs.join(listed, ["doc_id", "text_key"]).select("doc_id", "text", "text_key", "parts")
    return found.mapInArrow(_merged(run), _PACKED)


def _merged(run, rows: int = 4000):
    """Joins the many small batches of a generator into larger ones."""

    def merged(batches):
        held, count = [], 0
        for batch in run(batches):
            held.append(batch)
            count += batch.num_rows
            if count >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, count = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return merged


_WINDOWS = "w1 long, w2 long, doc_id long, text_key long, starts array<int>"


def _windows(packed: DataFrame, window: int) -> DataFrame:
    """Unpacks super-k-mers into the hashes of their windows, each with where it
    starts: one row for a window that a periodic text has again and again."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "packed", 1 << 20):
                words = Words(part.column(part.schema.get_field_index("packed")))
                begin, row = words.windows(window)
                hashes = [w.spans(words.hashes(h), begin, begin + window) for h, w in zip(_WORD_HASHES, _WINDOW_HASHES)]
                if not len(row):
                    continue
                start = (np.asarray(part.column(3))[row] + (begin - words.first[row])).astype(np.int32)
                doc, key = (np.asarray(part.column(i))[row] for i in (1, 2))
                order = np.lexsort((start, key, doc, hashes[1], hashes[0]))
                columns = [x[order] for x in (*hashes, doc, key)]
                new = np.ones(len(order), bool)
                new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
                first = np.flatnonzero(new)
                starts = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), pa.array(start[order]))
                w1, w2, doc, key = (x[first] for x in columns)
                yield pa.RecordBatch.from_arrays(
                    [signed(w1), signed(w2), pa.array(doc), pa.array(key), starts], ["w1", "w2", "doc_id", "text_key", "starts"]
                )

    return packed.select("minimiser", "doc_id", "text_key", "start", "packed").mapInArrow(run, _WINDOWS)


def _later(sorted_windows: DataFrame) -> DataFrame:
    """Windows of a sorted stream that a smaller document has, too."""

    def run(batches):
        last = None  # (w1, w2) of the run at the end of the batch before, and its smallest document
        for batch in batches:
            if not batch.num_rows:
                continue
            w1, w2, doc = (np.asarray(batch.column(i)) for i in range(3))
            new = np.ones(len(w1), bool)
            new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
            least = doc[np.maximum.accumulate(np.where(new, np.arange(len(w1)), 0))]
            if last is not None and last[:2] == (w1[0], w2[0]):
                stop = np.flatnonzero(new[1:])[:1]
                least[: stop[0] + 1 if len(stop) else len(least)] = last[2]
            last = (w1[-1], w2[-1], least[-1])
            keep = pa.array(doc > least)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (2, 3, 4)], ["doc_id", "text_key", "starts"])

    return sorted_windows.mapInArrow(run, "doc_id long, text_key long, starts array<int>")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, split_from: int = SPLIT_FROM) -> DataFrame:
    """(doc_id, text_key, starts) of windows that also start in a document with a
    smaller doc_id. `docs`: doc_id, text, text_key, no null doc_id."""
    parts = stage(_super_kmers(docs.where("text is not null").select("doc_id", "text", "text_key"), window, gram), "super_kmers")
    common = (
        parts.groupBy("minimiser")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("places"))
        .where("low < high")
        .select("minimiser", "places")
    )
    shared = stage(parts.join(common, "minimiser"), "shared_kmers")
    usual = _packed(docs, shared.where(F.col("places") < split_from), window)
    bucketed = _windows(usual.repartition("minimiser"), window).sortWithinPartitions("w1", "w2", "doc_id")
    later = _later(bucketed)

    split = _windows(_packed(docs, shared.where(F.col("places") >= split_from), window), window)
    ends = split.groupBy(F.col("w1").alias("_1"), F.col("w2").alias("_2")).agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"))
    # Written: the planner splits a hot window only in a join of plain exchanges.
    least = stage(ends.where("_least < _most").drop("_most"), "least_documents")
    joined = split.join(least, (F.col("w1") == F.col("_1")) & (F.col("w2") == F.col("_2")))
    return later.union(joined.where("doc_id > _least").select("doc_id", "text_key", "starts"))


@shielded("doc_id", "text", made=("n_words", "n_removed", "kept"))
def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, split_from: int = SPLIT_FROM) -> DataFrame:
    """`docs` with n_words, n_removed and kept (the words left, joined by a space).

    Null and empty texts have no words and an empty `kept`; texts shorter than a
    window lose nothing. Repeats within one document don't count. Rows without id
    neither remove nor lose words; rows that repeat an id never remove each
    other's. Other columns pass through; those named like an output are replaced.
    """
    made = ["n_words", "n_removed", "kept"]
    columns = [c for c in docs.columns if c not in (*made, "text_key")]
    keyed = docs.select(*columns).withColumn("text_key", F.xxhash64("text"))
    known = keyed.where("doc_id is not null")
    narrow = known.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "text_key")
    starts = stage(
        repeated_windows(narrow, window, gram, split_from)
        .groupBy("doc_id", "text_key")
        .agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts")),
        "repeated_windows",
    )
    starts = starts.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "starts")
    marked = keyed.join(starts, (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    place = columns.index("text")

    def run(batches):
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, starts in zip(batch.column(place), batch.column(batch.num_columns - 1)):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                counts.append(len(words))
                if starts.is_valid:
                    change = np.zeros(len(words) + 1, np.int64)
                    at = np.asarray(starts.values)
                    change[at] += 1
                    change[at + window] -= 1
                    stays = np.cumsum(change)[:-1] == 0
                    words = list(compress(words, stays))
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                [*batch.schema.names[:-1], *made],
            )

    source = marked.select(*columns, "starts")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(run, f"{fields}, n_words long, n_removed long, kept string")
