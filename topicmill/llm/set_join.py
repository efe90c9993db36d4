"""Exact Jaccard self-join of documents' word shingles, by components.

Two sets link when their Jaccard similarity is at least 3/4. Sets are 64-bit
shingle hashes; equal sets are one node, whatever their number.

* Every set is put in one order: shingles that are frequent in the corpus last,
  the others by hash. Sets that link share a shingle within their first quarter
  (prefix filter), so only these prefixes become postings (shingle, set, size,
  position). Any order gives the same result; the frequent ones go last so that a
  passage in a third of all documents makes no list of that length.
* Lists are sorted by size and position. A list is read in blocks that start with
  a pivot and hold sets whose size can still link with it; positions that leave
  too few shingles are skipped.
* Relations between sets save comparisons. First each set is compared with one
  set only, the pivot it shares most lists with. What links with a pivot has its
  answers from the pivot: pairs within a component are never compared. In some more
  rounds, sets that still share lists with other components are compared with a few
  pivots of those, drawn anew: with the one they share most lists with, and with the
  others only where that hasn't joined them. The pairs left are those of one list in different
  components, all of which are looked at; where both sets were
  compared with the same pivot, the triangle inequality of the Jaccard distance
  rejects pairs without looking at the sets.
* Pairs go through parity bitmaps first (one to two bits per shingle): two bitmaps
  never differ in more places than the sets, so too many places reject a pair.
* Pairs left are verified on whole sets, fetched only for documents that occur in
  a pair: a Bloom filter of bounded size picks them before they are shuffled. They
  travel as upper quarters of the hashes (upper halves for large sets); what these
  leave open is compared again by whole hashes.

Postings are rows of joins and aggregates; no list is gathered, except by the
join's own spillable buffer. They travel by 48 bits of a shingle and 16 of its
position, a larger one as the largest: both only let more pairs through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicmill.llm.common import RollingHash, Words, _mix, signed, slices
from topicmill.llm.components import components
from topicmill.session import arrow_batches, stage

SHINGLE = 5
# A shingle counts as frequent from so many sets on; at most so many are listed,
# the most frequent ones (8 bytes each). Neither changes the result.
FREQUENT = 64
FREQUENT_LIMIT = 200_000
# Shingles that a task counts at once when it looks for frequent ones.
COUNTED_AT_ONCE = 2_000_000
# Bytes of text that a task has arrays of at once: what bounds a Python worker.
SLICE = 1 << 19
# Bytes of rows that Spark sends to a Python worker at once.
BATCH_BYTES = 4 << 20
# Bits of a posting that hold the position, and the largest one that they can hold.
PLACE_BITS = 16
PLACE_LIMIT = (1 << PLACE_BITS) - 1
# Rounds with pivots drawn anew, pivots per list, and comparisons per set and round.
# They only save work: whatever they leave open is compared pair by pair.
ROUNDS, PIVOTS, COMPARED = 1, 4, 3
# Sets up to this size are first compared by upper quarters of their hashes.
QUARTERS = 2_000
BLOOM_BITS = (1 << 16, 1 << 26)

_WORD_HASH, _SHINGLE_HASH = RollingHash(11), RollingHash(12)


class Sets:
    """Distinct shingles of the rows of a slice, by row, frequent ones last."""

    def __init__(self, texts: pa.Array, k: int, frequent: np.ndarray):
        words = Words(texts, lower=True)
        hashes = words.hashes(_WORD_HASH)
        start, row = words.windows(k)
        end = start + k
        # Fewer words than k: the whole sequence is the one shingle.
        counts = np.diff(words.first)
        short = np.flatnonzero((counts > 0) & (counts < k))
        start = np.concatenate([start, words.first[short]])
        end = np.concatenate([end, words.first[short + 1]])
        row = np.concatenate([row, short])
        value = _SHINGLE_HASH.spans(hashes, start, end)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, value), len(frequent) - 1)
            often = frequent[at] == value
            order = np.lexsort((value, often, row))
        else:
            order = np.lexsort((value, row))
        row, value = row[order], value[order]
        fresh = np.ones(len(value), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        self.row, self.value = row[fresh], value[fresh]
        self.first = np.searchsorted(self.row, np.arange(len(texts) + 1))
        self.size = np.diff(self.first)
        total = np.zeros(len(self.value) + 1, np.uint64)
        np.cumsum(_mix(self.value * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)), out=total[1:])
        self.key = _mix((total[self.first[1:]] - total[self.first[:-1]]) ^ self.size.astype(np.uint64))

    def bitmaps(self) -> list[bytes]:
        """Per row, parities of the shingles that fall on each bit. The number of
        bits is a power of two, at least the size of the set."""
        bits = np.maximum(64, 2 ** np.ceil(np.log2(np.maximum(self.size, 2))).astype(np.int64))
        base = np.cumsum(bits) - bits
        place = base[self.row] + (self.value & (bits[self.row] - 1).astype(np.uint64)).astype(np.int64)
        parity = (np.bincount(place, minlength=int(bits.sum())) & 1).astype(np.uint8)
        packed = np.packbits(parity, bitorder="little")
        return [packed[b // 8 : (b + n) // 8].tobytes() for b, n in zip(base, bits)]

    def prefixes(self, rows: np.ndarray) -> np.ndarray:
        """Places in `value` of the first quarter of each chosen row."""
        length = np.where(self.size > 0, self.size - (3 * self.size + 3) // 4 + 1, 0)[rows]
        offset = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        return np.repeat(self.first[rows], length) + offset


def _ids(batch: pa.RecordBatch) -> pa.Array:
    return batch.column(0).cast(pa.int64())


def _summaries(docs: DataFrame, k: int) -> DataFrame:
    """A pass over the texts: kind 0 rows are (doc_id, set, size, bitmap), kind 1
    rows are (null, shingle, count, null) of shingles found in three sets or more of a chunk."""

    def run(batches):
        values, sizes, keys, total = [], [], [], 0

        def frequent():
            if not keys:
                return None
            _, first = np.unique(np.concatenate(keys), return_index=True)
            chosen = np.zeros(sum(len(x) for x in keys), bool)
            chosen[first] = True
            at, parts = 0, []
            for value, size in zip(values, sizes):
                parts.append(value[np.repeat(chosen[at : at + len(size)], size)])
                at += len(size)
            values.clear()
            value = np.concatenate(parts)
            parts.clear()
            value.sort()
            # Of sorted values, those of three or more equal ones: where they begin and end.
            begins = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.empty(0, np.int64)
            count = np.diff(np.append(begins, len(value)))
            value, count = value[begins[count > 2]], count[count > 2]
            none = pa.nulls(len(value), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(value), np.int32)), none, signed(value), pa.array(count.astype(np.int64)), pa.nulls(len(value), pa.binary())],
                ["kind", "doc_id", "key", "size", "bitmap"],
            )

        for batch in batches:
            for part in slices(batch, limit=SLICE):
                sets = Sets(part.column(1), k, np.empty(0, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(part.num_rows, np.int32)),
                        _ids(part),
                        pa.array(sets.key.view(np.int64), mask=sets.size == 0),
                        pa.array(sets.size.astype(np.int64)),
                        pa.array(sets.bitmaps(), pa.binary(), mask=sets.size == 0),
                    ],
                    ["kind", "doc_id", "key", "size", "bitmap"],
                )
                values.append(sets.value)
                sizes.append(sets.size)
                keys.append(sets.key)
                total += len(sets.value)
                del sets
                if total >= COUNTED_AT_ONCE:
                    yield frequent()
                    values, sizes, keys, total = [], [], [], 0
        if (last := frequent()) is not None:
            yield last

    return docs.mapInArrow(run, "kind int, doc_id long, key long, size long, bitmap binary")


def _postings(docs: DataFrame, k: int, frequent: np.ndarray) -> DataFrame:
    """(key, size, at) of first quarters; `at` is the upper part of the shingle, then its position."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                sets = Sets(part.column(1), k, shared.value)
                known = np.asarray(part.column(0).is_valid())
                _, rows = np.unique(sets.key, return_index=True)
                rows = rows[known[rows]]
                place = sets.prefixes(rows)
                row = sets.row[place]
                within = np.minimum(place - sets.first[row], PLACE_LIMIT).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(sets.key[row]),
                        pa.array(sets.size[row].astype(np.int32)),
                        signed(sets.value[place] & ~np.uint64(PLACE_LIMIT) | within),
                    ],
                    ["key", "size", "at"],
                )

    return docs.where(F.col("doc_id").isNotNull()).mapInArrow(run, "key long, size int, at long")


_SHARED = "shingle long, key long, size int, place int, pivot long, near boolean"


def _shared_lists(postings: DataFrame) -> DataFrame:
    """Postings of lists with two sets or more, each with the pivot of its block.

    Lists come sorted by size; the stream keeps one row between batches, so a
    list may have any length. `near`: position and size allow a link with the
    pivot.
    """

    def run(batches):
        tail = None  # the last row so far: (shingle, size, key, place), pivot (key, size, place), has a row before
        for batch in batches:
            shingle, size, key, place = (np.asarray(batch.column(i)).astype(np.int64) for i in (0, 2, 1, 3))
            if not len(shingle):
                continue
            if tail is not None:
                shingle, size, key, place = (np.concatenate([[t], x]) for t, x in zip(tail[0], (shingle, size, key, place)))
            repeat = np.zeros(len(shingle), bool)
            repeat[1:] = (shingle[1:] == shingle[:-1]) & (key[1:] == key[:-1])
            shingle, size, key, place = (x[~repeat] for x in (shingle, size, key, place))
            n = len(shingle)
            before = np.zeros(n, bool)
            before[1:] = shingle[1:] == shingle[:-1]
            index = np.arange(n)
            begins = ~before
            p_key, p_size, p_place = key.copy(), size.copy(), place.copy()
            if tail is not None:
                p_key[0], p_size[0], p_place[0] = tail[1]
            while True:
                start = np.maximum.accumulate(np.where(begins, index, 0))
                far = 3 * size > 4 * p_size[start]
                # The first set of each block that is too large begins the next.
                far &= np.concatenate([[True], ~(far[:-1] & (start[1:] == start[:-1]))])
                if not (far & ~begins).any():
                    break
                begins |= far
            pk, ps, pp = p_key[start], p_size[start], p_place[start]
            after = np.zeros(n, bool)
            after[:-1] = before[1:]
            if tail is not None:
                before[0] = tail[2]
            shared = before | after
            last = n - 1
            tail = ((shingle[last], size[last], key[last], place[last]), (pk[last], ps[last], pp[last]), before[last])
            shared[last] = False  # it is decided with the next batch
            yield _shared_rows(shared, shingle, key, size, place, pk, ps, pp)
        if tail is not None and tail[2]:
            (a, b, c, d), (pk, ps, pp), _ = tail
            one = lambda x: np.array([x], np.int64)
            yield _shared_rows(np.ones(1, bool), one(a), one(c), one(b), one(d), one(pk), one(ps), one(pp))

    shingle = F.shiftright("at", PLACE_BITS)
    dealt = postings.repartition(shingle)
    dealt = dealt.select(shingle.alias("shingle"), "key", "size", F.col("at").bitwiseAND(F.lit(PLACE_LIMIT)).cast("int").alias("place"))
    # Of shingles of a set that look equal the first place comes first, and stays.
    return dealt.sortWithinPartitions("shingle", "size", "key", "place").mapInArrow(run, _SHARED)


def _shared_rows(keep, shingle, key, size, place, pivot, pivot_size, pivot_place):
    near = (pivot != key) & (7 * np.minimum(size - place, pivot_size - pivot_place) >= 3 * (size + pivot_size))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shingle[keep]),
            pa.array(key[keep]),
            pa.array(size[keep].astype(np.int32)),
            pa.array(place[keep].astype(np.int32)),
            pa.array(pivot[keep]),
            pa.array(near[keep]),
        ],
        ["shingle", "key", "size", "place", "pivot", "near"],
    )


def _bloom(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter with one hash of the ids, as 64-bit words. Its size follows
    their number up to a bound (8 MB); beyond, it lets more rows through."""
    count = ids.count()
    bits = int(min(max(1 << (16 * count).bit_length(), BLOOM_BITS[0]), BLOOM_BITS[1]))
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    words = ids.select(bit.alias("bit")).select(
        F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask")
    )
    table = np.zeros(bits // 64, np.uint64)
    found = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    table[found["word"].to_numpy()] = found["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return table, bits


def _width(size: int) -> int:
    """Bytes of a shingle that a set of this size travels with."""
    return 2 if size <= QUARTERS else 4


def _upper(value: np.ndarray, width: int) -> np.ndarray:
    """The upper `width` bytes of unsigned values, in their order."""
    return (value >> value.dtype.type(8 * (value.dtype.itemsize - width))).astype(f"u{width}")


def _in_common(one: bytes, m: int, two: bytes, n: int) -> tuple[int, int]:
    """Shingles of the smaller of two sets that occur in the other one, and how many of
    them may be different ones that look equal. That there are more has a chance below
    1e-12. Of sets with unequal widths the wider is cut to the narrower."""
    (small, m), (large, n) = sorted(((one, m), (two, n)), key=lambda x: x[1])
    width = min(len(small) // m, len(large) // n)
    small, large = (_upper(np.frombuffer(x, f"u{len(x) // size}"), width) for x, size in ((small, m), (large, n)))
    at = np.minimum(np.searchsorted(large, small), n - 1)
    common = int((large[at] == small).sum())
    if width == 8:
        return common, 0
    # A shingle that is not in common looks like one of the n with this chance at most.
    spare = m
    for _ in range(2):
        chance = min(m - common + spare, m) * n / 256.0**width
        spare = min(spare, 4 + math.ceil(4 * chance + 8 * math.sqrt(chance)))
    return common, spare


def _whole_sets(docs: DataFrame, members: DataFrame, ends: DataFrame, k: int, whole: bool) -> DataFrame:
    """(key, size, shingles) of the sets in `ends`, from one document of each. A set's
    shingles are whole if `whole`, else their upper `_width` bytes."""
    ids = stage(
        members.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")).join(ends, "key", "left_semi"),
        "set_ends",
    )
    table, bits = _bloom(ids.select("doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))

    def run(batches):
        for batch in batches:
            place = np.asarray(batch.column(2)).astype(np.int64)
            hit = (shared.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
            for part in slices(batch.filter(pa.array(hit.astype(bool))), limit=SLICE):
                sets = Sets(part.column(1), k, np.empty(0, np.uint64))
                found = [
                    _upper(sets.value[a:b], 8 if whole else _width(b - a)).tobytes() for a, b in zip(sets.first[:-1], sets.first[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [signed(sets.key), pa.array(sets.size.astype(np.int32)), pa.array(found, pa.binary())],
                    ["key", "size", "shingles"],
                )

    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", bit.alias("bit"))
    found = known.mapInArrow(run, "key long, size int, shingles binary")
    # Rows with the text of a chosen document may come through, too: of equal sets one is
    # kept. Join and removal go by the key alone, so that sets are shuffled once.
    return found.join(ids.select("key"), "key", "left_semi").dropDuplicates(["key"])


def _possible(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`pairs` (a, b, ...) that their bitmaps allow to link."""

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            columns = (batch.column(i) for i in range(batch.num_columns - 4, batch.num_columns))
            for i, (x, m, y, n) in enumerate(zip(*columns)):
                one, two = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                small, large = (one, two) if len(one) <= len(two) else (two, one)
                while len(large) > len(small):
                    half = len(large) // 2
                    large = large[:half] ^ large[half:]
                differ = int(np.bitwise_count(small ^ large).sum())
                keep[i] = 7 * differ <= m.as_py() + n.as_py()
            yield batch.select(batch.schema.names[:-4]).filter(pa.array(keep))

    one = bitmaps.select(F.col("key").alias("a"), F.col("bitmap").alias("_x"), F.col("size").alias("_m"))
    two = bitmaps.select(F.col("key").alias("b"), F.col("bitmap").alias("_y"), F.col("size").alias("_n"))
    joined = pairs.join(one, "a").join(two, "b").select(*pairs.columns, "_x", "_m", "_y", "_n")
    return joined.mapInArrow(run, pairs.schema)


def _compared(docs: DataFrame, members: DataFrame, pairs: DataFrame, k: int, whole: bool) -> DataFrame:
    """`pairs` (a, b) with the size of both sets, of what they have in common, and
    how many of the latter may be different shingles that look equal."""
    ends = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    sets = _whole_sets(docs, members, ends, k, whole)

    def run(batches):
        for batch in batches:
            m, n = (np.asarray(batch.column(i)).astype(np.int64) for i in (2, 4))
            found = [
                _in_common(x.as_py(), int(i), y.as_py(), int(j)) for x, i, y, j in zip(batch.column(3), m, batch.column(5), n)
            ]
            common, spare = (pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), common, pa.array(m), pa.array(n), spare],
                ["a", "b", "common", "size_a", "size_b", "spare"],
            )

    one = sets.select(F.col("key").alias("a"), F.col("size").alias("m"), F.col("shingles").alias("one"))
    two = sets.select(F.col("key").alias("b"), F.col("size").alias("n"), F.col("shingles").alias("two"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "m", "one", "n", "two")
    return joined.mapInArrow(run, "a long, b long, common long, size_a long, size_b long, spare long")


# Pairs that link at the least they have in common, and at the most.
LINKED = "100 * (common - spare) >= 75 * (size_a + size_b - common + spare)"
AT_MOST = "100 * common >= 75 * (size_a + size_b - common)"


def _verified(docs: DataFrame, members: DataFrame, pairs: DataFrame, k: int, name: str) -> DataFrame:
    """`pairs` compared by parts of shingles, which need a quarter or half of the
    shuffle; those that this doesn't decide are compared by whole ones, so LINKED
    holds for the links."""
    parts = stage(_compared(docs, members, pairs, k, False), name)
    unclear = f"{AT_MOST} and not {LINKED}"
    whole = stage(_compared(docs, members, parts.where(unclear).select("a", "b"), k, True), name)
    return parts.where(f"not ({unclear})").union(whole)


def _mixed_lists(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Postings of lists with sets of two components or more, with the component."""
    placed = lists.select("shingle", "key", "size", "place").join(found.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.withColumn("component", F.coalesce("component", "key"))
    mixed = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(mixed.where("low < high"), "shingle", "left_semi")


def _drawn_pairs(placed: DataFrame, bitmaps: DataFrame, draw: int) -> DataFrame:
    """Pairs (a, b, place) of a set and a pivot of another component in one of its
    lists, by how many lists they share; the bitmaps are asked about the first ones only.

    A list's pivots are the sets that come first by a hash; the same ones come
    first in most lists of similar sets."""
    order = [F.xxhash64("key", F.lit(PIVOTS * draw + i)) for i in range(PIVOTS)]
    first = [F.struct(F.min_by("key", h).alias("b"), F.min_by("component", h).alias("other")) for h in order]
    pivots = placed.groupBy("shingle").agg(F.array(*first).alias("pivots"))
    met = placed.join(pivots, "shingle").select(F.col("key").alias("a"), "component", F.explode(F.array_distinct("pivots")).alias("p"))
    votes = met.where("p.other <> component").groupBy("a", F.col("p.b").alias("b")).agg(F.count("*").alias("votes"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("votes"), "b"))
    return _possible(votes.withColumn("place", place).where(F.col("place") <= COMPARED).select("a", "b", "place"), bitmaps)


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """`pairs` (a, b) of sets in different components."""
    for end in ("a", "b"):
        pairs = pairs.join(found.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")), end, "left")
    return pairs.where("coalesce(_a, a) <> coalesce(_b, b)").select("a", "b")


def link_components(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable by links, itself included.
    Texts of fewer than k words are one shingle; null texts and texts without
    words have an empty set and link with nothing. Rows without id link with
    nothing and have a null component. Rows that repeat an id are one document:
    it links with what any of its texts links with. An empty table stays empty.
    """
    # The result reads written tables only: what needs small batches is over by then.
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _linked(docs, k)


def _linked(docs: DataFrame, k: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    summary = stage(_summaries(rows, k), "set_summaries")
    members = summary.where("kind = 0").select("doc_id", "key", "size")
    often = summary.where("kind = 1").groupBy("key").agg(F.sum("size").alias("sets")).where(F.col("sets") >= FREQUENT)
    frequent = [r.key for r in often.orderBy(F.desc("sets"), "key").limit(FREQUENT_LIMIT).select("key").collect()]
    frequent = np.sort(np.array(frequent, np.int64).view(np.uint64))

    lists = stage(_shared_lists(_postings(rows, k, frequent)), "set_lists")

    # Each set with the pivot it shares most lists with.
    in_lists = lists.select("key").distinct()
    bitmaps = summary.where("kind = 0 and key is not null").groupBy("key").agg(F.min("bitmap").alias("bitmap"), F.min("size").alias("size"))
    bitmaps = stage(bitmaps.join(in_lists, "key", "left_semi"), "set_bitmaps")
    votes = lists.where("near").groupBy(F.col("key").alias("a"), F.col("pivot").alias("b")).agg(F.count("*").alias("votes"))
    first = _possible(votes, bitmaps).groupBy("a").agg(F.max_by("b", F.struct("votes", "b")).alias("b"))
    with_pivot = _verified(rows, members, stage(first, "set_pivots"), k, "set_with_pivot")
    linked = with_pivot.where(LINKED).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    found = stage(components(linked), "set_components")
    # Components only grow, so mixed lists only become fewer.
    placed = stage(_mixed_lists(lists, found), "set_mixed_lists")
    for draw in range(1, ROUNDS + 1):
        drawn = stage(_drawn_pairs(placed, bitmaps, draw), "set_drawn")
        best = stage(drawn.groupBy("a").agg(F.min("place").alias("place")), "set_best_drawn")
        for others in (False, True):
            chosen = drawn.join(best, ["a", "place"], "left_anti" if others else "left_semi").select("a", "b")
            compared = _verified(rows, members, stage(_apart(chosen, found), "set_apart"), k, "set_with_drawn")
            linked = linked.union(compared.where(LINKED).select(F.col("a").alias("src"), F.col("b").alias("dst")))
            found = stage(components(linked), "set_components")
        placed = stage(_mixed_lists(placed, found), "set_mixed_lists")

    # Pairs of one list in different components, less what the pivots exclude.
    bounds = [F.expr(f"{x} / (size_a + size_b - ({x}))") for x in ("common - spare", "common")]
    known = with_pivot.select(F.col("a").alias("key"), F.col("b").alias("judge"), *(x.alias(n) for x, n in zip(bounds, ("low", "high"))))
    placed = stage(placed.join(known, "key", "left"), "set_judged_lists")
    x, y = placed.alias("x"), placed.alias("y")
    possible = F.expr(
        "x.shingle = y.shingle and x.component < y.component"
        " and 3 * x.size <= 4 * y.size and 3 * y.size <= 4 * x.size"
        " and 7 * least(x.size - x.place, y.size - y.place) >= 3 * (x.size + y.size)"
        " and not coalesce(x.judge = y.judge and greatest(x.low - y.high, y.low - x.high) > 0.25000001, false)"
        " and not coalesce(x.judge = y.key or y.judge = x.key, false)"
    )
    pairs = x.join(y, possible).select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    rest = _verified(rows, members, stage(_possible(pairs, bitmaps), "set_pairs"), k, "set_verified")
    more = rest.where(LINKED).select(F.col("a").alias("src"), F.col("b").alias("dst"))

    # Nodes are sets; rows that repeat an id tie its sets together.
    classes = members.where("doc_id is not null and key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    twice = members.where("doc_id is not null and key is not null").groupBy("doc_id")
    twice = twice.agg(F.min("key").alias("src"), F.max("key").alias("dst")).where("src < dst")
    several = members.join(twice, "doc_id").where("key is not null and key <> src").select("src", F.col("key").alias("dst"))
    final = stage(components(linked.union(more).union(several)), "set_components")
    named = classes.join(final.withColumnRenamed("node", "key"), "key", "left")
    named = named.withColumn("component", F.coalesce("component", "key"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = stage(named.join(least, "component").select(F.col("key").alias("_key"), "component_id"), "set_labels")
    return members.join(labels, F.col("key") == F.col("_key"), "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """`docs` with one row of each component: that of the smallest doc_id.

    Of rows that repeat this id the one with the smallest text stays (null first,
    then any of equal ones); rows without id stay.
    """
    found = link_components(docs, k)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    # Ids are narrow; whole rows move only where an id repeats.
    ids = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_n"))
    twice = stage(ids.where("_n > 1").select("_id"), "repeated_ids")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, F.col("doc_id") == F.col("_id"), "left_semi")
    first = again.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.struct("text")).alias("_row"))
    return kept.join(twice, F.col("doc_id") == F.col("_id"), "left_anti").union(first.select("_row.*"))
