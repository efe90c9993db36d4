"""What several operators share: tables, words as numpy spans, hashes of words.

The numpy part works on slices of a batch with a bounded number of bytes, so the
memory of a Python worker does not depend on the batch size; only a single text
longer than a slice is taken whole.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The two kinds of words that results are defined by.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    # A text of ASCII only has no other letters, and `lower` is much the faster.
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, ASCII_UPPER, ASCII_LOWER))


def shielded(*needed: str, made: tuple[str, ...]) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Lets an operator pass columns through whatever their names.

    The operator sees the `needed` columns, and all others under names that it
    never uses itself; they get their names back in its result, which is the given
    columns in their order, then the `made` ones. Given columns named like a made
    one are replaced. Plain columns, so that pruning goes on working.
    """

    def decorate(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def run(table: DataFrame, *args, **options) -> DataFrame:
            own = {*needed, *(v for k, v in options.items() if k.endswith("_col"))}
            kept = [c for c in table.columns if c not in made]
            inner = {c: c if c in own else f"_other{i}" for i, c in enumerate(kept)}
            found = operator(table.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()]), *args, **options)
            return found.select(*[F.col(n).alias(c) for c, n in inner.items()], *made)

        return run

    return decorate


def row_key(*cols: str) -> list[Column]:
    """Two 64-bit hashes that tell rows apart by these columns, nulls included.

    A key from content, not from row order: a recomputed task gives the same.
    """
    parts = [part for c in cols for part in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"_k{seed}") for seed in (1, 2)]


# --- words of whole batches ---------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a public bijection), so that all bits count."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """Hashes of many spans of one sequence from a single running sum.

    Value of span [a, b): sum of x[i] * base**(i - a), mixed with its length.
    Arithmetic wraps at 2**64; the base is odd, so it has an inverse.
    """

    def __init__(self, seed: int):
        self.base = np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % (1 << 64) | 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self._up = self._down = np.empty(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._up) < n:
            ones = np.full(max(n, 1 << 16), 1, np.uint64)
            for name, base in (("_up", self.base), ("_down", self.inverse)):
                ones[1:] = base
                setattr(self, name, np.multiply.accumulate(ones))

    def spans(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(values)
        self._powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self._up[:n], out=total[1:])
        raw = (total[end] - total[start]) * self._down[start]
        return _mix(raw ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


BYTE_VALUES = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
_SPACES = np.zeros(256, bool)
_SPACES[list(SPACE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Words of a slice of texts: byte spans in `data`, and the row of each.

    `first[i]:first[i + 1]` are the words of row i. Null texts have no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        if lower:
            self.data = _LOWER[self.data]
        bounds = offsets - offsets[0]
        word = ~_SPACES[self.data]
        n = len(word)
        begins, ends = word.copy(), word.copy()
        if n:
            begins[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            edges = bounds[(bounds > 0) & (bounds < n)]
            begins[edges] = word[edges]
            ends[edges - 1] = word[edges - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.rows = len(texts)

    def hashes(self, rolling: RollingHash) -> np.ndarray:
        return rolling.spans(BYTE_VALUES[self.data], self.start, self.end)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word of each window of k words within one row, and its row."""
        counts = np.maximum(np.diff(self.first) - k + 1, 0)
        row = np.repeat(np.arange(self.rows), counts)
        within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.first[row] + within, row


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most `limit` bytes of text, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = column.cast(pa.large_binary())
    ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset + 1 : sizes.offset + len(sizes) + 1]
    at, base = 0, int(ends[0]) if len(ends) else 0
    if len(ends):
        base = int(np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset])
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, stop - at)
        at, base = stop, int(ends[stop - 1])


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark's long."""
    return pa.array(x.view(np.int64))
