"""A cuckoo filter in numpy: insertion, deletion, and membership of many keys.

Keys are pairs of 64-bit hashes. A fingerprint of 16 bits lives in one of two
buckets of four slots; either bucket follows from the other and the fingerprint,
so that entries can move without their keys. A filter that cannot place a
fingerprint gets another table, twice as large: nothing is ever refused. There
are no false negatives for keys that were inserted and not deleted.
"""

from __future__ import annotations

import struct

import numpy as np

SLOTS = 4
# Moves after which a table counts as full.
MOST_MOVES = 200
FIRST_BUCKETS = 64

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    def __init__(self, tables: list[np.ndarray] | None = None):
        self.tables = tables if tables is not None else []

    # --- bytes -----------------------------------------------------------------

    @classmethod
    def load(cls, data: bytes | None) -> CuckooFilter:
        tables, at = [], 0
        while data is not None and at < len(data):
            (buckets,) = struct.unpack_from("<q", data, at)
            size = buckets * SLOTS * 2
            tables.append(np.frombuffer(data, np.uint16, buckets * SLOTS, at + 8).reshape(buckets, SLOTS))
            at += 8 + size
        return cls(tables)

    def dump(self) -> bytes:
        return b"".join(struct.pack("<q", len(t)) + t.tobytes() for t in self.tables)

    # --- places -----------------------------------------------------------------

    @staticmethod
    def _prints(low: np.ndarray) -> np.ndarray:
        """Fingerprints from 1 on; 0 marks an empty slot."""
        return ((low.view(np.uint64) >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    @staticmethod
    def _first(high: np.ndarray, buckets: int) -> np.ndarray:
        return ((high.view(np.uint64) * _SPREAD) >> np.uint64(20)) & np.uint64(buckets - 1)

    @staticmethod
    def _other(bucket, prints, buckets: int):
        """The partner bucket: its own inverse, the number of buckets is a power of 2."""
        return bucket ^ (((prints.astype(np.uint64) * _SPREAD) >> np.uint64(17)) & np.uint64(buckets - 1))

    # --- many keys ----------------------------------------------------------------

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Whether each key may be in; true for all that are."""
        found = np.zeros(len(high), bool)
        prints = self._prints(low)
        for table in self.tables:
            one = self._first(high, len(table))
            two = self._other(one, prints, len(table))
            found |= (table[one] == prints[:, None]).any(1) | (table[two] == prints[:, None]).any(1)
        return found

    def insert(self, high: np.ndarray, low: np.ndarray) -> None:
        """Adds keys; one added twice is in twice."""
        self.tables = [t if t.flags.writeable else t.copy() for t in self.tables]
        for h, p in zip(high, self._prints(low)):
            if not self.tables:
                self.tables.append(np.zeros((FIRST_BUCKETS, SLOTS), np.uint16))
            self._place(h, p)

    def _place(self, high: np.int64, mark: np.uint16) -> None:
        table = self.tables[-1]
        buckets = len(table)
        one = int(self._first(np.array([high]), buckets)[0])
        two = self._partner(one, int(mark), buckets)
        for bucket in (one, two):
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = mark
                return
        at, held, moved = two, int(mark), []
        for k in range(MOST_MOVES):
            slot = (at + k) % SLOTS
            moved.append((at, slot))
            held, table[at, slot] = int(table[at, slot]), held
            at = self._partner(at, held, buckets)
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = held
                return
        for bucket, slot in reversed(moved):  # put all back, then go on in a larger table
            held, table[bucket, slot] = int(table[bucket, slot]), held
        self.tables.append(np.zeros((2 * buckets, SLOTS), np.uint16))
        self._place(high, mark)

    @staticmethod
    def _partner(bucket: int, mark: int, buckets: int) -> int:
        return bucket ^ (((mark * int(_SPREAD)) & 0xFFFFFFFFFFFFFFFF) >> 17) & (buckets - 1)

    def delete(self, high: np.ndarray, low: np.ndarray) -> None:
        """Takes out keys that are in, each once."""
        self.tables = [t if t.flags.writeable else t.copy() for t in self.tables]
        for h, p in zip(high, self._prints(low)):
            for table in self.tables:
                one = int(self._first(np.array([h]), len(table))[0])
                bucket = next((b for b in (one, self._partner(one, int(p), len(table))) if (table[b] == p).any()), None)
                if bucket is not None:
                    table[bucket, np.flatnonzero(table[bucket] == p)[0]] = 0
                    break
            else:
                raise KeyError("the key is not in the filter")
        self.tables = [t for t in self.tables if t.any()]

    def __len__(self) -> int:
        return int(sum(np.count_nonzero(t) for t in self.tables))
