"""Tokens of two tokenizers aligned by the bytes they cover.

A is a byte-level vocabulary over a space and the text, B a piece vocabulary over
the text, which adds the space itself: both cover the same bytes. All tokens of
both are sorted by their start (`lexsort`); with the running maximum of their ends,
a group breaks where a start reaches it. Inside a group the tokens that overlap
are expanded to pairs; the pairs whose ranges also end together are links.

How often a pair of ids is linked in the whole corpus is counted once, and goes
back to every document. Of two tokens that end together the shorter is a suffix of
the longer, so the two vocabularies alone bound the number of different pairs
(`Sides.most_pairs`, a few hundred thousand), whatever the corpus. Within
`MOST_BROADCAST` pairs the counts are broadcast and nothing but counts is shuffled;
for vocabularies beyond it links are joined with their counts instead.

Texts are cut at spaces and line breaks that follow no white space. No token crosses
such a place: A's pattern starts a new word there, and no piece of B has a space
behind another character, or a line break (checked when the vocabulary is loaded;
otherwise a text is one unit). So groups and links of a text are those of its units,
and each different unit of a batch is encoded and aligned once, many units together.
Workers remember at most `CACHE` short units.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from topicmill.llm.common import slices
from topicmill.session import stage

FOLDER = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_MARK = "▁"
# Fixed value: how byte-level tokenizers of this kind cut a text before they merge.
BYTE_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_BROADCAST = 4_000_000
CACHE = 1 << 17
CACHED_LENGTH = 48
# Characters of new units that are encoded together.
TOGETHER = 1 << 16
# Bytes of text, and links, that a task handles at once.
SLICE_TEXT, SLICE_LINKS = 1 << 20, 1 << 18


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level entries:
    printable bytes for themselves, the others counted from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Sides:
    """The two vocabulary files, as they are sent to tasks (some 2 MB)."""

    byte_json: str
    piece_model: bytes

    @classmethod
    def load(cls, folder: str = FOLDER, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE) -> Sides:
        with open(f"{folder}/{byte_file}", encoding="utf-8") as a, open(f"{folder}/{piece_file}", "rb") as b:
            return cls(a.read(), b.read())

    @cached_property
    def byte_tokens(self) -> list[bytes]:
        """Bytes of each id of A."""
        alphabet = byte_alphabet()
        vocabulary = json.loads(self.byte_json)["model"]["vocab"]
        found = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            found[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        return found

    @cached_property
    def piece_tokens(self) -> list[bytes]:
        """Bytes of each id of B."""
        model = sentencepiece.SentencePieceProcessor(model_proto=self.piece_model)
        return [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE_MARK, " ").encode()
            for i in range(model.get_piece_size())
        ]

    @cached_property
    def ranks(self) -> dict[bytes, int] | None:
        """Entries of A with their ids as merge ranks, for the faster encoder; None
        where merges are not in the order of ids, so that it could not be the same."""
        model = json.loads(self.byte_json)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        vocabulary = model["model"]["vocab"]
        made = [vocabulary.get(a + b) for a, b in merges]
        added = {t["content"] for t in model.get("added_tokens") or []}
        plain = {e: i for e, i in vocabulary.items() if e not in added}
        ordered = made == sorted(x for x in made if x is not None) and len(plain) == 256 + len(merges)
        alphabet = byte_alphabet()
        return {bytes(alphabet[c] for c in e): i for e, i in plain.items()} if ordered else None

    @cached_property
    def most_pairs(self) -> int:
        """Pairs of ids of which one is a suffix of the other: all that can be linked."""
        a_ids, b_ids = _by_bytes(self.byte_tokens), _by_bytes(self.piece_tokens)
        suffixes = sum(n * b_ids.get(t[i:], 0) for t, n in a_ids.items() for i in range(len(t)))
        return suffixes + sum(n * a_ids.get(t[i:], 0) for t, n in b_ids.items() for i in range(1, len(t)))


def _by_bytes(tokens: list[bytes]) -> dict[bytes, int]:
    counts: dict[bytes, int] = {}
    for t in tokens:
        counts[t] = counts.get(t, 0) + 1
    return counts


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of intervals by start, and the number of the group that each of the
    ordered ones is in: a group breaks where a start reaches the maximum of all
    ends before it."""
    order = np.lexsort((-ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(breaks) - 1


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in A, place in B) of tokens that share a byte.

    Both sides cover the same bytes without gaps, so each stretch between two
    neighbouring ends lies in one token of either side: that is one pair.
    """
    ends = np.sort(np.concatenate([a_end, b_end]))
    ends = ends[np.append(ends[1:] != ends[:-1], True)[: len(ends)]]
    return np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")

def _encoder(sides: Sides) -> Callable[[str], list[int]]:
    """Side A's encoder. The same merges run several times faster by rank; tests
    hold that against the tokenizer of the file itself."""
    if sides.ranks:
        fast = tiktoken.Encoding("sides", pat_str=BYTE_PATTERN, mergeable_ranks=sides.ranks, special_tokens={})
        return fast.encode_ordinary
    whole = tokenizers.Tokenizer.from_str(sides.byte_json)
    whole.encode_special_tokens = True
    return lambda text: whole.encode(text, add_special_tokens=False).ids


# n_a, n_b, n_overlaps, groups as text with a `;` behind each, links as 64-bit numbers.
Unit = tuple[int, int, int, bytes, bytes]
# What stands for a unit that a tokenizer changes.
CHANGED: Unit = (0, 0, 0, b"", b"")


class Aligner:
    """Aligns texts, unit by unit; lives in one Python worker.

    A unit starts with a space or a line break that follows no white space. Tokens
    of either side never cross its start, so both sides end there, no group crosses
    it either, and a text's groups and links are those of its units in turn.
    """

    def __init__(self, sides: Sides):
        self.encode_a = _encoder(sides)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=sides.piece_model)
        self.a_tokens, self.b_tokens = sides.byte_tokens, sides.piece_tokens
        self.a_length = np.array([len(t) for t in self.a_tokens], np.int64)
        self.b_length = np.array([len(t) for t in self.b_tokens], np.int64)
        self.width = len(self.b_length)
        self.space = self.b.piece_to_id(SPACE_MARK)
        splits = self.b_tokens[self.space] == b" " and not any(b" " in t.lstrip(b" ") for t in self.b_tokens)
        # A line break is a byte of its own on side B where no piece has one.
        breaks = "" if any(b"\n" in t and t != b"\n" for t in self.b_tokens) else r"\n"
        self.cut = re.compile(rf"[ {breaks}](?:[^ {breaks}]+|(?<=\s)[ {breaks}])*").findall if splits else lambda full: [full]
        ids = range(max(len(self.a_length), self.width))
        # An id with what follows it where groups are written.
        self.written = [[f"{i}{mark}".encode() for i in ids] for mark in (",", "|", ";")]
        self.seen: dict[str, Unit] = {}

    # --- encoding -------------------------------------------------------------------

    def _encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A and of B for a text that begins with a unit."""
        a = self.encode_a(text)
        if text == " ":  # the model adds a space, but none to an empty text
            return a, [self.space]
        return a, self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]

    def _tokens(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids for units in one go; None where a side changes a byte, or where its
        tokens don't end with the units."""
        data = b"".join(units)
        a, b = (np.array(ids, np.int64) for ids in self._encode(data.decode("utf-8", "surrogatepass")))
        for tokens, ids in ((self.a_tokens, a), (self.b_tokens, b)):
            if b"".join([tokens[i] for i in ids.tolist()]) != data:
                return None
        ends = np.cumsum([len(u) for u in units])
        fits = all(np.isin(ends, np.cumsum(length[ids])).all() for length, ids in ((self.a_length, a), (self.b_length, b)))
        return (a, b) if fits else None

    # --- alignment --------------------------------------------------------------------

    def _aligned(self, units: list[bytes], a: np.ndarray, b: np.ndarray) -> list[Unit]:
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        order, group = coalesce(np.concatenate([a_end - self.a_length[a], b_end - self.b_length[b]]), np.concatenate([a_end, b_end]))
        groups = np.empty(len(order), np.int64)
        groups[order] = group

        # Groups are written side by side, A first: the mark says what follows an id.
        side = np.repeat([0, 1], [len(a), len(b)])
        written = np.lexsort((np.arange(len(groups)), side, groups))
        side, of_group = side[written], groups[written]
        last = np.append((of_group[1:] != of_group[:-1]) | (side[1:] != side[:-1]), True)
        ids = np.concatenate([a, b])[written].tolist()
        spelled = [self.written[m][i] for m, i in zip(np.where(last, 1 + side, 0).tolist(), ids)]

        pair_a, pair_b = overlaps(a_end, b_end)
        held = a_end[pair_a] == b_end[pair_b]
        links = (a[pair_a] * self.width + b[pair_b])[held].tobytes()
        ends = np.cumsum([len(u) for u in units])
        a_of, b_of = (np.append(0, np.searchsorted(e, ends) + 1) for e in (a_end, b_end))
        pairs_of = np.searchsorted(pair_a, a_of)
        links_of = (8 * np.append(0, np.cumsum(held))[pairs_of]).tolist()
        numbers = [links[i:j] for i, j in zip(links_of, links_of[1:])]
        tokens_of = (a_of + b_of).tolist()
        texts = [b"".join(spelled[i:j]) for i, j in zip(tokens_of, tokens_of[1:])]
        return list(zip(np.diff(a_of).tolist(), np.diff(b_of).tolist(), np.diff(pairs_of).tolist(), texts, numbers))

    def learn(self, units: list[str]) -> dict[str, Unit]:
        """Aligns units, many together: those that end in white space, which only
        the last of a text does, would run into the next one and go alone."""
        found: dict[str, Unit] = {}

        def solve(some: list[str]) -> None:
            data = [u.encode("utf-8", "surrogatepass") for u in some]
            tokens = self._tokens(data)
            if tokens is not None:
                found.update(zip(some, self._aligned(data, *tokens)))
            elif len(some) == 1:
                found[some[0]] = CHANGED
            else:
                half = len(some) // 2
                solve(some[:half])
                solve(some[half:])

        together: list[str] = []
        size = 0
        for unit in units:
            if unit[-1].isspace() or not unit[1:]:
                solve([unit])
                continue
            together.append(unit)
            size += len(unit)
            if size > TOGETHER:
                solve(together)
                together, size = [], 0
        if together:
            solve(together)
        return found

    def align(self, texts: list[str | None]) -> tuple[dict[str, list], list[bytes]]:
        """Columns of results, and the links of each text."""
        seen = self.seen
        cut = [self.cut(" " + t) if t else [] for t in texts]
        known = [list(map(seen.get, units)) for units in cut]
        new = dict.fromkeys(u for units, entries in zip(cut, known) if None in entries for u, e in zip(units, entries) if e is None)
        local = self.learn(list(new))
        room = CACHE - len(seen)
        if room > 0:
            seen.update(islice(((u, e) for u, e in local.items() if len(u) <= CACHED_LENGTH), room))
        found: dict[str, list] = {name: [] for name in (*_COUNTS, "groups_sha256")}
        links = []
        for units, entries in zip(cut, known):
            if None in entries:
                entries = [local[u] if e is None else e for u, e in zip(units, entries)]
            if not entries or CHANGED in entries:
                values, numbers = (0, 0, 0, 0, 0, ""), b""
            else:
                n_a, n_b, n_overlaps, parts, held = zip(*entries)
                text, numbers = b"".join(parts), b"".join(held)
                digest = hashlib.sha256(text[:-1]).hexdigest()
                values = (sum(n_a), sum(n_b), text.count(b";"), len(numbers) // 8, sum(n_overlaps), digest)
            for column, value in zip(found.values(), values):
                column.append(value)
            links.append(numbers)
        return found, links


@lru_cache(maxsize=1)
def _aligner(sides: Sides) -> Aligner:
    """The worker's aligner, which keeps the units it knows from task to task."""
    return Aligner(sides)


def aligned(docs: DataFrame, sides: Sides) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, links) for the
    rows of `docs` (row, text). A link is `id of A * size of B + id of B`."""
    shared = docs.sparkSession.sparkContext.broadcast(sides)
    small = len(sides.byte_tokens) * len(sides.piece_tokens) < 1 << 31
    kind, place = (IntegerType(), pa.int32()) if small else (LongType(), pa.int64())
    schema = StructType(
        [docs.schema["row"], *[StructField(n, LongType()) for n in _COUNTS], StructField("groups_sha256", StringType()), StructField("links", ArrayType(kind))]
    )

    def run(batches):
        aligner = _aligner(shared.value)
        for batch in batches:
            for part in slices(batch, limit=SLICE_TEXT):
                found, links = aligner.align(part.column(1).to_pylist())
                ends = np.cumsum([0, *[len(x) // 8 for x in links]])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(links), np.int64)).cast(place))
                columns = [pa.array(v, pa.string() if n == "groups_sha256" else pa.int64()) for n, v in found.items()]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, lists], schema.fieldNames())

    return docs.select("row", "text").mapInArrow(run, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, count): links of the whole corpus that hold each pair of ids."""
    return found.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))


def _by_links(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `SLICE_LINKS` links, one row at least."""
    ends = np.cumsum(batch.column(batch.num_columns - 1).value_lengths().to_numpy(zero_copy_only=False))
    at, base = 0, 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, base + SLICE_LINKS, "right")))
        yield batch.slice(at, stop - at)
        at, base = stop, int(ends[stop - 1])


def _scored_by_broadcast(found: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    table = counts.toArrow()
    pairs, numbers = np.asarray(table.column(0)), np.asarray(table.column(1))
    order = np.argsort(pairs)
    shared = found.sparkSession.sparkContext.broadcast((pairs[order], numbers[order]))
    kept = [f for f in found.schema.fields if f.name != "links"]
    schema = StructType([*kept, StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def run(batches):
        pairs, numbers = shared.value
        best = np.zeros(width, np.int64)
        np.maximum.at(best, pairs % width, numbers)
        for batch in batches:
            for part in _by_links(batch):
                lists = part.column(part.num_columns - 1)
                links = np.asarray(lists.flatten())
                ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
                count = numbers[np.searchsorted(pairs, links)] if len(links) else np.empty(0, np.int64)
                sums = [np.append(0, np.cumsum(x)) for x in (count == best[links % width], count)]
                scores = [pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()) for s in sums]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *scores], schema.fieldNames())

    return found.select(*[f.name for f in kept], "links").mapInArrow(run, schema)


def _scored_by_join(found: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """For vocabularies whose pairs are too many to send to every task: the
    distinct pairs of each document meet their counts in a join."""
    numbered = stage(found.withColumn("_n", F.monotonically_increasing_id()), "aligned_rows")
    held = numbered.select("_n", F.explode("links").alias("pair")).groupBy("_n", "pair").agg(F.count("*").alias("times"))
    best = counts.groupBy(F.pmod("pair", F.lit(width)).alias("b")).agg(F.max("count").alias("best"))
    rated = counts.join(best, F.pmod("pair", F.lit(width)) == F.col("b"))
    rated = stage(rated.select("pair", "count", (F.col("count") == F.col("best")).alias("is_best")), "rated_pairs")
    scores = held.join(rated, "pair").groupBy("_n").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    return numbered.drop("links").join(scores, "_n", "left").drop("_n").fillna({"n_best": 0, "count_sum": 0})


def align_tokenizers(docs: DataFrame, sides: Sides | None = None, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """`docs` without its text, with n_a, n_b (tokens), n_groups, n_links,
    n_overlaps (pairs that share a byte), groups_sha256, n_best, count_sum.

    Texts that are null, empty, or changed by either tokenizer have no tokens:
    zeros, and an empty groups_sha256. Of a link, `count` is how many links of all
    rows hold its pair of ids, repeated rows included; n_best has the links whose
    count is the highest among the pairs of their B id, ties included. Other
    columns pass through whatever their names; those named like an output are
    replaced.
    """
    sides = sides or Sides.load()
    made = [*_COUNTS, "groups_sha256", "n_best", "count_sum"]
    columns = [c for c in docs.columns if c not in ("text", *made)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    found = stage(aligned(rows, sides), "aligned_documents")
    counts = stage(pair_counts(found), "pair_counts")
    score = _scored_by_broadcast if sides.most_pairs <= most_broadcast else _scored_by_join
    return score(found, counts, len(sides.piece_tokens)).select("row.*", *made)
