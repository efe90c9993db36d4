"""Token counts of a unigram tokenizer without making its tokens.

Text is cut before every space, as the tokenizer's own pre-tokenizer does. In a
piece an Aho-Corasick automaton enumerates all vocabulary matches by their end,
and dynamic programming keeps the best score and the number of tokens on the best
path for each end. Tie rules are the tokenizer's: the score decides, equal scores
go to the match that starts first; a character that is no vocabulary entry by
itself may be taken as unknown, for ten less than the lowest score of the
vocabulary, and then counts as its UTF-8 bytes where the vocabulary has them
(neighbouring unknown characters count once where it hasn't).

Narrow: no shuffle. Tasks read whole texts one batch at a time and remember the
counts of pieces they have seen, at most `CACHE` of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# The mark for a space, and the penalty of an unknown character.
SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 1 << 19
CACHED_LENGTH = 48


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores, and whether unknown characters fall back to bytes."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Vocabulary:
        """Pieces of a model file, read on the driver; sent to tasks as they are
        (tens of thousands of short strings, whatever the data)."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))
        return cls(pieces, any(model.is_byte(i) for i in range(len(pieces))))


class Counter:
    """Counts tokens of texts; lives in one task."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = vocabulary.byte_fallback
        self.seen: dict[str, int] = {}

    def piece(self, text: str) -> int:
        """Tokens on the best path of a piece."""
        n = len(text)
        best, count, was_unknown = [0.0] * (n + 1), [0] * (n + 1), bytearray(n + 1)
        at, top, start, single = 1, -math.inf, n, False  # the end being decided

        def close(end, top, start, single):
            if not single and self.unknown + best[end - 1] > top:
                best[end] = self.unknown + best[end - 1]
                if self.byte_fallback:
                    count[end] = count[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))
                else:
                    count[end] = count[end - 1] + (not was_unknown[end - 1])
                    was_unknown[end] = 1
            else:
                best[end], count[end] = top, count[start] + 1

        # Matches come ordered by their end.
        for last, (length, score) in self.automaton.iter(text):
            while at <= last:
                close(at, top, start, single)
                at, top, start, single = at + 1, -math.inf, n, False
            begin = at - length
            reached = score + best[begin]
            if reached > top or (reached == top and begin < start):
                top, start = reached, begin
            if length == 1:
                single = True
        while at <= n:
            close(at, top, start, single)
            at, top, start, single = at + 1, -math.inf, n, False
        return count[n]

    def text(self, text: str | None) -> int:
        """Tokens of a whole text; null and empty texts have none."""
        if not text:
            return 0
        marked = text.replace(" ", SPACE_MARK)
        if marked[0] == SPACE_MARK:
            marked = marked[1:]
        seen, total = self.seen, 0
        for word in marked.split(SPACE_MARK):
            known = seen.get(word)
            if known is None:
                known = self.piece(SPACE_MARK + word)
                if len(word) <= CACHED_LENGTH:
                    if len(seen) >= CACHE:
                        seen.clear()
                    seen[word] = known
            total += known
        return total


def with_token_counts(
    docs: DataFrame, vocabulary: Vocabulary | None = None, text_col: str = "text", output: str = "n_tokens"
) -> DataFrame:
    """`docs` with the number of tokens of each text.

    Null and empty texts have 0. Repeated rows stay; other columns pass through,
    one named like the output is replaced.
    """
    vocabulary = vocabulary or Vocabulary.load()
    kept = [c for c in docs.columns if c != output]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    place = kept.index(text_col)

    def count(batches):
        counter = Counter(shared.value)
        for batch in batches:
            totals = [counter.text(t.as_py()) for t in batch.column(place)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(totals, pa.int64())], [*batch.schema.names, output]
            )

    source = docs.select(*kept)
    schema = StructType([*source.schema.fields, StructField(output, LongType())])
    return source.mapInArrow(count, schema)
