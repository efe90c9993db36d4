"""Alignment against a plain one that encodes whole texts with both tokenizers."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topicmill.llm import alignment
from topicmill.llm.alignment import Sides

SIDES = Sides.load()
NONE = (0, 0, 0, 0, 0, "", [])


@pytest.fixture(scope="module")
def tokenizers_():
    a = Tokenizer.from_str(SIDES.byte_json)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=SIDES.piece_model)


def plain(text, tokenizers_):
    if not text:
        return NONE
    a = tokenizers_[0].encode(" " + text, add_special_tokens=False).ids
    b = tokenizers_[1].encode(text)
    data = (" " + text).encode()
    sides = [[table[i] for i in ids] for table, ids in ((SIDES.byte_tokens, a), (SIDES.piece_tokens, b))]
    if any(b"".join(s) != data for s in sides):
        return NONE
    ends = [np.cumsum([len(t) for t in s]).tolist() for s in sides]
    common = sorted(set(ends[0]) & set(ends[1]))
    groups, low = [], 0
    for high in common:
        groups.append("|".join(",".join(str(i) for i, e in zip(ids, end) if low < e <= high) for ids, end in zip((a, b), ends)))
        low = high
    links = [(i, j) for i, e in zip(a, ends[0]) for j, f in zip(b, ends[1]) if e == f]
    starts = [[e - len(t) for e, t in zip(end, s)] for end, s in zip(ends, sides)]
    shared = sum(max(s, u) < min(e, f) for s, e in zip(starts[0], ends[0]) for u, f in zip(starts[1], ends[1]))
    return len(a), len(b), len(groups), len(links), shared, hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def expected(texts, tokenizers_):
    found = [plain(t, tokenizers_) for t in texts]
    counts = Counter(link for f in found for link in f[6])
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [(*f[:6], sum(counts[x] == best[x[1]] for x in f[6]), sum(counts[x] for x in f[6])) for f in found]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    words = "the thing Internationalization naïve über 漢字 🙂 don't 3.14159 foo_bar <|endoftext|> <s> </s> ﬁ é    x \x00 \x1c! A​B ..".split(" ")
    gaps = [" ", " ", " ", "  ", "\n", "\n\n ", " \t", "\r\n", ""]
    found = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randrange(1, 25))) for _ in range(150)]
    return [*found, None, "", " ", "\n", "   ", " a", "a ", "▁", "a▁b", "x" * 3000, "the", "the", "the thing " * 400]


def columns(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "n_best", "count_sum"]
    return [tuple(r[n] for n in names) for r in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("most_broadcast", [alignment.MOST_BROADCAST, 0], ids=["broadcast", "join"])
def test_alignment(spark, texts, tokenizers_, most_broadcast):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = columns(alignment.align_tokenizers(docs, SIDES, most_broadcast))
    assert found == expected(texts, tokenizers_)
    assert sum(f[0] > 0 for f in found) > 150


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sab.\r　\x1c\x85")), max_size=60))
def test_units_are_whole_texts(tokenizers_, text):
    aligner = _ALIGNER
    found, links = aligner.align([text])
    want = plain(text, tokenizers_)
    assert tuple(found[n][0] for n in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256")) == want[:6]
    assert np.frombuffer(links[0], np.int64).tolist() == [i * aligner.width + j for i, j in want[6]]


_ALIGNER = alignment.Aligner(SIDES)


def test_fast_encoder_is_the_files_own(tokenizers_):
    """Every entry comes back as itself, so a merge by rank is a merge of the file;
    every code point is cut alike."""
    whole = lambda t: tokenizers_[0].encode(t, add_special_tokens=False).ids
    assert SIDES.ranks is not None
    for entry, i in SIDES.ranks.items():
        try:
            assert whole(entry.decode()) == [i]
        except UnicodeDecodeError:
            pass
    points = [p for p in range(0x30000) if not 0xD800 <= p < 0xE000]
    for at in range(0, len(points), 4096):
        text = "".join(f" a{chr(p)}b '{chr(p)}" for p in points[at : at + 4096])
        assert whole(text) == _ALIGNER.encode_a(text)


def test_bound_on_pairs_holds(texts):
    pairs = {p for links in _ALIGNER.align(texts)[1] for p in np.frombuffer(links, np.int64).tolist()}
    for p in pairs:
        a, b = SIDES.byte_tokens[p // _ALIGNER.width], SIDES.piece_tokens[p % _ALIGNER.width]
        assert a.endswith(b) or b.endswith(a)
    assert SIDES.most_pairs < alignment.MOST_BROADCAST


def test_coalesce():
    starts, ends = np.array([0, 5, 2, 9, 5]), np.array([3, 9, 5, 12, 6])
    order, group = alignment.coalesce(starts, ends)
    assert order.tolist() == [0, 2, 1, 4, 3] and group.tolist() == [0, 0, 1, 1, 2]
    assert [len(x) for x in alignment.coalesce(starts[:0], ends[:0])] == [0, 0]


def test_no_rows_and_other_columns(spark, tokenizers_):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(docs, SIDES).count() == 0
    names = ["row", "links", "pair", "count", "_n", "times", "best", "b", "n_a"]
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string").withColumns({n: F.lit(n) for n in names})
    for most in (alignment.MOST_BROADCAST, 0):
        found = alignment.align_tokenizers(docs, SIDES, most)
        assert sorted(columns(found)) == sorted(expected(["a b", "a b", "c"], tokenizers_))
        for r in found.collect():
            assert [r[n] for n in names[:-1]] == names[:-1]
