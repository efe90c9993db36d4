"""Line dedup against brute force, and an index against one that never changed."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicmill.llm import line_dedup
from topicmill.llm.cuckoo import CuckooFilter
from topicmill.llm.line_dedup import LineIndex

SPACES = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def key_of(line):
    return line.strip(SPACES).translate(UPPER)


def expected(rows, index=None):
    holders = {}
    for doc, text in rows if index is None else index:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of(line)) >= 20:
                holders.setdefault(key_of(line), set()).add(doc)
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        goes = [doc is not None and len(holders.get(key_of(x), ())) >= 3 and max(holders[key_of(x)]) != doc for x in lines]
        found.append((doc, len(lines), sum(goes), "\n".join(x for x, g in zip(lines, goes) if not g)))
    return sorted(found, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    pool = [f"Shared line number {i} " + "x" * (i % 7) for i in range(30)]
    pool += ["é" * 19, "é" * 20, "É" * 20, "k" * 19, "K" * 20, "  " + "k" * 20 + "\t\r", " " + "k" * 20, "short", "", " "]
    found = []
    for i in range(120):
        lines = [draw.choice(pool) if draw.random() < 0.5 else f"own {i} {draw.random()} and more" for _ in range(draw.randrange(1, 9))]
        found.append((i, "\n".join(lines)))
    found += [(200, None), (201, ""), (202, "\n\n"), (203, pool[0] + "\n" + pool[0].upper()), (204, "y" * 50_000), (None, pool[0]), (None, None)]
    return found + [found[7], (7, pool[1]), (205, "\x00" * 25), (206, "\x00" * 25), (207, "\x00" * 25)]


@pytest.mark.parametrize("most_broadcast", [line_dedup.MOST_BROADCAST, 0], ids=["in place", "by shard"])
def test_lines(spark, rows, most_broadcast):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = LineIndex(spark).insert(docs).clean(docs, most_broadcast)
    assert result(found) == expected(rows)
    assert result(line_dedup.dedup_lines(docs)) == expected(rows)
    assert sum(n for _, _, n, _ in expected(rows)) > 50


def test_deletions_are_reversible(spark, rows):
    known = [r for r in rows if r[0] is not None]
    docs = spark.createDataFrame(known, SCHEMA)
    stays, goes = docs.where("doc_id % 3 != 1"), docs.where("doc_id % 3 = 1")
    left = [r for r in known if r[0] % 3 != 1]
    plain = LineIndex(spark).insert(stays)
    changed = LineIndex(spark).insert(goes).insert(docs).insert(docs).delete(goes.select("doc_id"))
    changed = changed.delete(spark.createDataFrame([(10**9,), (None,)], "doc_id long"))
    order = ["high", "low"]
    assert changed.counts.orderBy(*order).collect() == plain.counts.orderBy(*order).collect()
    assert changed.postings.orderBy(*order, "doc_id").collect() == plain.postings.orderBy(*order, "doc_id").collect()
    sizes = [sum(len(CuckooFilter.load(bytes(r.data))) for r in i.filters.collect()) for i in (plain, changed)]
    assert sizes[0] == sizes[1] == plain.repeated().count() > 0
    assert result(changed.clean(docs)) == expected(known, left)
    empty = changed.delete(docs.select("doc_id"))
    assert empty.counts.count() == empty.postings.count() == empty.filters.count() == 0
    assert sum(r[2] for r in result(empty.clean(docs))) == 0


def test_saved_index(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA)
    LineIndex(spark).insert(docs).save(str(tmp_path / "index"))
    assert result(LineIndex.load(spark, str(tmp_path / "index")).clean(docs)) == expected(rows)


def test_no_rows_and_other_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup_lines(none).count() == 0
    names = ["row", "keys", "_id", "_doc", "_text", "high", "low", "top", "n", "shard", "kept", "n_lines"]
    rows = [(i, "a line that is long enough\nz") for i in range(4)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(n) for n in names})
    found = line_dedup.dedup_lines(docs)
    assert [r.kept for r in found.orderBy("doc_id").collect()] == ["z"] * 3 + [rows[0][1]]
    for r in found.collect():
        assert [r[n] for n in names[:-2]] == names[:-2]


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    high, low = (rng.integers(-(1 << 63), (1 << 63) - 1, 6000, dtype=np.int64) for _ in range(2))
    held = CuckooFilter()
    held.insert(high[:4000], low[:4000])  # grows through several tables
    held.insert(high[:10], low[:10])  # twice in
    assert len(held) == 4010 and len(held.tables) > 3
    again = CuckooFilter.load(held.dump())
    assert again.contains(high[:4000], low[:4000]).all()
    assert again.contains(high[4000:], low[4000:]).mean() < 0.02
    again.delete(high[:2000], low[:2000])
    assert len(again) == 2010
    assert again.contains(high[2000:4000], low[2000:4000]).all() and again.contains(high[:10], low[:10]).all()
    assert again.contains(high[10:2000], low[10:2000]).mean() < 0.02
    again.delete(np.append(high[:10], high[2000:4000]), np.append(low[:10], low[2000:4000]))
    assert len(again) == 0 and again.dump() == b""
    with pytest.raises(KeyError):
        again.delete(high[:1], low[:1])
    same = np.full(50, high[0])  # one key fifty times: its two buckets overflow into new tables
    held.insert(same, np.full(50, low[0]))
    assert len(held) == 4060
