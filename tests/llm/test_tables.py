"""Operators on pages, embeddings and sources against brute force."""

import base64
import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicmill.llm import components, embedding_dedup, mixing, url_filter, warc


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2000 + i) for i in range(1, 300)] + [(7, None), (5, 5)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        if b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    found = components.components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {(r.node, r.component) for r in found} == {(a, find(a)) for a in list(parent)} and len(found) == len(parent)
    assert components.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_warc_round_trip(spark, tmp_path):
    draw = random.Random(2)
    bodies = ["", None, "é" * 20_000, "<p>\r\n\r\nWARC/1.1\r\n</p>", "0\r\n\r\n"] + [
        "".join(draw.choice("abc é\r\n<>") for _ in range(draw.randrange(3000))) for _ in range(30)
    ]
    rows = [(i, f"http://h/{i}", draw.choice(bodies)) for i in range(80)] + [(90, None, "x\ny"), (91, "http://a\r\nb", "x\ny")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    largest = defaultdict(int)
    for i, _, html in rows:
        largest[html or ""] = max(largest[html or ""], i)
    for least in (0, 100):
        found = warc.archive_round_trip(pages, least, segment_bytes=500, chunk_bytes=64, records_per_file=7).collect()
        expected = set()
        for i, _, html in rows:
            data, top = (html or "").encode(), largest[html or ""]
            again = len(data) >= least and i != top
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            expected.add((i, len(data), digest, "revisit" if again else "response", top if again else None))
        assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found} == expected
        assert all(r.valid for r in found) and len(found) == len(rows)
        by_id = {r[0]: r[2] or "" for r in rows}
        assert all(bytes(r.payload).decode() == by_id[r.page_id] for r in found if r.record_type == "response")
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_broken_segments_are_seen(spark):
    rows = [("a", None, 1, None, "x"), ("b", "a", 3, 3, "z"), ("c", None, 1, None, "x"), ("d", "c", 2, 2, "y"), ("e", None, 1, None, "p"), ("f", "e", 2, 9, "q")]
    full = [(i, o, s, t, None, None, "response" if s == 1 else "continuation", None, None, bytearray(b, "ascii")) for i, o, s, t, b in rows]
    found = {r.record_id: (r.complete, r.block) for r in warc.reassemble(spark.createDataFrame(full, warc.RECORD)).collect()}
    assert found == {"a": (False, None), "c": (True, b"xy"), "e": (False, None)}
    assert warc.dechunk(b"3\r\nabc\r\n0\r\n\r\n") == b"abc" and warc.dechunk(b"5\r\nabc\r\n0\r\n\r\n") is None


def test_rows_without_id_in_archives(spark):
    pages = spark.createDataFrame([(None, "u", "same"), (4, "u", "same"), (4, "u", "same"), (None, "u", "one"), (None, "u", "one")], "page_id long, url string, html string")
    found = warc.archive_round_trip(pages).groupBy("page_id", "record_type").count().collect()
    assert {tuple(r) for r in found} == {(None, "revisit", 1), (4, "response", 2), (None, "response", 2)}


@pytest.mark.parametrize("url, host, path, rule", [
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/"),
    ("https://example.net/de/", "example.net", "/de/", "net/"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None),
    ("http://b.example.com/de/x://y/", "b.example.com", "/de/x://y/", "example.com/de/"),
    ("http://net", "net", "", None),
    ("nothing", "", "", None),
    (None, "", "", None),
    ("http://x.org/fr/", "x.org", "/fr/", "org/fr/"),
])
def test_url_rules(spark, url, host, path, rule):
    found = url_filter.judge(spark.createDataFrame([(1, url, None)], "page_id long, url string, html string")).first()
    assert (found.host, found.path, found.rule) == (host, path, rule)


def test_url_aliases(spark):
    link = '<link href="{}" rel="canonical">'
    hop = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        (1, "http://x.com/a", link.format("http://s.net/p")),  # alias of a blocked page
        (2, "http://s.net/p", ""),
        (3, "http://y.com/b", hop.format("http://x.com/a")),  # and of that alias
        (4, "http://z.com/c", link.format("http://z.org/fr/1")),  # allowed goes before blocked
        (5, "http://z.org/fr/1", hop.format("http://s.net/q")),
        (6, "http://s.net/q", None),
        (7, "http://w.com/k#top", ""),
        (8, "https://www.w.com/k/?utm_source=a", ""),
        (9, "http://w.com/k?page=2", ""),
        (9, "http://w.com/k?page=2", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("clash"))
    redirects = spark.createDataFrame([("http://w.com/k", "http://s.net/q2"), (None, "x"), ("http://s.net/q2", "http://v.com/")], "url string, target string")
    found = {r.page_id: r.verdict for r in url_filter.judge(pages, redirects=redirects).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "block", 9: "allow"}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_mixing(spark):
    draw = random.Random(6)
    rows = [(i, draw.choice(["hot"] * 12 + ["a", "b", "B", None]), "w " * draw.randrange(60)) for i in range(700)]
    rows += [(800, "tiny", "p q"), (900, "tiny", None), (901, "a", ""), (None, "b", "x y z"), (5, "hot", "again here")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash"))
    found = mixing.mix(docs)
    taken = found.collect()
    sizes, words = defaultdict(int), defaultdict(int)
    for r in taken:
        assert r.size == len((r.text or "").split()) and r.taken <= 3 * r.size
        sizes[r.source] += r.size
        words[r.source] += r.taken
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [5, 2, 1] * 3))
    total, free, target = sum(sizes.values()), set(sizes), {}
    while True:
        rest = total - sum(target.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    assert any(target[s] == 3 * sizes[s] and sizes[s] for s in sizes)
    for r in taken:
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9) and r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(words[s] - target[s]) <= 5
    key = lambda r: (r.doc_id or -1, r.text or "")
    assert sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()), key=str) == sorted(map(tuple, taken), key=str), key
    assert mixing.mix(docs.limit(0)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _groups_that_touch(dims=32, members=150, spread=0.022, seed=11):
    """Two tight groups with all members' lists full of each other, some of whose
    members link across; and vectors far from all."""
    rng = np.random.default_rng(seed)
    one = np.eye(dims)[0]
    two = 0.905 * one + np.sqrt(1 - 0.905**2) * np.eye(dims)[1]
    tight = [c + spread * rng.standard_normal((members, dims)) for c in (one, two)]
    return np.vstack([*tight, rng.standard_normal((100, dims))])


def test_links_between_crowded_groups(spark):
    vectors = _groups_that_touch()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
    assert true[:150, 150:300].any() and not true[:150, 150:300].all()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert [found[i].n_links for i in range(len(unit))] == true.sum(1).tolist()
    assert {found[i].component_id for i in range(300)} == {0}
    assert all(found[i].component_id == i for i in range(300, 400) if not true[i].any())


def test_failed_audit_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "audit", lambda *a: (100, 89))
    monkeypatch.setattr(embedding_dedup, "MOST_ROUNDS", 2)
    df = spark.createDataFrame([(i, [1.0, float(i % 7)]) for i in range(20)], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="89 of 100"):
        embedding_dedup.near_duplicates(df)


def test_vectors_of_other_lengths(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0]), (4, [1.0, 0.0, 0.0]), (5, [])]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True)]


def test_near_duplicates(spark):
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for size in [1] * 150 + [2, 3, 5, 40, 110]:
        centre = rng.standard_normal(16)
        for _ in range(size):
            rows.append((at, (centre + 0.12 * rng.standard_normal(16) * (size > 1)).tolist()))
            at += 1
    rows += [(at, rows[0][1]), (at + 1, rows[0][1]), (at + 2, (np.array(rows[200][1]) * 1e200).tolist())]
    units = np.array([v for _, v in rows])
    units = units / np.abs(units).max(axis=1, keepdims=True)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    linked = units @ units.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(rows))
    for _ in range(len(rows)):
        label = np.minimum(label, np.where(linked, label[None, :], len(rows)).min(axis=1))
    odd = [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] + [1.0] * 15), (None, rows[0][1]), (9005, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(found) == len(rows) + len(odd)
    for i in (9000, 9001, 9002, 9003, 9004, 9005):
        assert tuple(found[i])[1:] == (0, i, True)
    right = sum(found[i].n_links == linked[i].sum() and found[i].component_id == label[i] for i in range(len(rows)))
    assert right >= 0.97 * len(rows)
    assert all(found[i].n_links <= linked[i].sum() for i in range(len(rows)))  # no link below the threshold
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
