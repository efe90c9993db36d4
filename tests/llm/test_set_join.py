import numpy as np

import pyarrow as pa

from topicmill.llm import set_join
from topicmill.llm.set_join import COMPARED, QUARTERS, Sets, _drawn_pairs, _in_common, _postings, _upper, _whole_sets, _width
from topicmill.session import arrow_batches


def _sets(rng, size, other, shared):
    values = np.unique(rng.integers(0, 2**64, 3 * (size + other), dtype=np.uint64))
    rng.shuffle(values)
    both, one, two = values[:shared], values[shared:size], values[size : size + other - shared]
    return np.sort(np.concatenate([both, one])), np.sort(np.concatenate([both, two]))


def test_parts_of_shingles_bound_what_sets_share():
    """Two bytes a shingle travel for sets of usual size; what they say holds for whole hashes."""
    assert _width(300) == 2
    rng = np.random.default_rng(5)
    for size, other in ((1, 1), (5, 4), (300, 280), (QUARTERS, QUARTERS + 300), (3000, 2900)):
        for share in (0.0, 0.5, 0.9, 1.0):
            shared = int(share * min(size, other))
            one, two = _sets(rng, size, other, shared)
            for widths in ((8, 8), (_width(size), _width(other)), (_width(other), _width(size))):
                x, y = (_upper(v, w).tobytes() for v, w in zip((one, two), widths))
                for found in (_in_common(x, size, y, other), _in_common(y, other, x, size)):
                    common, spare = found
                    assert common - spare <= shared <= common
                    assert widths != (8, 8) or found == (shared, 0)
    # Near copies of usual size are decided at once.
    one, two = _sets(rng, 350, 350, 335)
    common, spare = _in_common(_upper(one, 2).tobytes(), 350, _upper(two, 2).tobytes(), 350)
    assert 100 * (common - spare) >= 75 * (700 - common + spare)


def test_whole_sets_are_shuffled_once(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, "d e f")], "doc_id long, text string")
    keys = dict(zip((1, 3), Sets(pa.array(["a b c", "d e f"]), 5, np.empty(0, np.uint64)).key.view(np.int64).tolist()))
    members = spark.createDataFrame([(1, keys[1]), (1, keys[1]), (2, keys[1]), (3, keys[3])], "doc_id long, key long")
    sets = _whole_sets(docs, members, spark.createDataFrame([(k,) for k in keys.values()], "key long"), 5, True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sets._jdf.queryExecution().executedPlan().toString()
        rows = sets.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange for each side of the join.
    assert plan.count("Exchange hashpartitioning") == 2
    assert sorted(r.key for r in rows) == sorted(keys.values())


def test_bitmaps_are_asked_about_the_first_pivots_only(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(set_join, "_possible", lambda pairs, bitmaps: asked.append(pairs.count()) or pairs)
    # Set 0 shares a list with each of twenty others, all in components of their own.
    rows = [(s, k, 9, 0, k) for s in range(1, 21) for k in (0, s)]
    placed = spark.createDataFrame(rows, "shingle long, key long, size int, place int, component long")
    drawn = _drawn_pairs(placed, None, 1).collect()
    assert asked[0] <= COMPARED + 20
    assert {(r.a, r.place) for r in drawn if r.a == 0} == {(0, i + 1) for i in range(COMPARED)}


def test_postings_keep_positions_that_do_not_fit(spark, monkeypatch):
    monkeypatch.setattr(set_join, "PLACE_LIMIT", 3)
    docs = spark.createDataFrame([(1, " ".join(f"x{i}" for i in range(44))), (2, None)], "doc_id long, text string")
    found = _postings(docs, 5, np.empty(0, np.uint64)).collect()
    assert sorted(r["at"] & 3 for r in found) == [0, 1, 2, *[3] * 8] and {r["size"] for r in found} == {40}


def test_batches_are_bounded_and_set_back(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    wide = spark.range(64, numPartitions=1).selectExpr("repeat('x', 100000) as text")
    with arrow_batches(spark, 1 << 20):
        sizes = [r.n for r in wide.mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in it), "n long").collect()]
    assert sum(sizes) == 64 and max(sizes) < 16
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
