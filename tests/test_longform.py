"""Long-form counts: equal to the vectors, nothing collected, hot tokens dealt out."""

import pytest

from conftest import plan_of
from topicmill.operators import features as feats
from topicmill.operators import longform
from topicmill.session import stage

FLOORS = {b: 1 for b in feats.BLOCKS}


@pytest.fixture
def posts(make_posts):
    texts = ["hot cold", "hot hot warm", "hot the the", "cold", "  odd  spaces", "hot"]
    return make_posts([(i, i, f"tag{i % 3} common", texts[i % len(texts)]) for i in range(60)])


def long_of(posts, vocabularies, heavy):
    return sorted(longform.assemble(longform.encode(posts, vocabularies, heavy=heavy), vocabularies).collect())


def test_equals_vectors(posts):
    vocabularies = stage(feats.fit_vocabularies(posts, FLOORS), "vocabulary")
    vectors = feats.feature_model(posts, FLOORS).transform(posts)
    expected = sorted(feats.long_counts(vectors, "features").collect())
    for heavy in (0, 1, 3, 1000):
        assert [tuple(r) for r in long_of(posts, vocabularies, heavy)] == [tuple(r) for r in expected]


def test_nulls_repeats_and_no_rows(spark, posts):
    vocabularies = stage(feats.fit_vocabularies(posts, FLOORS), "vocabulary")
    assert long_of(posts.limit(0), vocabularies, 2) == []
    one = posts.limit(1)
    doubled = {(r.global_idx, r.cnt) for r in longform.assemble(longform.encode(one.union(one), vocabularies), vocabularies).collect()}
    single = {(r.global_idx, 2 * r.cnt) for r in longform.assemble(longform.encode(one, vocabularies), vocabularies).collect()}
    assert doubled == single != set()
    empty = stage(feats.fit_vocabularies(posts, {b: 10**6 for b in feats.BLOCKS}), "vocabulary")
    assert long_of(posts, empty, 2) == []


def test_hot_token_stays_split(spark):
    """A token of every post: after the exchange by post and token no task has more
    than its share, and what is shuffled by token alone does not hold it."""
    from topicmill.schema import POST

    rows = [(float(i), "1", f"u{i}", "tag", "here", "", f"hot own{i} also{i}", str(i)) for i in range(4000)]
    posts = spark.createDataFrame(rows, POST).repartition(4)
    counts = longform.token_counts(posts, ["term"]).rdd.mapPartitions(lambda p: [sum(r.token == "hot" for r in p)]).collect()
    assert sum(counts) == 4000 and max(counts) < 2 * 4000 / len(counts)
    vocabulary = stage(feats.fit_vocabularies(posts, FLOORS, blocks=["term"]), "vocabulary")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(longform.encode(posts, vocabulary, ["term"], heavy=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "isnull(_idx" in plan


def test_vocabulary_is_not_collected(posts, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    vocabularies = stage(feats.fit_vocabularies(posts, FLOORS), "vocabulary")
    for name in ("collect", "toPandas", "toArrow", "toLocalIterator", "first", "head", "take"):
        monkeypatch.setattr(DataFrame, name, lambda *a, **k: pytest.fail("collected"))
    longform.assemble(longform.encode(posts, vocabularies), vocabularies)


def test_cut_tokens(posts):
    counts = {(r.block, r.token): r for r in feats.token_statistics(posts).collect()}
    floors = FLOORS | {"term": 11}
    found = {r.block: r for r in longform.cut_tokens(posts, floors, vocab_size=2).collect()}
    for block in feats.BLOCKS:
        passing = sorted((r.tf for (b, _), r in counts.items() if b == block and r.df >= floors[block]), reverse=True)
        below = sum(b == block and r.df < floors[block] for (b, _), r in counts.items())
        r = found[block]
        assert (r.kept, r.beyond_size, r.below_floor) == (min(2, len(passing)), max(0, len(passing) - 2), below)
        assert (r.kept_uses, r.beyond_uses) == (sum(passing[:2]), sum(passing[2:]))
    kept = feats.fit_vocabularies(posts, floors, vocab_size=2).groupBy("block").count().collect()
    assert {r.block: r["count"] for r in kept} == {b: r.kept for b, r in found.items() if r.kept}
