import random

import pytest
from conftest import plan_of
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from topicmill.operators import labelling, splitting
from topicmill.plans import flow
from topicmill.session import stage
from topicmill.sources import topic_tags, topics_from_mapping


@pytest.fixture
def tags(spark):
    def build(*names):
        return topic_tags(topics_from_mapping(spark, {"t": list(names)}), "t")

    return build


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_label_by_id_and_distinct(make_posts, tags):
    posts = make_posts([(1, 0, "Cup other"), (2, 0, "none"), (2, 0, "none"), (3, 0, "none"), (3, 0, "cup")])
    ids = labelling.topical_ids(labelling.explode_hashtags(posts), tags("cup"))
    assert as_set(ids, "tweet_id") == {("1",), ("3",)}
    labelled = labelling.label_posts(posts, ids)
    assert labelled.columns == [*posts.columns, "label"]
    assert sorted(tuple(r) for r in labelled.select("tweet_id", "hashtag", "label").collect()) == [
        ("1", "Cup other", 1.0),
        ("2", "none", 0.0),
        ("3", "cup", 1.0),
        ("3", "none", 1.0),
    ]


def test_label_by_row_equals_label_by_id_on_unique_ids(make_posts, tags):
    posts = make_posts([(i, i, random.Random(i).choice(["a b", "c", "b", "d a", ""])) for i in range(60)])
    by_row = labelling.label_by_row(posts, tags("a", "c"))
    ids = labelling.topical_ids(labelling.explode_hashtags(posts), tags("a", "c"))
    by_id = labelling.label_posts(posts, ids)
    assert as_set(by_row, "tweet_id", "label") == as_set(by_id, "tweet_id", "label")


def test_label_by_row_moves_no_posts(spark, make_posts, tags):
    posts = stage(make_posts([(1, 0, "a")]), "p")
    topic = stage(tags("a"), "t")
    plan = plan_of(labelling.label_by_row(posts, topic)).split("Subquery")[0]
    assert "Exchange" not in plan


def test_label_moves_posts_only_for_the_distinct(spark, make_posts, tags):
    posts = stage(make_posts([(1, 0, "a")]), "p")
    ids = stage(labelling.topical_ids(labelling.explode_hashtags(posts), tags("a")), "ids")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(labelling.label_posts(posts, ids))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # posts and ids; the distincts add none


def test_building_a_plan_starts_no_job(spark, make_posts, tags):
    posts = make_posts([(1, 0, "a")])
    ranked = spark.createDataFrame([("a", "train")], "each_hashtag string, split string")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "no job belongs here")
    labelling.label_posts(posts, labelling.topical_ids(labelling.explode_hashtags(posts), tags("a")))
    labelling.label_by_row(posts, tags("a"))
    splitting.drop_leaking(posts.withColumn("split", F.lit("test")), ranked)
    splitting.drop_leaking_by_row(posts.withColumn("split", F.lit("test")), ranked)
    assert status.getJobIdsForGroup("plans") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_lists_are_refused(make_posts, spark, monkeypatch):
    monkeypatch.setattr(labelling, "MOST_LISTED", 2)
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "each_hashtag string")
    with pytest.raises(Exception, match="join by id"):
        labelling.label_by_row(make_posts([(1, 0, "a")]), listed).collect()


def test_duplicates_differ_in_nothing_that_counts(spark):
    rows = [("2", "t", "x"), ("10", "t", "y"), ("10", "t", "z"), ("10", "t", "z"), ("3", "u", "x"), (None, "u", "w")]
    df = spark.createDataFrame(rows, ["tweet_id", "term", "more"])
    found = splitting.drop_duplicate_content(df, ["term"])
    assert sorted((r.tweet_id or "", r.term) for r in found.collect()) == [("", "u"), ("10", "t")]
    assert "SortAggregate" not in plan_of(found) or "more" not in plan_of(found).split("SortAggregate")[1].split("\n")[0]

def test_birthdays_and_cutoffs(make_posts, tags):
    rows = [(i, 100 + i, f"h{i}") for i in range(20)] + [(50, 1, "other"), (51, 500, "h0"), (52, 103, "h2")]
    exploded = labelling.explode_hashtags(make_posts(rows))
    birthdays = splitting.hashtag_birthdays(exploded, tags(*[f"h{i}" for i in range(20)], "never"))
    assert dict(as_set(birthdays, "each_hashtag", "birthday")) == {f"h{i}": 100.0 + i for i in range(20)}
    ranked = splitting.split_hashtags(birthdays)
    found = {r.each_hashtag: r.split for r in ranked.collect()}
    assert [found[f"h{i}"] for i in (14, 15, 16, 17)] == ["train", "valid", "valid", "test"]
    assert tuple(splitting.split_cutoffs(ranked).first()) == (20, 15, 17, 115.0, 117.0)


def test_equal_birthdays_go_by_name(make_posts, tags):
    exploded = labelling.explode_hashtags(make_posts([(1, 5, "b a d c")]))
    ranked = splitting.split_hashtags(splitting.hashtag_birthdays(exploded, tags("a", "b", "c", "d")))
    assert as_set(ranked, "each_hashtag", "tag_rank") == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}


def test_cut_times_are_inclusive(spark, make_posts):
    cutoffs = spark.createDataFrame([(10.0, 20.0)], "train_valid_time double, valid_test_time double")
    split = splitting.assign_split(make_posts([(1, 10, ""), (2, 10.5, ""), (3, 20, ""), (4, 20.5, "")]), cutoffs)
    assert as_set(split, "tweet_id", "split") == {("1", "train"), ("2", "valid"), ("3", "valid"), ("4", "test")}


def test_empty_topic_gives_empty_split(make_posts, tags):
    posts = make_posts([(1, 0, "a")])
    ranked = splitting.split_hashtags(splitting.hashtag_birthdays(labelling.explode_hashtags(posts), tags("zzz")))
    assert splitting.assign_split(posts, splitting.split_cutoffs(ranked)).count() == 0


@pytest.mark.parametrize("guard", [splitting.drop_leaking, splitting.drop_leaking_by_row])
def test_leakage_guard(spark, make_posts, guard):
    ranked = spark.createDataFrame(
        [("tr", "train"), ("va", "valid"), ("te", "test")], "each_hashtag string, split string"
    )
    rows = [(s + t, 0, f"x {t}") for s in ("train", "valid", "test") for t in ("tr", "va", "te", "none")]
    posts = make_posts(rows).withColumn("split", F.regexp_extract("tweet_id", "^(train|valid|test)", 1))
    kept = {r.tweet_id for r in guard(posts, ranked).collect()}
    assert kept == {
        "traintr", "trainva", "trainte", "trainnone", "validva", "validte", "validnone", "testte", "testnone",
    }


def test_split_invariants(spark, make_posts, tags):
    draw = random.Random(3)
    names = [f"h{i}" for i in range(30)]
    rows = [(i, i, " ".join(draw.sample(names[: 2 + i // 8], 2)) if draw.random() < 0.6 else "x") for i in range(200)]
    topic = tags(*names)
    labelled = stage(flow.labelled_posts(make_posts(rows), topic), "l")
    one, two = flow.split_posts(labelled, topic), flow.split_posts(labelled, topic, unique_ids=True)
    assert as_set(one, "tweet_id", "split", "label") == as_set(two, "tweet_id", "split", "label")
    assert one.count() == one.select("tweet_id").distinct().count()
    periods = splitting.split_hashtags(splitting.hashtag_birthdays(labelling.explode_hashtags(labelled), topic))
    of = {r.each_hashtag: r.split for r in periods.collect()}
    for row in one.collect():
        seen = {of.get(t) for t in row.hashtag.split()}
        if row.split == "valid":
            assert "train" not in seen
        if row.split == "test":
            assert not seen & {"train", "valid"}


def test_split_counts(spark, make_posts):
    rows = make_posts([(1, 0, ""), (2, 0, ""), (3, 0, "")]).withColumns(
        {"split": F.when(F.col("tweet_id") == "1", "train").otherwise("test"), "label": F.col("tweet_id") / 3 == 1}
    )
    rows = rows.withColumn("label", F.col("label").cast("double"))
    assert as_set(splitting.split_counts(rows), "split", "row_count", "positive_count") == {
        ("train", 1, 0),
        ("test", 2, 1),
    }


def test_duplicate_content(spark):
    rows = [("2", "ab", "c"), ("1", "ab", "c"), ("3", "a", "bc"), ("4", None, "c"), ("5", "c", None), ("6", None, "c")]
    df = spark.createDataFrame(rows, "tweet_id string, x string, y string")
    kept = splitting.drop_duplicate_content(df, ["x", "y"])
    assert kept.columns == df.columns
    assert as_set(kept, "tweet_id", "x") == {("1", "ab"), ("3", "a"), ("4", None), ("5", "c")}


def test_duplicate_vectors_dense_or_sparse(spark):
    rows = [("1", Vectors.dense(0, 1)), ("2", Vectors.sparse(2, [1], [1.0])), ("3", Vectors.sparse(2, [1], [2.0]))]
    df = spark.createDataFrame(rows, ["tweet_id", "v"])
    assert as_set(splitting.drop_duplicate_content(df, ["v"]), "tweet_id") == {("1",), ("3",)}


def test_hot_duplicate_combines_before_the_exchange(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("tweet_id"), F.lit("same").alias("x"))
    plan = plan_of(splitting.drop_duplicate_content(df, ["x"]))
    assert "partial_min" in plan


def test_tag_and_union(spark):
    a, b = spark.createDataFrame([(1, 2.0)], ["i", "l"]), spark.createDataFrame([(3.0, 4)], ["l", "i"])
    both = splitting.tag_and_union({"train": a, "valid": b})
    assert as_set(both, "i", "l", "type") == {(1, 2.0, "train"), (4, 3.0, "valid")}


def test_restrict_to_labelled(spark, make_posts):
    exploded = labelling.explode_hashtags(make_posts([(1, 0, "a b"), (2, 0, "c")]))
    labels = spark.createDataFrame([("1", 0.0), ("1", 1.0)], "tweet_id string, label double")
    found = labelling.restrict_to_labelled(exploded, labels)
    assert sorted(r.each_hashtag for r in found.collect()) == ["a", "b"]
