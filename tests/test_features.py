from collections import Counter

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import functions as F

from topicmill.functions import tokens, without_stop_words
from topicmill.functions.vectors import vector_entries
from topicmill.operators import features as feats
from topicmill.session import stage

ALL = {b: 1 for b in feats.BLOCKS}


@pytest.fixture
def posts(make_posts):
    return make_posts(
        [
            (1, 0, "p q r", "red red cat"),
            (2, 0, "p r r", "cat the dog"),
            (3, 0, "q s", "fish cat"),
            (4, 0, "", ""),
        ]
    )


def test_vocabulary_floor_and_order(posts):
    found = feats.fit_vocabularies(posts, {"hashtag": 2}, blocks=["hashtag"]).orderBy("idx").collect()
    assert [(r.token, r.df, r.tf, r.idx) for r in found] == [("r", 2, 3, 0), ("p", 2, 2, 1), ("q", 2, 2, 2)]


def test_empty_token_counts_as_a_token(posts):
    found = feats.fit_vocabularies(posts, ALL, blocks=["hashtag"]).collect()
    assert {r.token for r in found} == {"p", "q", "r", "s", ""}


def test_vocabulary_equals_count_vectorizer(posts):
    words = posts.select(without_stop_words(tokens("term")).alias("w"))
    for least in (1, 2):
        model = CountVectorizer(inputCol="w", outputCol="v", minDF=least).fit(words)
        found = feats.fit_vocabularies(posts, {"term": least}, blocks=["term"]).collect()
        assert {r.token for r in found} == set(model.vocabulary)


WORDS = st.lists(st.sampled_from(["a", "b", "B", "é", "zz", "the", "not"]), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(WORDS, min_size=1, max_size=5))
def test_statistics_equal_a_count(spark, make_posts, lists):
    found = feats.token_statistics(make_posts([(i, 0, "", " ".join(x)) for i, x in enumerate(lists)]), ["term"])
    texts = [" ".join(x).lower().split(" ") for x in lists]
    tf, df = Counter(sum(texts, [])), Counter(sum((list(set(t)) for t in texts), []))
    kept = set(tf) - {"a", "the", "not"}
    assert {r.token: (r.df, r.tf) for r in found.collect()} == {t: (df[t], tf[t]) for t in kept}


@pytest.mark.parametrize("cap", [1, 2, 3, 7, 40, 1000])
def test_cap_keeps_the_most_frequent(spark, make_posts, cap):
    # Frequencies on both sides of the last exact histogram bin, with ties.
    rows = [(i, 0, "x", " ".join([f"w{i % 60:02d}"] * (1 + i * 90))) for i in range(60)]
    table = make_posts(rows)
    found = feats.fit_vocabularies(table, ALL, vocab_size=cap, blocks=["term", "user"]).collect()
    terms = sorted((r.idx, r.token) for r in found if r.block == "term")
    expected = sorted(range(60), key=lambda i: -(1 + i * 90))[:cap]
    assert terms == [(k, f"w{i:02d}") for k, i in enumerate(expected)]
    assert [r.token for r in found if r.block == "user"] == ["user1"]


def test_all_blocks_in_one_pass(posts):
    staged = stage(posts, "p")
    plan = plan_of(feats.token_statistics(staged))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "lambda" not in plan


def test_histogram_reuses_the_counts(posts):
    vocabulary = feats.fit_vocabularies(stage(posts, "p"), ALL)
    vocabulary.collect()
    final = plan_of(vocabulary).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == 1


def test_model_counts_and_assembly(spark, posts, tmp_path):
    model = feats.feature_model(posts, ALL)
    rows = {r.tweet_id: r for r in model.transform(posts).collect()}
    vocabulary = feats.collect_vocabularies(feats.fit_vocabularies(posts, ALL))
    sizes = [len(vocabulary[b]) for b in feats.BLOCKS]
    assert rows["1"].features.size == sum(sizes)
    assert rows["1"].term_features[vocabulary["term"].index("red")] == 2.0
    assert "the" not in vocabulary["term"]
    names = feats.feature_names(feats.fit_vocabularies(posts, ALL)).orderBy("global_idx").collect()
    assert [r.token for r in names] == sum((vocabulary[b] for b in feats.BLOCKS), [])
    assert [r.global_idx for r in names] == list(range(sum(sizes)))

    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(posts).collect()
    assert {r.tweet_id: r.features for r in again} == {k: r.features for k, r in rows.items()}


def test_count_model_equals_from_vocabulary(spark):
    df = spark.createDataFrame([(["", "a", "é", "a", "zz", "no"],), ([],)], "t array<string>")
    words = ["a", "", "zz", "é"]
    ours = feats.count_model(words, "t", "v")
    theirs = CountVectorizerModel.from_vocabulary(words, inputCol="t", outputCol="v")
    assert ours.vocabulary == words and ours.transform(df).collect() == theirs.transform(df).collect()
    assert feats.count_model([""], "t", "v").vocabulary == [""]
    with pytest.raises(ValueError):
        feats.count_model([], "t", "v")


def test_block_without_tokens_is_left_out(posts):
    model = feats.feature_model(posts, ALL | {"mention": 10_000, "user": 10_000})
    columns = model.transform(posts).columns
    assert "features" in columns and "user_features" not in columns


def test_long_counts_need_no_exchange(posts):
    vectors = feats.feature_model(posts, ALL).transform(stage(posts, "p"))
    long = feats.long_counts(vectors, "hashtag_features", "tweet_id")
    assert "Exchange" not in plan_of(long)
    assert sum(r.cnt for r in long.collect()) == 9.0


def test_repeated_ids_do_not_multiply(spark):
    hot = spark.range(1000).select(F.lit(0).alias("id"))
    blocks = [hot.union(spark.range(1, 3).select("id")).withColumn(f"c{i}", F.lit(i)) for i in range(5)]
    found = feats.join_blocks(blocks, "id").groupBy("id").count()
    assert {tuple(r) for r in found.collect()} == {(0, 1000), (1, 1), (2, 1)}
    features = hot.select(F.lit("0").alias("tweet_id"), F.lit(1).alias("f"))
    labels = features.select("tweet_id", F.lit(1.0).alias("label"))
    assert feats.with_labels(features, labels).count() == 1000


def test_join_blocks_exchanges_each_block_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        blocks = [spark.range(100).withColumn(f"c{i}", F.lit(i)) for i in range(4)]
        plan = plan_of(feats.join_blocks(blocks, "id"))
        assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_with_labels(spark):
    a = spark.createDataFrame([("1", 5), ("2", 6)], ["tweet_id", "f"])
    labels = spark.createDataFrame([("1", 1.0, "x")], ["tweet_id", "label", "more"])
    assert [tuple(r) for r in feats.with_labels(a, labels).collect()] == [("1", 5, 1.0)]


def test_vector_entries(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(0, 2, 0),), (Vectors.sparse(3, [1], [2.0]),)], ["v"])
    assert all(
        [(e.idx, e.value) for e in r.e] == [(1, 2.0)] for r in df.select(vector_entries(F.col("v")).alias("e")).collect()
    )
