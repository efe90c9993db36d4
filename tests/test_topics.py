"""Several topics in one pass against one run per topic."""

import re

import pytest
from pyspark.sql import functions as F

from topicmill.operators import labelling, splitting, topics
from topicmill.session import stage
from topicmill.sources import topic_tags


@pytest.fixture
def fact(make_posts):
    return make_posts([(i, 1000 + 37 * i % 400, f"a{i % 5} b{i % 7} c{i % 11} both") for i in range(300)] + [(900, 5, ""), (901, 1, "unused?")])


@pytest.fixture
def names(spark):
    rows = [(t, f"{t}{i}") for t, n in (("a", 5), ("b", 7), ("c", 11)) for i in range(n)] + [("a", "both"), ("b", "both"), ("c", "never"), ("empty", "nobody")]
    return spark.createDataFrame(rows + rows[:2], "topic string, hashtag string")


def test_equals_single_runs(fact, names):
    periods = stage(topics.topic_periods(topics.topic_birthdays(fact, names)), "periods")
    split = topics.split_all_topics(fact, names, periods)
    cuts = {r.topic: r for r in topics.topic_cutoffs(periods).collect()}
    for topic in ("a", "b", "c"):
        tags = topic_tags(names, topic)
        exploded = labelling.explode_hashtags(fact)
        ranked = stage(splitting.split_hashtags(splitting.hashtag_birthdays(exploded, tags)), "ranked")
        mine = periods.where(F.col("topic") == topic).select(*ranked.columns)
        assert sorted(mine.collect()) == sorted(ranked.collect())
        cutoffs = splitting.split_cutoffs(ranked)
        assert [cuts[topic][c] for c in cutoffs.columns] == list(cutoffs.first())
        labelled = labelling.label_posts(fact, labelling.topical_ids(exploded, tags))
        single = splitting.drop_leaking(splitting.assign_split(labelled, cutoffs), ranked)
        single = single.select("tweet_id", "create_time", "label", "split")
        found = split.where(F.col("topic") == topic).select(*single.columns)
        assert sorted(found.collect()) == sorted(single.collect()) != []
    assert split.where("topic = 'empty'").count() == 0 and "empty" not in cuts


def test_posts_are_read_once(spark, fact, names):
    posts = stage(fact, "facts")
    periods = stage(topics.topic_periods(topics.topic_birthdays(posts, names)), "periods")
    plan = topics.split_all_topics(posts, names, periods)._jdf.queryExecution().executedPlan().toString()
    # The dictionary's tables have no ids: one scan of posts, and nothing moves them.
    assert len(re.findall(r"ReadSchema: struct<[^>]*tweet_id", plan)) == 1
    assert "Exchange" not in plan.split("Subquery", 1)[0] or "SubqueryAdaptive" in plan


def test_no_topics_and_too_many(spark, fact, names, monkeypatch):
    none = names.limit(0)
    periods = topics.topic_periods(topics.topic_birthdays(fact, none))
    assert topics.split_all_topics(fact, none, periods).count() == 0
    monkeypatch.setattr(topics, "MOST_LISTED", 3)
    periods = topics.topic_periods(topics.topic_birthdays(fact, names))
    with pytest.raises(Exception, match="split the dictionary"):
        topics.split_all_topics(fact, names, periods).collect()
