"""Joins on bucketed tables move no rows and give what plain joins give."""

from itertools import permutations

import pytest

from conftest import plan_of
from topicmill.operators import features as feats
from topicmill.operators import labelling, splitting
from topicmill.plans import queries
from topicmill.sources import write_bucketed

SF = "/root/testdata/sf0.001"


@pytest.fixture
def by_shuffle(spark):
    """Small tables would be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_block_join_has_no_exchange(spark, by_shuffle):
    joined = queries.blocks_bucketed(spark, SF)
    plan = plan_of(joined)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 4
    assert "SelectedBucketsCount" in plan
    assert sorted(joined.collect()) == sorted(queries.join_feature_blocks(spark, SF).collect())


def test_labels_join_has_no_exchange(spark, by_shuffle):
    plan = plan_of(queries.labels_bucketed(spark, SF))
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_guard_has_no_exchange(spark, by_shuffle):
    """Of the guard's joins only the one with the curated hashtags moves rows."""
    plan = plan_of(queries.leakage_bucketed(spark, SF))
    top = plan.split("LeftAnti", 1)
    assert len(top) == 2
    left = top[1].split("\n")
    depth = {line.index("+-") if "+-" in line else line.index(":-"): line for line in left if "+-" in line or ":-" in line}
    first = depth[min(depth)]
    assert "Exchange" not in first, plan


def test_labelled_hashtags_meet_in_buckets(spark, by_shuffle):
    """The only exchange is that of the counts at the end."""
    plan = plan_of(queries.hashtags_bucketed(spark, SF))
    assert plan.count("Exchange") == 1 and "LeftSemi" in plan


def test_repeated_keys_have_a_defined_row(spark):
    """Whatever the order and the partitions, the same row of a repeated key stays."""
    rows = [(1, "b", 2), (1, "a", 9), (1, "a", 3), (2, None, 1), (2, "z", 0), (3, None, None)]
    left = spark.createDataFrame([(i,) for i in (1, 1, 2, 3, 4)], "tweet_id int")
    found = set()
    for order in list(permutations(rows))[::60]:
        right = spark.createDataFrame(order, "tweet_id int, x string, y int").repartition(4)
        joined = feats.join_blocks([left, right]).collect()
        found.add(tuple(sorted(joined, key=repr)))
        table = write_bucketed(right, "right", "tweet_id", buckets=3)
        same = feats.join_blocks([write_bucketed(left, "left", "tweet_id", buckets=3), table]).collect()
        assert sorted(same, key=repr) == sorted(joined, key=repr)
    assert found == {((1, "a", 3), (1, "a", 3), (2, None, 1), (3, None, None))}


def test_first_rows_of_vectors(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(1, Vectors.dense([0.0, 2.0])), (1, Vectors.sparse(2, [0], [1.0])), (2, Vectors.sparse(2, [], []))]
    found = feats.first_rows(spark.createDataFrame(rows, ["tweet_id", "v"])).collect()
    assert sorted((r.tweet_id, r.v.toArray().tolist()) for r in found) == [(1, [1.0, 0.0]), (2, [0.0, 0.0])]
