import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.linalg import Vectors

from topicmill import session
from topicmill.sources import (
    read_stage,
    topic_tags,
    topics_from_mapping,
    write_json,
    write_libsvm,
    write_monthly,
    write_stage,
)


def test_stage_is_written_once(spark, tmp_path):
    df = spark.range(5)
    path = str(tmp_path / "s")
    assert write_stage(df, path).count() == 5
    with pytest.raises(AnalysisException):
        write_stage(df, path)
    assert write_stage(spark.range(2), path, "overwrite").count() == 2
    assert read_stage(spark, path).count() == 2


def test_stage_goes_to_the_shared_folder(spark):
    staged = session.stage(spark.range(3), "numbers")
    folder = session.shared_dir(spark)
    assert staged.count() == 3
    assert all(f.replace("file://", "").startswith(folder.replace("file:", "")) for f in staged.inputFiles())


def test_shared_folder_must_be_known():
    class Session:
        conf: dict = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Session.conf = {"spark.sql.warehouse.dir": "hdfs://w/"}
    assert session.shared_dir(Session()) == "hdfs://w/stages"
    Session.conf = {"spark.sql.warehouse.dir": "hdfs://w/", "spark.checkpoint.dir": "hdfs://c"}
    assert session.shared_dir(Session()) == "hdfs://c"


def test_months(spark, make_posts, tmp_path):
    posts = make_posts([(1, 1359676799, "a"), (2, 1359676800, "b"), (3, 1359676801, "c")])
    write_monthly(posts, str(tmp_path / "m"))
    table = read_stage(spark, str(tmp_path / "m"))
    found = {(str(r.year_month), r.tweet_id) for r in table.collect()}
    assert found == {("2013-01", "1"), ("2013-02", "2"), ("2013-02", "3")}
    pruned = table.where("year_month = '2013-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in pruned


def test_json_and_libsvm(spark, tmp_path):
    write_json(spark.range(3), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    rows = [(1.0, Vectors.sparse(4, [1, 3], [2.0, 1.0])), (0.0, Vectors.sparse(4, [], []))]
    write_libsvm(spark.createDataFrame(rows, ["label", "features"]), str(tmp_path / "l"))
    again = spark.read.format("libsvm").option("numFeatures", 4).load(str(tmp_path / "l"))
    assert sorted((r.label, r.features) for r in again.collect()) == sorted(rows)


def test_topics(spark):
    table = topics_from_mapping(spark, {"tennis": ["Wimbledon", "wimbledon", "usopen"], "soccer": ["fifa"]})
    assert sorted(r.each_hashtag for r in topic_tags(table, "tennis").collect()) == ["usopen", "wimbledon"]
    assert topic_tags(table, "chess").count() == 0
