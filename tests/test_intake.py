"""Quarantine, re-ingest, month layout, LibSVM folders."""

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import plan_of
from topicmill.operators import parsing, quarantine
from topicmill.operators.parsing import close_object
from topicmill.sources import month_volume, read_libsvm, read_months, rewrite_months, testdata, write_libsvm, write_monthly

SF = "/root/testdata/sf0.001"


def test_no_line_is_lost(spark, tmp_path):
    lines = testdata.raw_posts(spark, SF).unionByName(spark.createDataFrame([(None,), ("",), ("[]",), ("x" * 50,)], "value string"))
    quarantine.ingest(lines, str(tmp_path / "q"), min_length=0)
    posts = quarantine.accepted_posts(spark, str(tmp_path / "q"))
    rejects = quarantine.rejected_lines(spark, str(tmp_path / "q")).collect()
    assert sorted(posts.collect()) == sorted(parsing.parse_posts(lines, 0).collect())
    # Line by line: the rejected ones are there as they came, and with the accepted
    # ones' ids they are all lines.
    came = Counter(r.value for r in lines.collect())
    left = Counter(r.value for r in rejects)
    assert not left - came
    accepted = {r.tweet_id for r in posts.select("tweet_id").collect()}
    assert {str(json.loads(v)["id"]) for v in (came - left)} == accepted
    assert sum(left.values()) + posts.count() == sum(came.values())
    counts = {r.reason: r.line_count for r in quarantine.summary(spark, str(tmp_path / "q")).collect()}
    assert counts == {quarantine.ACCEPTED: posts.count(), **Counter(r.reason for r in rejects)}
    assert counts["short"] == 2
    with pytest.raises(AnalysisException):
        quarantine.ingest(lines, str(tmp_path / "q"), min_length=0)


def test_only_asked_folders_are_read(spark, tmp_path):
    quarantine.ingest(testdata.raw_posts(spark, SF), str(tmp_path / "q"), min_length=0)
    some = quarantine.rejected_lines(spark, str(tmp_path / "q"), "language")
    assert "PartitionFilters: [isnotnull(reason" in plan_of(some)
    assert {r.reason for r in some.collect()} == {"language"}


def test_mended_lines_become_posts(spark, tmp_path):
    lines = testdata.raw_posts(spark, SF)
    quarantine.ingest(lines, str(tmp_path / "q"), min_length=0)
    quarantine.reingest(spark, str(tmp_path / "q"), str(tmp_path / "m"), close_object, min_length=0)
    before = quarantine.rejected_lines(spark, str(tmp_path / "q"), "malformed").count()
    after = {r.reason: r.line_count for r in quarantine.summary(spark, str(tmp_path / "m")).collect()}
    assert sum(after.values()) == before and 0 < after["accepted"] < before
    whole = {r.tweet_id: r for r in testdata.posts(spark, SF).collect()}
    for r in quarantine.accepted_posts(spark, str(tmp_path / "m")).collect():
        assert r.asDict() == whole[r.tweet_id].asDict()


def test_close_object(spark):
    lines = spark.createDataFrame([('{"a": 1',), ('{"a": 1}',), ('{"a": "}"',), ("{",), ("]",), (None,)], "value string")
    found = [r[0] for r in lines.select(close_object(F.col("value"))).collect()]
    assert found == ['{"a": 1}', '{"a": 1}', '{"a": "}"}', "{}", "]", None]


def test_other_columns_stay_beside_the_reason(spark):
    lines = spark.createDataFrame([("{}", 1, "x"), ("no", 2, "y")], "value string, lang int, id string")
    found = sorted(quarantine.rejection_of(lines, 0).select("lang", "id", "reason").collect())
    assert [tuple(r) for r in found] == [(1, "x", "language"), (2, "y", "malformed")]


def month_files(root):
    return {p.parent.name: {(f.name, f.stat().st_mtime_ns) for f in p.parent.glob("part-*")} for p in Path(root).glob("*/part-*")}


def test_rewriting_one_month_leaves_the_others(spark, make_posts, tmp_path):
    root = str(tmp_path / "m")
    rows = [(i, 1356998400 + 86400 * 10 * i, "tag") for i in range(60)]  # 20 months
    posts = make_posts(rows)
    write_monthly(posts, root)
    before = month_files(root)
    assert len(before) >= 18
    march = read_months(spark, root, "2013-03", "2013-03")
    rewritten = march.limit(1).withColumn("hashtag", F.lit("new")).drop("year_month").collect()
    rewrite_months(spark.createDataFrame(rewritten, posts.schema), root)
    after = month_files(root)
    assert {m for m in before if before[m] != after[m]} == {"year_month=2013-03"}
    assert [r.hashtag for r in read_months(spark, root, "2013-03", "2013-03").collect()] == ["new"]
    rewrite_months(posts.limit(0), root)
    assert month_files(root) == after


def test_month_range_prunes_folders(spark, make_posts, tmp_path):
    root = str(tmp_path / "m")
    write_monthly(make_posts([(i, 1356998400 + 86400 * 10 * i, "tag") for i in range(60)]), root)
    found = read_months(spark, root, "2013-11", "2014-02")
    plan = plan_of(found)
    assert "PartitionFilters: [isnotnull(year_month" in plan and "DataFilters: []" in plan
    assert len(found.inputFiles()) >= 4
    assert {f.split("year_month=")[1][:7] for f in found.select("year_month").distinct().inputFiles()} >= {"2013-11"}
    assert {r.year_month for r in found.collect()} == {"2013-11", "2013-12", "2014-01", "2014-02"}
    volume = {(r.year, r.month): r.post_count for r in month_volume(read_months(spark, root)).collect()}
    assert sum(volume.values()) == 60 and volume[2013, 1] == 4
    assert "ReadSchema: struct<>" in plan_of(month_volume(read_months(spark, root)))


def test_libsvm_folders(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    rows = [(1.0, Vectors.sparse(5, [0, 4], [1.0, 2.5]), "2013-01"), (0.0, Vectors.sparse(5, [], []), "2013-02"), (0.0, Vectors.dense([0, 1, 0, 0, 0]), "2013-02")]
    path = str(tmp_path / "l")
    write_libsvm(spark.createDataFrame(rows, ["label", "features", "year_month"]), path, by="year_month")
    found = read_libsvm(spark, path, 5).collect()
    assert sorted((r.label, r.features.toArray().tolist(), str(r.year_month)) for r in found) == sorted((a, v.toArray().tolist(), m) for a, v, m in rows)
    assert {r.features.size for r in found} == {5}
