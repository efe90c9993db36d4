import gzip
import json

import pytest
from pyspark.sql import functions as F

from topicmill.operators import parsing
from topicmill.plans import queries
from topicmill.schema import POST_COLUMNS
from topicmill.sources import partition_counts, read_posts_json, read_raw_lines, spread
from topicmill.sources.posts import scan_bytes


def raw(id_, lang="en", **extra):
    post = {
        "created_at": "Tue Mar 05 07:08:09 +0000 2019",
        "id": id_,
        "text": "Ünder the bridge",
        "user": {"id": 7, "screen_name": "sam", "location": None},
        "entities": {
            "hashtags": [{"text": "A", "indices": [0, 1]}, {"text": "b"}],
            "user_mentions": [{"screen_name": "x"}],
        },
        "geo": None,
        **extra,
    }
    return post | ({"lang": lang} if lang else {})


@pytest.fixture
def lines(spark):
    def build(*values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    return build


def test_decode_never_fails(lines):
    rows = lines("nope", "[]", "{}", '{"id": 1}', "{'id': 1}", '{"id": "x"').select(
        parsing.decode("value", "id bigint").alias("p")
    )
    assert [r.p and (r.p["id"],) for r in rows.collect()] == [None, None, (None,), (1,), None, None]


BROKEN = ['{"id":1}{"id":2}', '{"id":1},{"id":2}', '{"id":1} junk}', '{"id":1}] junk}', '{"id":1}],"mark":1}', '{"id":"a\x01"}', '{"id":NaN}', '[{"id":1}]', "", None]


@pytest.mark.parametrize("line", BROKEN)
def test_a_line_is_one_whole_object(lines, line):
    df = lines('{"id":5,"a":1} ', line)
    assert [r.p and r.p["id"] for r in df.select(parsing.decode("value", "id string").alias("p")).collect()] == ["5", None]
    assert parsing.objects_with_keys(df).count() == 1


def test_ids_may_be_strings_or_large(lines):
    user = {"id": "u7", "screen_name": "sam"}
    df = lines(json.dumps(raw("x1", user=user)), json.dumps(raw(10**25)))
    found = {(r.tweet_id, r.from_id) for r in parsing.parse_posts(df, min_length=0).collect()}
    assert found == {("x1", "u7"), (str(10**25), "7")}


def test_rejected_lines_are_counted(lines):
    good = json.dumps(raw(1))
    df = lines(good, good + good, json.dumps(raw(2, "de")), json.dumps(raw(3, None)), json.dumps(raw(None)), "x", None)
    found = {r.reason: r.line_count for r in parsing.rejected_lines(df, min_length=5).collect()}
    assert found == {"malformed": 1, "language": 2, "missing": 1, "short": 2}
    assert parsing.parse_posts(df, min_length=5).count() == 1


def test_filters(lines):
    df = lines("x" * 1000, "x" * 1001)
    assert [len(r.value) for r in parsing.long_lines(df).collect()] == [1001]
    df = lines("{}", '{"a":1}', '{"a":1,"b":2}', "[1,2]", "no", '{"a":1,"b":2')
    assert [r.value for r in parsing.objects_with_keys(df).collect()] == ['{"a":1,"b":2}']
    df = lines('{"lang":"en","a":1}', '{"lang":"de"}', '{"a":"en"}', '{"lang":"en"')
    assert [r.value for r in parsing.in_language(df).collect()] == ['{"lang":"en","a":1}']


def test_parse_posts(lines):
    good = json.dumps(raw(7000000000000000042))
    df = lines(good, json.dumps(raw(2, "de")), json.dumps(raw(3, None)), good[:-1], good + " tail", '{"lang":"en","id":5}')
    posts = parsing.parse_posts(df, min_length=0)
    assert posts.columns == POST_COLUMNS
    assert [tuple(r) for r in posts.collect()] == [
        (1551769689.0, "7", "sam", "A b", None, "x", "Ünder the bridge", "7000000000000000042")
    ]
    assert parsing.parse_posts(df).count() == 0
    assert parsing.parse_posts(df, min_length=0, num_partitions=3).count() == 1


def test_each_line_is_parsed_once(lines):
    plan = parsing.parse_posts(lines("{}"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_read_many_folders_and_gzip(spark, tmp_path):
    for day, ids in {"d-01": [1, 2], "d-02": [3]}.items():
        folder = tmp_path / "jan" / day
        folder.mkdir(parents=True)
        with gzip.open(folder / "part.json.gz", "wt") as out:
            out.writelines(json.dumps(raw(i)) + "\n" for i in ids)
    other = tmp_path / "feb" / "d-09"
    other.mkdir(parents=True)
    (other / "part.json").write_text(json.dumps(raw(4)) + "\n")
    paths = f"{tmp_path}/jan/d-*,{tmp_path}/feb/d-*"
    found = parsing.parse_posts(read_raw_lines(spark, paths), min_length=10)
    assert sorted(r.tweet_id for r in found.collect()) == ["1", "2", "3", "4"]
    braces = read_raw_lines(spark, f"{tmp_path}/{{jan,feb}}/d-0[19]")
    assert braces.count() == 3
    per_partition = partition_counts(read_raw_lines(spark, paths)).collect()
    assert sum(r.row_count for r in per_partition) == 4
    with_files = read_raw_lines(spark, f"{tmp_path}/jan,{tmp_path}/feb", with_files=True).collect()
    assert sorted(r.file_path.rsplit("/", 2)[1] for r in with_files) == ["d-01", "d-01", "d-02", "d-09"]
    assert {r.file_path.rsplit("/", 1)[1]: r.file_size for r in with_files}["part.json"] == (other / "part.json").stat().st_size


def test_spread_follows_the_size_of_files(spark, tmp_path):
    spark.range(2000).selectExpr("repeat(cast(id as string), 50) as value").coalesce(1).write.text(str(tmp_path / "t"))
    lines = read_raw_lines(spark, str(tmp_path / "t"))
    size = scan_bytes(lines)
    assert abs(size - sum(f.stat().st_size for f in (tmp_path / "t").glob("part-*"))) < 100
    least = 2 * spark.sparkContext.defaultParallelism
    assert spread(lines).rdd.getNumPartitions() == least
    assert spread(lines, task_bytes=size // 100).rdd.getNumPartitions() in (100, 101)
    assert spread(lines.limit(5), lines, 3.0, task_bytes=size // 100).rdd.getNumPartitions() in (300, 301, 303)


def test_typed_posts_and_json_lines(spark, tmp_path):
    loose = spark.createDataFrame(
        [(5, 1, "u", "h", None, "", "t", 9)],
        "create_time int, from_id int, from_user string, hashtag string, location string, mention string, "
        "term string, tweet_id long",
    )
    typed = parsing.typed_posts(loose)
    row = typed.first()
    assert (row.create_time, row.from_id, row.tweet_id) == (5.0, "1", "9")
    loose.write.json(str(tmp_path / "out"))
    (tmp_path / "out" / "bad.json").write_text("broken\n")
    again = read_posts_json(spark, str(tmp_path / "out"))
    assert again.collect() == typed.collect()
    assert again.select(F.col("tweet_id")).schema[0].dataType.typeName() == "string"


def test_filters_write_and_parse_a_line_once(spark, tmp_path):
    """Pushed below the projection that writes it, a filter would write it again."""
    docs = [(i, f"a wonderfully unremarkable text {i}", "en", "web") for i in range(9)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    events = spark.createDataFrame([(i, 7, "view") for i in range(6)], "event_id long, user_id long, event_type string")
    events.selectExpr("event_id", "timestamp_ntz'2020-01-01' as ts", "user_id", "event_type").write.parquet(f"{tmp_path}/events.parquet")
    for query in (queries.filter_min_keys, queries.filter_lang):
        found = query(spark, str(tmp_path))
        assert {r.tweet_id for r in found.collect()} == {"0", "5", "6", "7", "8"}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in plan.splitlines() if "Filter" in x[:40] and "StructsToJson" in x]
        assert plan.count("from_json") == 1
