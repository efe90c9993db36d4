import json

from topicmill.operators.language import LanguageFilter
from topicmill.operators.parsing import parse_posts
from topicmill.plans import flow
from topicmill.sources import read_stage, testdata, topic_tags

SF = "/root/testdata/sf0.001"
MIN_DF = {"term": 2, "hashtag": 2, "mention": 2, "user": 2, "loc": 2}


def test_raw_lines_to_month_folders(spark, tmp_path):
    testdata.raw_posts(spark, SF).write.option("compression", "gzip").text(str(tmp_path / "raw"))
    docs = testdata.table(spark, SF, "documents")
    model = LanguageFilter.train(docs, "text", "lang")
    flow.prepare_posts(spark, str(tmp_path / "raw"), str(tmp_path / "posts"), model, min_length=0)
    found = read_stage(spark, str(tmp_path / "posts"))
    # Without the second filter: undamaged English lines of the types that carry a language.
    expected = {r.tweet_id for r in parse_posts(testdata.raw_posts(spark, SF), 0).collect()}
    posts = {r.tweet_id: r for r in testdata.posts(spark, SF).collect()}
    assert expected < set(posts)
    kept = {r.tweet_id: r for r in found.drop("year_month").collect()}
    detected = {str(r.doc_id) for r in model.keep(docs, "en", "text").collect()}
    # The filter reads the post's text, with its marks, so single documents may differ.
    assert set(kept) <= expected and len(set(kept) ^ (expected & detected)) <= 0.02 * len(expected)
    assert all(posts[i].asDict() == {c: r[c] for c in posts[i].asDict()} for i, r in kept.items())


def test_feature_tables(spark):
    posts = testdata.posts(spark, SF)
    tags = topic_tags(testdata.topic_hashtags(posts), "t1")
    shares = {0.0: 0.5, 1.0: 1.0}
    by_id = flow.feature_tables(posts, tags, MIN_DF, train_fractions=shares, valid_fractions=shares)
    by_row = flow.feature_tables(
        posts, tags, MIN_DF, train_fractions=shares, valid_fractions=shares, unique_ids=True
    )
    assert sorted(by_id.combined.collect()) == sorted(by_row.combined.collect())
    assert by_id.combined.columns == ["tweet_id", "create_time", "features", "label", "type"]
    assert by_id.test.columns == ["tweet_id", "create_time", "features", "label"]
    assert by_id.combined.schema["features"].metadata == {} == by_id.test.schema["features"].metadata
    assert {r.type for r in by_id.combined.select("type").distinct().collect()} <= {"train", "valid"}
    train_ids = {r.tweet_id for r in by_id.combined.collect()}
    assert not train_ids & {r.tweet_id for r in by_id.test.collect()}
    narrow = flow.feature_tables(posts, tags, MIN_DF, train_fractions=shares, fit_on_train=True)
    assert narrow.combined.first().features.size < by_id.combined.first().features.size


def test_json_of_raw_posts_is_valid_where_undamaged(spark):
    lines = [r.value for r in testdata.raw_posts(spark, SF).collect()]
    whole = []
    for line in lines:
        try:
            whole.append(json.loads(line))
        except ValueError:
            pass
    assert 0 < len(whole) < len(lines)
    assert {"id", "text", "user", "entities"} <= set().union(*whole)
