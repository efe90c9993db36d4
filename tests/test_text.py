import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from topicmill.functions import (
    clean_hashtag,
    clean_location,
    clean_mention,
    clean_term,
    created_at_seconds,
    strip_urls,
    tokens,
    without_stop_words,
    year_month,
)
from topicmill.plans.oracle import STOP_WORDS


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression("v")).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("New  York, É.", "loc_new__york_É"),
        ("  South Side ", "loc_south_side"),
        (None, "empty_location"),
        ("  ", "empty_location"),
        ("a_b-c", "loc_abc"),
        ("\t", "loc_\t"),
    ],
)
def test_location(spark, text, expected):
    assert one(spark, text, clean_location) == expected


def test_sentinels(spark):
    assert one(spark, None, clean_hashtag) == "empty_hashtag"
    assert one(spark, " ", clean_mention) == "empty_mention"
    assert one(spark, "A b", clean_hashtag) == "A b"


@pytest.mark.parametrize(
    "term, mention, hashtag, expected",
    [
        ("hi @ann @annabel", "ann annabel", "", "hi abel"),
        ("Go #Cup now", "", "Cup", "go now"),
        ("!!!", "", "", ""),
        ("   ", "", "", "empty_tweet"),
        (":", "", "", "empty_tweet"),
        (None, "", "", "empty_tweet"),
        ("go https://a.co/x now", "", "", "go now"),
        ("don't\n stop  É", None, None, "dont stop"),
        ("@a.b x", "a.b", "", "x"),
    ],
)
def test_term(spark, term, mention, hashtag, expected):
    row = spark.createDataFrame([(term, mention, hashtag)], "term string, mention string, hashtag string")
    assert row.select(clean_term()).first()[0] == expected


def test_whole_token_option_keeps_longer_names(spark):
    row = spark.createDataFrame([("hi @ann @annabel", "ann", "")], "term string, mention string, hashtag string")
    assert row.select(clean_term(whole_token=True)).first()[0] == "hi annabel"


def test_urls(spark):
    assert one(spark, "a http://x.y/z?q b https://c", strip_urls) == "a  b "


@pytest.mark.parametrize("text", [" A  b\tÉc ", "", " ", "a", "a  ", "\n", "x\n y"])
def test_tokens_equal_tokenizer(spark, text):
    df = spark.createDataFrame([(text,)], "v string")
    expected = Tokenizer(inputCol="v", outputCol="t").transform(df).first()["t"]
    assert df.select(tokens("v")).first()[0] == expected


def test_null_gives_no_tokens(spark):
    assert one(spark, None, tokens) == []


def test_stop_words_equal_remover(spark):
    df = spark.createDataFrame([("the cat and the cat i'll not",)], "v string").withColumn("t", tokens("v"))
    expected = StopWordsRemover(inputCol="t", outputCol="o").transform(df).first()["o"]
    assert df.select(without_stop_words(F.col("t"))).first()[0] == expected == ["cat", "cat"]
    assert StopWordsRemover.loadDefaultStopWords("english") == STOP_WORDS


@pytest.mark.parametrize(
    "stamp, expected",
    [
        ("Mon Mar 04 05:06:07 +0000 2019", 1551675967.0),
        ("Mon Mar 04 07:36:07 +0230 2019", 1551675967.0),
        ("bad", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_created_at(spark, stamp, expected, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, stamp, lambda c: created_at_seconds(F.col(c))) == expected
        month = spark.range(1).select(year_month(F.lit(1359676799.0)), year_month(F.lit(1359676800.0))).first()
        assert tuple(month) == ("2013-01", "2013-02")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_text_is_cleaned_once(spark):
    """Each step of the cleaning stands in the plan once, and cuts begin at the first mark."""
    rows = [("É a@ann #x b@@annann http://u.v/#x #x!", "ann ann", "x"), ("no marks", "ann", "x"), ("@x", None, "x"), ("#x", "y", None), (None, "a", "b")]
    df = spark.createDataFrame(rows, "term string, mention string, hashtag string")
    found = df.select(clean_term().alias("term"))
    assert [r.term for r in found.collect()] == ["a b", "no marks", "x", "x", "empty_tweet"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("https?") == 1
