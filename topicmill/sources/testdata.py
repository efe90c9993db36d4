"""Posts, raw lines and a topic dictionary derived from the shared test tables.

Long words of a document's whole text stand in for hashtags and mentions, and
are also written into the text with their marks, as in a real post.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicmill.operators.labelling import explode_hashtags
from topicmill.schema import POST_COLUMNS
from topicmill.sources.posts import spread

TAG_LENGTH = 12
MENTION_LENGTH = 10
TOPIC_SIZE = 20
# Topics of the dictionary with several, and hashtags in it.
TOPICS, TOPICS_SIZE = 3, 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its first event and the words used as tags.

    Events fall to documents by their id modulo the number of documents; of a
    document's events the first in time counts, equal times by id. Documents
    without an event are of type `none`, by user 0 at time 0.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    number = docs.select("doc_id").agg(F.count("*")).scalar()
    event = F.struct("ts", "event_id", "user_id", "event_type")
    first = events.groupBy(F.pmod("event_id", number).alias("_doc")).agg(F.min_by(event, F.struct("ts", "event_id")).alias("e"))
    events = first.select("_doc", "e.*")
    seconds = F.expr("cast(ts - timestamp_ntz'1970-01-01 00:00:00' as interval second)")
    words = F.split("text", "[^A-Za-z]+")
    joined = docs.join(events, docs["doc_id"] == events["_doc"], "left")
    return (
        joined.withColumn("seconds", F.coalesce(F.floor(seconds.cast("decimal(20,6)")).cast("double"), F.lit(0.0)))
        .fillna({"user_id": 0, "event_type": "none"})
        .withColumn("words", words)
        .withColumn("tags", F.filter("words", lambda w: F.length(w) >= TAG_LENGTH))
        .withColumn(
            "names",
            F.filter("words", lambda w: (F.length(w) >= MENTION_LENGTH) & (F.length(w) < TAG_LENGTH)),
        )
    )


def _location() -> Column:
    return (
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .when(F.col("event_type") == "signup", "  ")
        .otherwise(F.concat("source", F.lit(", "), F.upper("event_type"), F.lit(".")))
    )


def _post_text() -> Column:
    parts = F.concat(
        F.array("text"),
        F.transform("names", lambda n: F.concat(F.lit("@"), n)),
        F.transform("tags", lambda t: F.concat(F.lit("#"), t)),
        F.array(F.concat(F.lit("https://posts.example/"), F.col("doc_id").cast("string"))),
    )
    return F.array_join(parts, " ")


def _columns() -> dict[str, Column]:
    return {
        "create_time": F.col("seconds"),
        "from_id": F.col("user_id").cast("string"),
        "from_user": F.concat(F.lit("user"), F.col("user_id").cast("string")),
        "hashtag": F.array_join("tags", " "),
        "location": _location(),
        "mention": F.array_join("names", " "),
        "term": _post_text(),
        "tweet_id": F.col("doc_id").cast("string"),
    }


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed English posts, one per English document."""
    columns = _columns()
    english = _joined(spark, sf_dir).where(F.col("lang") == "en")
    return english.select(*[columns[name].alias(name) for name in POST_COLUMNS])


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines, one per document of any language; some of them damaged.

    By event type: `error` lines lost their closing brace, `signup` lines hold
    one key only, `purchase` lines lack the language. Of `click` lines those with
    an odd id have their ids as JSON strings. Of `view` lines some go on after the
    object (with another object, or with junk), some hold a raw control character,
    by the remainder of the id.
    """
    instant = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=F.col("seconds"))
    columns = _columns()
    lang = F.when(F.col("event_type") != "purchase", F.col("lang"))
    record = F.struct(
        F.date_format(instant, "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
        F.col("doc_id").alias("id"),
        columns["term"].alias("text"),
        lang.alias("lang"),
        F.struct(
            F.col("user_id").alias("id"),
            columns["from_user"].alias("screen_name"),
            columns["location"].alias("location"),
        ).alias("user"),
        F.struct(
            F.transform("tags", lambda t: F.struct(t.alias("text"))).alias("hashtags"),
            F.transform("names", lambda n: F.struct(n.alias("screen_name"))).alias("user_mentions"),
        ).alias("entities"),
    )
    full = F.to_json(record)
    quoted = F.regexp_replace(full, r'"id":(\d+)', r'"id":"$1"')
    rest = F.col("doc_id") % 8
    view = F.col("event_type") == "view"
    line = (
        F.when(view & (rest == 1), F.concat(full, full))
        .when(view & (rest == 2), F.concat(full, F.lit(" junk}")))
        .when(view & (rest == 3), F.concat(full, F.lit("] junk}")))
        .when(view & (rest == 4), F.replace(full, F.lit('"lang":"'), F.lit('"lang":"\x01')))
        .when((F.col("event_type") == "click") & (F.col("doc_id") % 2 == 1), quoted)
        .when(F.col("event_type") == "error", F.regexp_replace(full, r"\}\z", ""))
        .when(F.col("event_type") == "signup", F.to_json(F.struct(F.col("doc_id").alias("id"))))
        .otherwise(full)
    )
    # Generated rather than projected: filters that are pushed below a projection
    # would each write every line again.
    return _joined(spark, sf_dir).select(F.explode(F.array(line)).alias("value"))


def topic_hashtags(all_posts: DataFrame) -> DataFrame:
    """Topic `t1`: the 20 hashtags found in most posts, ties by name."""
    per_post = explode_hashtags(all_posts, "tweet_id").where(F.col("each_hashtag") != "").distinct()
    frequent = per_post.groupBy("each_hashtag").agg(F.count("*").alias("df"))
    top = frequent.orderBy(F.desc("df"), "each_hashtag").limit(TOPIC_SIZE)
    return top.select(F.lit("t1").alias("topic"), F.col("each_hashtag").alias("hashtag"), "df")


def several_topics(all_posts: DataFrame) -> DataFrame:
    """Topics `t1` to `t3`: the 60 hashtags found in most posts, dealt in turn."""
    per_post = explode_hashtags(all_posts, "tweet_id").where(F.col("each_hashtag") != "").distinct()
    frequent = per_post.groupBy("each_hashtag").agg(F.count("*").alias("df"))
    top = frequent.orderBy(F.desc("df"), "each_hashtag").limit(TOPICS_SIZE)
    place = F.row_number().over(Window.orderBy(F.desc("df"), "each_hashtag")) - 1
    topic = F.concat(F.lit("t"), (place % TOPICS + 1).cast("string"))
    return top.select(topic.alias("topic"), F.col("each_hashtag").alias("hashtag"))


def dated_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per order, at the start of its day: several years of months."""
    orders = table(spark, sf_dir, "orders")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    columns = {
        "create_time": (days * 86400).cast("double"),
        "from_id": F.col("o_custkey").cast("string"),
        "from_user": F.concat(F.lit("user"), F.col("o_custkey").cast("string")),
        "hashtag": F.lower("o_orderpriority"),
        "location": F.col("o_orderstatus"),
        "mention": F.lit(""),
        "term": F.col("o_orderstatus"),
        "tweet_id": F.col("o_orderkey").cast("string"),
    }
    return orders.select(*[columns[name].alias(name) for name in POST_COLUMNS])
