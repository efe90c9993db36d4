"""Time-based split by hashtag birthdays, with a guard against leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicmill.constants import TRAIN_SHARE, VALID_SHARE
from topicmill.functions.text import tokens
from topicmill.functions.vectors import vector_entries
from topicmill.operators.labelling import bounded_list


def hashtag_birthdays(exploded: DataFrame, tags: DataFrame) -> DataFrame:
    """First time each of the topic's hashtags was seen, `(each_hashtag, birthday)`.

    The dictionary filters before the aggregate; `min` combines on the map side,
    so a hashtag that fills a third of all posts still sends one row per task.
    """
    of_topic = exploded.join(tags, "each_hashtag", "left_semi")
    return of_topic.groupBy("each_hashtag").agg(F.min("create_time").alias("birthday"))


def split_hashtags(
    birthdays: DataFrame, train_share: float = TRAIN_SHARE, valid_share: float = VALID_SHARE
) -> DataFrame:
    """Rank the topic's hashtags by birthday and cut them into three periods.

    Adds `tag_rank` (from 0), `n_tags` and `split`. The window sees one row per
    curated hashtag of one topic, never the posts. Equal birthdays go by name.
    """
    ordered = Window.orderBy("birthday", "each_hashtag")
    ranked = birthdays.select(
        "each_hashtag",
        "birthday",
        (F.row_number().over(ordered) - 1).alias("tag_rank"),
        F.count("*").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_tags"),
    )
    split = (
        F.when(F.col("tag_rank") < F.floor(F.col("n_tags") * F.lit(train_share)), "train")
        .when(F.col("tag_rank") < F.floor(F.col("n_tags") * F.lit(valid_share)), "valid")
        .otherwise("test")
    )
    return ranked.withColumn("split", split)


def split_cutoffs(
    ranked: DataFrame, train_share: float = TRAIN_SHARE, valid_share: float = VALID_SHARE
) -> DataFrame:
    """One row: `n_tags`, the two cut positions and the two cut times.

    A cut time is the birthday of the first hashtag behind the cut. An empty
    topic gives nulls, and nulls put no post into any split.
    """

    def position(share: float) -> Column:
        return F.floor(F.col("n_tags") * F.lit(share))

    def birthday_at(share: float) -> Column:
        return F.max(F.when(F.col("tag_rank") == position(share), F.col("birthday")))

    return ranked.agg(
        F.max("n_tags").alias("n_tags"),
        F.max(position(train_share)).alias("train_valid_pos"),
        F.max(position(valid_share)).alias("valid_test_pos"),
        birthday_at(train_share).alias("train_valid_time"),
        birthday_at(valid_share).alias("valid_test_time"),
    )


def assign_split(posts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Add `split`: up to the first cut time train, up to the second valid, then test.

    The cut times enter as one scalar subquery, which the planner runs once. A
    post on the first cut time belongs to train.
    """
    cut = cutoffs.select(F.struct("train_valid_time", "valid_test_time")).scalar()
    time = F.col("create_time")
    split = (
        F.when(time <= cut["train_valid_time"], "train")
        .when(time <= cut["valid_test_time"], "valid")
        .when(time > cut["valid_test_time"], "test")
    )
    return posts.withColumn("split", split).where(F.col("split").isNotNull())


def leaking_ids(posts: DataFrame, ranked: DataFrame) -> DataFrame:
    """`(tweet_id, split)` of valid and test posts with a hashtag of an earlier period."""
    later = posts.where(F.col("split").isin("valid", "test"))
    exploded = later.select("tweet_id", "split", F.explode(tokens("hashtag")).alias("each_hashtag"))
    known = ranked.where(F.col("split").isin("train", "valid")).select(
        "each_hashtag", F.col("split").alias("tag_split")
    )
    earlier = (F.col("tag_split") == "train") | (F.col("split") == "test")
    return exploded.join(known, "each_hashtag").where(earlier).select("tweet_id", "split").distinct()


def drop_leaking(posts: DataFrame, ranked: DataFrame) -> DataFrame:
    """Remove leaking posts by id, as an anti join; nothing is collected.

    Where one id holds a large part of all posts, write `leaking_ids` first and
    use `without_ids` (see `label_with_ids`).
    """
    return without_ids(posts, leaking_ids(posts, ranked))


def without_ids(posts: DataFrame, leaking: DataFrame) -> DataFrame:
    return posts.join(leaking, ["tweet_id", "split"], "left_anti")


def drop_leaking_by_row(posts: DataFrame, ranked: DataFrame) -> DataFrame:
    """`drop_leaking` for a table whose ids are unique: a filter, no shuffle.

    The hashtags travel as arrays of at most `MOST_LISTED`; a longer list raises.
    """

    def listed(*splits: str) -> Column:
        return bounded_list(ranked.where(F.col("split").isin(*splits)))

    words = tokens("hashtag")
    leaks = (
        F.when(F.col("split") == "valid", F.arrays_overlap(words, listed("train")))
        .when(F.col("split") == "test", F.arrays_overlap(words, listed("train", "valid")))
        .otherwise(False)
    )
    return posts.where(~leaks)


def split_counts(posts: DataFrame) -> DataFrame:
    """Rows and positive rows of every split in one pass."""
    return posts.groupBy("split").agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("label").cast("long")).alias("positive_count"),
    )


def drop_duplicate_content(
    posts: DataFrame, content: list[str], id_col: str = "tweet_id", keep: list[str] | None = None
) -> DataFrame:
    """Of posts equal in `content`, keep the one with the lowest id.

    Vectors are compared by their entries, so a dense and a sparse form of the
    same counts are equal. Of equal content and equal id the row with the lowest
    hash of its other columns stays. The key is a 256-bit digest. One aggregate
    carries the row to keep: posts are read, cleaned and hashed once, and a group of
    copies that holds a third of all rows leaves each task as one row. `keep` names
    the columns to return, all by default; only these are moved.
    """
    vector_like = {f.name for f in posts.schema if f.dataType.typeName() == "vectorudt"}
    parts = [
        (vector_entries(F.col(c)) if c in vector_like else F.col(c)).cast("string")
        for c in content
    ]
    # A length before each part keeps ("ab", "c") apart from ("a", "bc"); a null has none.
    framed = [F.concat_ws(":", F.coalesce(F.length(p).cast("string"), F.lit("-")), p) for p in parts]
    key = F.unhex(F.sha2(F.concat_ws("|", *framed), 256))
    others = [vector_entries(F.col(c)) if c in vector_like else F.col(c) for c in posts.columns]
    kept = keep or posts.columns
    order = F.struct(F.col(id_col).alias("id"), F.xxhash64(*others).alias("rest"))
    keyed = posts.select(key.alias("_key"), order.alias("_order"), F.struct(*kept).alias("_row"))
    return keyed.groupBy("_key").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")


def tag_and_union(parts: dict[str, DataFrame], column: str = "type") -> DataFrame:
    """Concatenate tables by column name, each tagged with its key."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in parts.items()]
    combined = tagged[0]
    for df in tagged[1:]:
        combined = combined.unionByName(df)
    return combined
