"""Schemas of raw and parsed posts."""

from pyspark.sql import types as T

# The attributes of a raw post that are ever read; everything else in the JSON
# object is skipped by the parser. Ids are read as text, whether the line has them
# as numbers (of any size) or as strings.
RAW_POST = (
    "id string, text string, lang string, created_at string, "
    "user struct<id:string, screen_name:string, location:string>, "
    "entities struct<hashtags:array<struct<text:string>>, "
    "user_mentions:array<struct<screen_name:string>>>"
)

POST = T.StructType(
    [
        T.StructField("create_time", T.DoubleType(), False),
        T.StructField("from_id", T.StringType(), False),
        T.StructField("from_user", T.StringType(), False),
        T.StructField("hashtag", T.StringType(), True),
        T.StructField("location", T.StringType(), True),
        T.StructField("mention", T.StringType(), True),
        T.StructField("term", T.StringType(), True),
        T.StructField("tweet_id", T.StringType(), False),
    ]
)

POST_COLUMNS = POST.fieldNames()

TOPIC = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("hashtag", T.StringType(), False),
    ]
)
