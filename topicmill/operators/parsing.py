"""Raw JSON lines to the eight-column post table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicmill.constants import MIN_LINE_LENGTH
from topicmill.functions.time import created_at_seconds
from topicmill.schema import POST_COLUMNS, RAW_POST

REQUIRED = ["create_time", "from_id", "from_user", "tweet_id"]
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _framed(line: Column, schema: str) -> tuple[Column, Column]:
    """The objects of a line, and whether the line is exactly one JSON object.

    Spark's parser stops behind the first value and ignores what follows. So the
    line is parsed as the only element of a list, with a hash of the line behind
    it: the hash comes back only if the parser has read up to there, and no line
    can contain its own hash.
    """
    found = _parsed(line, schema)
    return F.get(found["all"], F.lit(0)), _is_whole(line, found["all"], found["mark"])


def _parsed(line: Column, schema: str) -> Column:
    text = F.concat(F.lit('{"all":['), line, F.lit('],"mark":'), F.xxhash64(line).cast("string"), F.lit("}"))
    return F.from_json(text, f"all array<struct<{schema}>>, mark bigint", _STRICT)


def _is_whole(line: Column, objects: Column, mark: Column) -> Column:
    whole = (mark == F.xxhash64(line)) & (F.size(objects) == 1) & F.ltrim(line).startswith("{")
    return F.coalesce(whole, F.lit(False))


def with_records(lines: DataFrame, schema: str = RAW_POST) -> DataFrame:
    """`lines`, the fields of the record in `value`, and `is_object`; each line is
    parsed once.

    Generating the parsed line, rather than projecting it, keeps filters above the
    parser; pushed below, they would parse every line again.
    """
    parsed = lines.select(*lines.columns, F.inline_outer(F.array(_parsed(F.col("value"), schema))))
    whole = _is_whole(F.col("value"), F.col("all"), F.col("mark"))
    parsed = parsed.select(*lines.columns, whole.alias("is_object"), F.get("all", F.lit(0)).alias("_r"))
    return parsed.select(*lines.columns, "is_object", "_r.*")


def decode(line: Column | str, schema: str) -> Column:
    """A JSON line as a struct; null for anything but one well-formed object."""
    record, whole = _framed(F.col(line) if isinstance(line, str) else line, schema)
    return F.when(whole, record)


def is_object(line: Column) -> Column:
    """Whether the line is one well-formed JSON object and nothing else."""
    return _framed(line, "_none string")[1]


def close_object(line: Column) -> Column:
    """The line with a brace behind it where that makes it one JSON object."""
    closed = F.concat(line, F.lit("}"))
    return F.when(is_object(closed), closed).otherwise(line)


def long_lines(lines: DataFrame, min_length: int = MIN_LINE_LENGTH, column: str = "value") -> DataFrame:
    """Lines of more than `min_length` characters."""
    return lines.where(F.length(column) > min_length)


def json_keys(line: Column) -> Column:
    """Top-level keys of a JSON object; null for anything else."""
    return F.json_object_keys(line)


def objects_with_keys(lines: DataFrame, more_than: int = 1, column: str = "value") -> DataFrame:
    """Lines that hold a JSON object of more than `more_than` keys."""
    line = F.col(column)
    parsed = lines.select("*", F.explode(F.array(_parsed(line, "_none string"))).alias("_parsed"))
    whole = _is_whole(line, F.col("_parsed.all"), F.col("_parsed.mark"))
    return parsed.where(whole & (F.size(json_keys(line)) > more_than)).drop("_parsed")


def in_language(lines: DataFrame, lang: str = "en", column: str = "value") -> DataFrame:
    """Lines whose object has a `lang` key with the given value."""
    line = F.col(column)
    parsed = lines.select("*", F.explode(F.array(_parsed(line, "lang string"))).alias("_parsed"))
    whole = _is_whole(line, F.col("_parsed.all"), F.col("_parsed.mark"))
    return parsed.where(whole & (F.get("_parsed.all", F.lit(0))["lang"] == lang)).drop("_parsed")


def flatten() -> list[Column]:
    """The eight post columns from a decoded record; lists become space-joined strings."""
    return [
        created_at_seconds(F.col("created_at")).alias("create_time"),
        F.col("user.id").cast("string").alias("from_id"),
        F.col("user.screen_name").alias("from_user"),
        F.array_join("entities.hashtags.text", " ").alias("hashtag"),
        F.col("user.location").alias("location"),
        F.array_join("entities.user_mentions.screen_name", " ").alias("mention"),
        F.col("text").alias("term"),
        F.col("id").cast("string").alias("tweet_id"),
    ]


def parse_posts(
    lines: DataFrame,
    min_length: int = MIN_LINE_LENGTH,
    lang: str = "en",
    num_partitions: int | None = None,
) -> DataFrame:
    """Raw lines to parsed posts of one language, in one narrow stage.

    Each line is parsed once. An object with a language and an id has two keys,
    so the key-count filter needs no pass of its own here; posts that lack a
    required attribute are dropped, since the table does not allow nulls there
    (`rejected_lines` counts what is dropped, by reason).
    `num_partitions` spreads the parsed rows, for few large gzip files.
    """
    decoded = with_records(long_lines(lines.select("value"), min_length))
    kept = decoded.where(F.col("is_object") & (F.col("lang") == lang)).select(*flatten())
    posts = kept.dropna(subset=REQUIRED).select(*POST_COLUMNS)
    return posts.repartition(num_partitions) if num_partitions else posts


def rejection(min_length: int = MIN_LINE_LENGTH, lang: str = "en") -> Column:
    """Why a line of `with_records` gives no post; null where it does.

    Reasons in the order of the tests: `short`, `malformed`, `language` (another
    or none), `missing` (a required attribute is absent).
    """
    short = ~F.coalesce(F.length("value") > min_length, F.lit(False))
    missing = None
    posts = {c: e for c, e in zip(POST_COLUMNS, flatten())}
    for name in REQUIRED:
        missing = posts[name].isNull() if missing is None else missing | posts[name].isNull()
    return (
        F.when(short, "short")
        .when(~F.col("is_object"), "malformed")
        .when(~F.coalesce(F.col("lang") == lang, F.lit(False)), "language")
        .when(missing, "missing")
    )


def rejected_lines(lines: DataFrame, min_length: int = MIN_LINE_LENGTH, lang: str = "en") -> DataFrame:
    """`(reason, line_count)` of the lines that `parse_posts` leaves out."""
    reasons = with_records(lines.select("value")).select(rejection(min_length, lang).alias("reason"))
    return reasons.where("reason is not null").groupBy("reason").agg(F.count("*").alias("line_count"))


def typed_posts(records: DataFrame) -> DataFrame:
    """Bring loosely typed records (numeric ids, integer times) to the post schema."""
    return records.select(
        F.col("create_time").cast("double").alias("create_time"),
        *[F.col(c).cast("string").alias(c) for c in POST_COLUMNS if c != "create_time"],
    ).select(*POST_COLUMNS)
