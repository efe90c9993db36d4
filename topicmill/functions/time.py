"""Post timestamps: unix seconds as double, always UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicmill.constants import CREATED_AT_PATTERN


def created_at_seconds(created_at: Column) -> Column:
    """Unix seconds of e.g. `Mon Mar 04 05:06:07 +0000 2019`; null if malformed.

    The weekday is skipped: it carries no information and Spark's formatter
    does not parse it. The stamp holds its own offset, so the session time zone
    has no say.
    """
    stamp = F.try_to_timestamp(F.substring(created_at, 5, 100), F.lit(CREATED_AT_PATTERN))
    return F.unix_timestamp(stamp).cast("double")


def year_month(create_time: Column) -> Column:
    """`yyyy-MM` in UTC whatever the session time zone is."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.substring((epoch + F.make_dt_interval(secs=create_time)).cast("string"), 1, 7)
