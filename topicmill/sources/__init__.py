from topicmill.sources.buckets import write_bucketed
from topicmill.sources.posts import read_posts_json, read_raw_lines, read_stage, spread
from topicmill.sources.sinks import (
    month_volume,
    partition_counts,
    read_libsvm,
    read_months,
    rewrite_months,
    write_json,
    write_libsvm,
    write_model,
    write_monthly,
    write_stage,
)
from topicmill.sources.topics import topic_tags, topics_from_mapping

__all__ = [
    "month_volume",
    "partition_counts",
    "read_libsvm",
    "read_months",
    "read_posts_json",
    "read_raw_lines",
    "read_stage",
    "rewrite_months",
    "spread",
    "topic_tags",
    "topics_from_mapping",
    "write_bucketed",
    "write_json",
    "write_libsvm",
    "write_model",
    "write_monthly",
    "write_stage",
]
