from topicmill.functions.hashing import fold_of, uniform_from_id
from topicmill.functions.text import (
    clean_hashtag,
    clean_location,
    clean_mention,
    clean_term,
    remove_marked,
    strip_urls,
    tokens,
    without_stop_words,
)
from topicmill.functions.time import created_at_seconds, year_month
from topicmill.functions.vectors import positive_score, vector_entries

__all__ = [
    "clean_hashtag",
    "clean_location",
    "clean_mention",
    "clean_term",
    "created_at_seconds",
    "fold_of",
    "positive_score",
    "remove_marked",
    "strip_urls",
    "tokens",
    "uniform_from_id",
    "vector_entries",
    "without_stop_words",
    "year_month",
]
