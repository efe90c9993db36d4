"""Text cleaning and tokenising as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from topicmill import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row, however often `use` names it:
    the planner copies a plain expression to every place."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blank(c: Column) -> Column:
    # SQL trim takes off spaces only: a tab is content.
    return c.isNull() | (F.trim(c) == "")


def clean_location(location: Column | str) -> Column:
    """`loc_` plus the words joined by `_`, ASCII lower case, no punctuation.

    One `translate` does it all: letters are lowered, the space becomes `_` and
    punctuation, having no counterpart, is deleted. Non-ASCII letters stay.
    """
    c = _col(location)
    words = F.translate(
        F.trim(c), C.ASCII_UPPER + " " + C.PUNCTUATION, C.ASCII_LOWER + "_"
    )
    return F.when(_blank(c), C.EMPTY_LOCATION).otherwise(F.concat(F.lit(C.LOCATION_PREFIX), words))


def clean_hashtag(hashtag: Column | str) -> Column:
    c = _col(hashtag)
    return F.when(_blank(c), C.EMPTY_HASHTAG).otherwise(c)


def clean_mention(mention: Column | str) -> Column:
    c = _col(mention)
    return F.when(_blank(c), C.EMPTY_MENTION).otherwise(c)


def remove_marked(text: Column | str, names: Column | str, mark: str, whole_token: bool = False) -> Column:
    """Cut `mark + name` out of `text` for every name of a space-joined list.

    A plain substring cut by default, so removing `@ann` turns `@annabel` into
    `abel`; `whole_token` cuts only where no further word character follows.
    """
    c, listed = _col(text), F.filter(F.split(_col(names), r"\s+"), lambda n: n != "")
    if whole_token:
        quoted = F.transform(listed, lambda n: F.concat(F.lit("\\Q"), n, F.lit("\\E")))
        pattern = F.concat(F.lit(mark + "(?:"), F.array_join(quoted, "|"), F.lit(r")(?!\w)"))
        return F.when(F.coalesce(F.size(listed), F.lit(0)) > 0, F.regexp_replace(c, pattern, F.lit(""))).otherwise(c)
    # No cut begins before the first mark: only the text from there on is searched.
    def cut(whole: Column) -> Column:
        at = F.instr(whole, mark)
        left = F.aggregate(
            listed,
            F.substring(whole, at, F.length(whole)),
            lambda rest, name: F.replace(rest, F.concat(F.lit(mark), name), F.lit("")),
        )
        return F.when(at > 0, F.concat(F.substring(whole, F.lit(1), at - 1), left)).otherwise(whole)

    return F.when(_col(names).isNull(), c).otherwise(_once(c, cut))


def strip_urls(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"https?://\S+", "")


def clean_term(
    term: Column | str = "term",
    mention: Column | str = "mention",
    hashtag: Column | str = "hashtag",
    whole_token: bool = False,
) -> Column:
    """Post text without mentions, hashtags, URLs, punctuation and extra space.

    The blank test runs before punctuation goes, so `!!!` becomes an empty
    string while `:` (colons go first) becomes the sentinel.
    """
    ascii_text = F.regexp_replace(_col(term), r"[^\x00-\x7F]", "")
    unmarked = remove_marked(ascii_text, mention, "@", whole_token)
    unmarked = remove_marked(unmarked, hashtag, "#", whole_token)
    lowered = F.lower(F.replace(strip_urls(unmarked), F.lit(":"), F.lit("")))

    def words(left: Column) -> Column:
        plain = F.trim(F.regexp_replace(F.translate(left, C.PUNCTUATION, ""), r"\s+", " "))
        return F.when(_blank(left), C.EMPTY_TERM).otherwise(plain)

    return _once(lowered, words)


def tokens(text: Column | str) -> Column:
    """Lower-cased tokens between single whitespace characters.

    Same result as pyspark.ml's Tokenizer: inner and leading empty tokens stay,
    trailing ones go; a null gives no tokens instead of an error.
    """
    lowered = F.lower(_col(text))
    kept = F.split(F.regexp_replace(lowered, r"\s+\z", ""), r"\s")
    nothing = F.array().cast("array<string>")
    return F.when(lowered.isNull() | lowered.rlike(r"\A\s+\z"), nothing).otherwise(kept)


def without_stop_words(words: Column, stop_words: list[str] | None = None) -> Column:
    """Drop English stop words; repeats of other words stay."""
    if stop_words is None:
        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    return F.filter(words, lambda w: ~w.isin(stop_words))
