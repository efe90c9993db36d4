"""Second-level language filter: naive Bayes over character trigrams."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicmill.constants import LANGUAGES
from topicmill.functions.hashing import uniform_from_id

# The batch functions below travel with the job: executors need numpy and
# pandas, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A trigram of code points (a, b, c) falls into bucket
# (a * STEP * STEP + b * STEP + c) mod BUCKETS.
BUCKETS = 65521
STEP = 1031

COUNTS_SCHEMA = "lang string, bucket int, cnt long"
# Rows of this bucket hold a language's number of texts.
TEXTS = -1
# Characters that a task turns into trigrams at once (some 50 MB).
SLICE_CHARS = 1 << 20


def trigram_buckets(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams of a batch, and the position of each one's text."""
    encoded = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    owner = np.repeat(np.arange(len(encoded)), [len(e) // 4 for e in encoded])
    codes = np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int64)
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    within = owner[2:] == owner[:-2]
    buckets = (codes[:-2] * STEP * STEP + codes[1:-1] * STEP + codes[2:]) % BUCKETS
    return buckets[within], owner[:-2][within]


def text_slices(texts: pd.Series, limit: int = SLICE_CHARS) -> Iterator[slice]:
    """Parts of a batch with about `limit` characters, one text at least: what a
    task holds at once does not depend on the size of its batches."""
    ends = np.cumsum(texts.str.len().to_numpy(np.int64))
    at, base = 0, 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield slice(at, stop)
        at, base = stop, int(ends[stop - 1])


def _text(column: str) -> Column:
    return F.lower(F.coalesce(F.col(column), F.lit("")))


def trigram_counts(labelled: DataFrame, text_col: str, lang_col: str, languages: list[str]) -> DataFrame:
    """`(lang, bucket, cnt)` over all texts, plus the number of texts per language.

    A task adds up one fixed table of languages by buckets and sends its
    non-zero cells, so the exchange does not grow with the length of the texts.
    """
    known = labelled.where(F.col(lang_col).isin(languages))
    rows = known.select(F.col(lang_col).alias("lang"), _text(text_col).alias("text"))
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(len(languages) * BUCKETS, np.int64)
        texts = np.zeros(len(languages), np.int64)
        for batch in batches:
            for part in text_slices(batch["text"]):
                lang = batch["lang"].iloc[part].map(place).to_numpy(np.int64)
                buckets, owner = trigram_buckets(batch["text"].iloc[part])
                cells += np.bincount(lang[owner] * BUCKETS + buckets, minlength=len(cells))
                texts += np.bincount(lang, minlength=len(texts))
        names = np.array(languages, dtype=object)
        seen = np.flatnonzero(cells)
        yield pd.DataFrame({"lang": names[seen // BUCKETS], "bucket": seen % BUCKETS, "cnt": cells[seen]})
        yield pd.DataFrame({"lang": names, "bucket": TEXTS, "cnt": texts})

    partial = rows.mapInPandas(count, COUNTS_SCHEMA)
    return partial.groupBy("lang", "bucket").agg(F.sum("cnt").alias("cnt")).where("cnt > 0")


def held_out_split(labelled: DataFrame, id_col: str, held_out: float = 0.2, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows to train on and rows to measure on, told apart by a hash of the id: the
    same in every run and under every partitioning, and no row is in both."""
    drawn = uniform_from_id(F.col(id_col), seed)
    return labelled.where(drawn >= held_out), labelled.where(drawn < held_out)


class LanguageFilter:
    """Learns from rows with a known language, then keeps posts of one language.

    The model is a table of `languages x BUCKETS` numbers whatever the corpus,
    so it is broadcast and scoring is a narrow pass over the posts: no join, no
    shuffle. Only the text column visits Python, in Arrow batches, and one
    string per post comes back. (Built-in operators would need a row or a string
    object per character, and a shuffle to add them up again.)
    """

    def __init__(self, counts: pd.DataFrame):
        self.counts = table = counts  # at most languages x (BUCKETS + 1) rows
        texts = table[table["bucket"] == TEXTS].set_index("lang")["cnt"]
        self.languages: list[str] = sorted(texts.index)
        place = {name: i for i, name in enumerate(self.languages)}
        grams = table[table["bucket"] != TEXTS]
        cells = np.ones((len(self.languages), BUCKETS))  # one more than seen, for unseen trigrams
        cells[grams["lang"].map(place), grams["bucket"]] += grams["cnt"]
        prior = np.array([texts[name] for name in self.languages], dtype=float)
        self._log_prior = np.log(prior / prior.sum())
        self._log_cells = np.log(cells / cells.sum(axis=1, keepdims=True))

    @classmethod
    def train(
        cls,
        labelled: DataFrame,
        text_col: str = "term",
        lang_col: str = "lang",
        languages: list[str] | None = None,
    ) -> LanguageFilter:
        return cls(trigram_counts(labelled, text_col, lang_col, languages or LANGUAGES).toPandas())

    def detect(self, posts: DataFrame, text_col: str = "term", output_col: str = "detected_lang") -> DataFrame:
        """Add the most likely language; equal scores go by language code."""
        shared = posts.sparkSession.sparkContext.broadcast((self.languages, self._log_prior, self._log_cells))

        @F.pandas_udf("string")
        def most_likely(texts: pd.Series) -> pd.Series:
            languages, log_prior, log_cells = shared.value
            best = np.zeros(len(texts), np.int64)
            for part in text_slices(texts):
                some = texts.iloc[part]
                buckets, owner = trigram_buckets(some)
                scores = [
                    prior + np.bincount(owner, weights=cells[buckets], minlength=len(some))
                    for prior, cells in zip(log_prior, log_cells)
                ]
                best[part] = np.argmax(scores, axis=0)
            return pd.Series(np.array(languages, dtype=object)[best])

        # Called non-deterministic so that a filter on the result is not moved
        # below an exchange that spreads the rows, or evaluated a second time.
        return posts.withColumn(output_col, most_likely.asNondeterministic()(_text(text_col)))

    def keep(self, posts: DataFrame, lang: str = "en", text_col: str = "term") -> DataFrame:
        """Posts detected as `lang`, columns unchanged."""
        return self.detect(posts, text_col).where(F.col("detected_lang") == lang).select(*posts.columns)

    def confusion(self, labelled: DataFrame, text_col: str = "term", lang_col: str = "lang") -> DataFrame:
        """`(lang, detected_lang, text_count)` over labelled rows, such as held-out ones."""
        rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        found = self.detect(rows, "text")
        return found.groupBy("lang", "detected_lang").agg(F.count("*").alias("text_count"))

    def save(self, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
        spark.createDataFrame(self.counts, COUNTS_SCHEMA).write.mode(mode).parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LanguageFilter:
        return cls(spark.read.schema(COUNTS_SCHEMA).parquet(path).toPandas())
