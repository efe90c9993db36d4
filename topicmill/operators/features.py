"""Bag-of-words blocks: vocabularies, sparse counts, assembly."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark import SparkContext
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    CountVectorizerModel,
    StopWordsRemover,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicmill.constants import BLOCKS, MIN_DF, VOCAB_SIZE
from topicmill.functions.text import tokens
from topicmill.functions.vectors import vector_entries

# Term frequencies up to here get a histogram bin each, larger ones 64 bins per
# doubling: at most about 7,000 bins per block whatever the corpus size.
_EXACT_BINS = 4096


def token_statistics(posts: DataFrame, blocks: Iterable[str] = tuple(BLOCKS)) -> DataFrame:
    """`(block, token, df, tf)`: posts that hold the token, and occurrences.

    All blocks go through one scan and one exchange. Each post contributes its
    distinct tokens once (for `df`) and all its tokens once (for `tf`); the sums
    combine on the map side, so a token found in every post still costs one row
    per task. Stop words are dropped from the finished counts, where they are
    181 rows rather than half of all tokens.
    """
    words = posts.select(*[tokens(BLOCKS[b]).alias(b) for b in blocks])
    lists = F.array(
        *[
            F.struct(F.lit(b).alias("block"), words_of.alias("words"), F.lit(once).alias("once"))
            for b in blocks
            for words_of, once in ((F.array_distinct(b), True), (F.col(b), False))
        ]
    )
    rows = words.select(F.inline(lists)).select("block", "once", F.explode("words").alias("token"))
    counts = rows.groupBy("block", "token").agg(
        F.count(F.when(F.col("once"), 1)).alias("df"), F.count(F.when(~F.col("once"), 1)).alias("tf")
    )
    stop_words = StopWordsRemover.loadDefaultStopWords("english")
    return counts.where((F.col("block") != "term") | ~F.col("token").isin(stop_words))


def _frequency_bin() -> Column:
    tf = F.col("tf")
    log_bin = F.floor(F.log2(tf / _EXACT_BINS) * 64) + _EXACT_BINS
    return F.when(tf <= _EXACT_BINS, tf).otherwise(log_bin)


def floor_of(blocks: Iterable[str], min_df: dict[str, int] | None = None) -> Column:
    """Least number of posts that a row's block asks of a token."""
    floors = MIN_DF | (min_df or {})
    return reduce(lambda acc, b: F.when(F.col("block") == b, F.lit(floors[b])).otherwise(acc), blocks, F.lit(1))


def fit_vocabularies(
    posts: DataFrame,
    min_df: dict[str, int] | None = None,
    vocab_size: int = VOCAB_SIZE,
    blocks: Iterable[str] = tuple(BLOCKS),
) -> DataFrame:
    """`(block, token, df, tf, idx)` for tokens found in at least `min_df` posts.

    Per block, `idx` counts from 0 by falling term frequency, equal ones by
    token, up to `vocab_size`. Ranking every surviving token in one task per
    block would not scale, so a histogram of term frequencies (a few thousand
    bins, all in the aggregate) first finds the bin in which the cap falls; only
    tokens from that bin upwards are ranked.
    """
    blocks = list(blocks)
    least = floor_of(blocks, min_df)
    frequent = token_statistics(posts, blocks).where(F.col("df") >= least).withColumn("_bin", _frequency_bin())

    above = Window.partitionBy("block").orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        frequent.groupBy("block", "_bin")
        .agg(F.count("*").alias("n"))
        .withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
        .where(F.col("above") < vocab_size)
        .groupBy("block")
        .agg(F.min("_bin").alias("_cut"))
    )
    # `cut` has one row per block, five at most.
    candidates = frequent.join(F.broadcast(cut), "block").where(F.col("_bin") >= F.col("_cut"))
    order = Window.partitionBy("block").orderBy(F.desc("tf"), "token")
    ranked = candidates.withColumn("idx", F.row_number().over(order) - 1)
    return ranked.where(F.col("idx") < vocab_size).select("block", "token", "df", "tf", "idx")


def block_offsets(vocabularies: DataFrame) -> DataFrame:
    """`(block, offset)`: first assembled index of each block, five rows at most."""
    place = F.array_position(F.array(*[F.lit(b) for b in BLOCKS]), F.col("block"))
    sizes = vocabularies.groupBy("block").agg(F.count("*").alias("size")).withColumn("place", place)
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))


def feature_names(vocabularies: DataFrame) -> DataFrame:
    """Name every assembled feature: `(global_idx, block, idx, token)`.

    Offsets follow the assembly order. At most five vocabularies of
    `vocab_size` tokens come in; the sizes are one row per block.
    """
    named = vocabularies.join(F.broadcast(block_offsets(vocabularies)), "block")
    return named.select((F.col("idx") + F.col("offset")).cast("long").alias("global_idx"), "block", "idx", "token")


def collect_vocabularies(vocabularies: DataFrame) -> dict[str, list[str]]:
    """Token lists per block on the driver, as a count model keeps them.

    Bounded by `vocab_size` tokens per block.
    """
    rows = vocabularies.orderBy("block", "idx").select("block", "token").collect()
    found: dict[str, list[str]] = {}
    for row in rows:
        found.setdefault(row["block"], []).append(row["token"])
    return found


def count_model(vocabulary: list[str], input_col: str, output_col: str) -> CountVectorizerModel:
    """`CountVectorizerModel.from_vocabulary` in one call to the JVM.

    The method itself sends token by token, which takes minutes for a full
    vocabulary. Tokens never hold a line break, since they are cut at white space.
    """
    if not vocabulary:
        raise ValueError("the vocabulary is empty")
    jvm = SparkContext._active_spark_context._jvm
    listed = jvm.java.util.regex.Pattern.compile("\n").split("\n".join(vocabulary), -1)
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", listed)
    model._set(vocabSize=len(vocabulary))
    return model.setInputCol(input_col).setOutputCol(output_col)


def block_stages(block: str, vocabulary: list[str]) -> list[Transformer]:
    """Fitted stages that turn a text column into `<block>_features`."""
    tokenizer = Tokenizer(inputCol=BLOCKS[block], outputCol=f"{block}_tokens")
    stages: list[Transformer] = [tokenizer]
    if block == "term":
        stages.append(StopWordsRemover(inputCol=tokenizer.getOutputCol(), outputCol="term_kept"))
    return [*stages, count_model(vocabulary, stages[-1].getOutputCol(), f"{block}_features")]


def feature_model(
    posts: DataFrame,
    min_df: dict[str, int] | None = None,
    vocab_size: int = VOCAB_SIZE,
    blocks: Iterable[str] = tuple(BLOCKS),
    assemble: bool = True,
) -> PipelineModel:
    """Fit all blocks in one pass over `posts`; the model can be saved and reused.

    The default fits on whatever table is given (all posts, before any split);
    pass the train rows to keep later tokens out of the vocabulary. A block
    that no token passes the floor of is left out of the assembled vector.
    """
    found = collect_vocabularies(fit_vocabularies(posts, min_df, vocab_size, blocks))
    return model_from_vocabularies(found, assemble)


def model_from_vocabularies(found: dict[str, list[str]], assemble: bool = True) -> PipelineModel:
    stages: list[Transformer] = []
    present = [b for b in BLOCKS if found.get(b)]
    for block in present:
        stages += block_stages(block, found[block])
    if assemble and present:
        stages.append(VectorAssembler(inputCols=[f"{b}_features" for b in present], outputCol="features"))
    return PipelineModel(stages)


def long_counts(vectors: DataFrame, column: str, *keep: str) -> DataFrame:
    """A vector column as rows `(keep..., idx, cnt)`; no shuffle, no join."""
    kept = keep or ("tweet_id",)
    entries = vectors.select(*kept, F.inline(vector_entries(F.col(column))))
    return entries.withColumnRenamed("value", "cnt")


def first_rows(rows: DataFrame, key: str = "tweet_id") -> DataFrame:
    """One row per key: the first in the order of its columns, vectors by entries.

    Which row stays depends on the rows alone, never on their order or partitions.
    The aggregate combines on the map side, so a hot key is one row per task.
    """
    vectors = {f.name for f in rows.schema if f.dataType.typeName() == "vectorudt"}
    others = [c for c in rows.columns if c != key]
    if not others:
        return rows.distinct()
    order = F.struct(*[vector_entries(F.col(c)) if c in vectors else F.col(c) for c in others])
    return rows.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_row")).select(key, "_row.*").select(*rows.columns)


def join_blocks(blocks: list[DataFrame], key: str = "tweet_id") -> DataFrame:
    """Inner-join feature tables on their key.

    Every table is exchanged once: the result of each join stays partitioned by
    the key; tables from `write_bucketed` by that key are not exchanged at all. Of a
    repeated key the first table keeps all rows and the others their first one (see
    `first_rows`), so a key that occurs k times gives k rows. When all blocks come
    from one table, `feature_model` needs no join at all.
    """
    first, *others = blocks
    return reduce(lambda left, right: left.join(first_rows(right, key), key), others, first)


def with_labels(features: DataFrame, labels: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Feature rows with their label; an id counts once per distinct label."""
    return features.join(labels.select(key, "label").distinct(), key)
