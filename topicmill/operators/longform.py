"""Sparse counts in long form, without a vocabulary on the driver.

`features.feature_model` keeps its vocabulary in the model, as Spark's count model
does. Here the vocabulary stays a table and counts are rows `(id, block, idx, cnt)`,
so neither the driver nor a task ever holds it whole.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicmill.constants import BLOCKS, VOCAB_SIZE
from topicmill.functions.text import tokens, without_stop_words
from topicmill.operators import features

# Most frequent tokens of each block that are joined by broadcast: five blocks of
# that many rows at most, whatever the corpus.
HEAVY = 1000


def token_counts(posts: DataFrame, blocks: Iterable[str] = tuple(BLOCKS), key: str = "tweet_id") -> DataFrame:
    """`(key, block, token, cnt)`; stop words are left out before anything moves.

    The exchange is by key and token, so a token that every post holds is dealt
    like any other. Rows that repeat a key add up.
    """
    words = {b: without_stop_words(tokens(BLOCKS[b])) if b == "term" else tokens(BLOCKS[b]) for b in blocks}
    lists = F.array(*[F.struct(F.lit(b).alias("block"), w.alias("words")) for b, w in words.items()])
    rows = posts.select(key, F.inline(lists)).select(key, "block", F.explode("words").alias("token"))
    return rows.groupBy(key, "block", "token").agg(F.count("*").alias("cnt"))


def encode(
    posts: DataFrame, vocabularies: DataFrame, blocks: Iterable[str] = tuple(BLOCKS), key: str = "tweet_id", heavy: int = HEAVY
) -> DataFrame:
    """`(key, block, idx, cnt)` of the tokens in the vocabularies.

    `vocabularies` is a staged `fit_vocabularies`. Its `idx` ranks tokens by
    frequency, so the `heavy` first of each block are a bounded table, which is
    broadcast. What is left goes through a join that the planner may shuffle by
    token: there no token has more than one in `heavy` of a block's occurrences.
    """
    blocks = list(blocks)
    counts = token_counts(posts, blocks, key)
    known = vocabularies.where(F.col("block").isin(blocks)).select("block", "token", "idx")
    frequent = known.where(F.col("idx") < heavy).withColumnRenamed("idx", "_idx")
    found = counts.join(F.broadcast(frequent), ["block", "token"], "left")
    at_once = found.where("_idx is not null").select(key, "block", F.col("_idx").alias("idx"), "cnt")
    rest = found.where("_idx is null").drop("_idx").join(known.where(F.col("idx") >= heavy), ["block", "token"])
    return at_once.unionByName(rest.select(key, "block", "idx", "cnt")).withColumn("cnt", F.col("cnt").cast("double"))


def assemble(encoded: DataFrame, vocabularies: DataFrame, key: str = "tweet_id") -> DataFrame:
    """`(key, global_idx, cnt)`: indices over all blocks, in the order of assembly."""
    return encoded.join(F.broadcast(features.block_offsets(vocabularies)), "block").select(
        key, (F.col("idx") + F.col("offset")).cast("int").alias("global_idx"), "cnt"
    )


def cut_tokens(
    posts: DataFrame, min_df: dict[str, int] | None = None, vocab_size: int = VOCAB_SIZE, blocks: Iterable[str] = tuple(BLOCKS)
) -> DataFrame:
    """Per block, what a vocabulary leaves out: `(block, kept, below_floor, beyond_size,
    kept_uses, beyond_uses)`.

    `beyond_size` are tokens above the document-frequency floor that the cap cuts;
    `*_uses` count occurrences. One aggregate per block; nothing is ranked.
    """
    blocks = list(blocks)
    floors = features.floor_of(blocks, min_df)
    counts = features.token_statistics(posts, blocks)
    ranked = counts.withColumn("passes", F.col("df") >= floors)
    by_block = Window.partitionBy("block")
    totals = ranked.groupBy("block", "tf", "passes").agg(F.count("*").alias("n"))
    # Rows are distinct frequencies now, not tokens: the running count fits one task.
    above = by_block.orderBy(F.desc("passes"), F.desc("tf")).rowsBetween(Window.unboundedPreceding, -1)
    room = F.greatest(F.lit(0), F.lit(vocab_size) - F.coalesce(F.sum("n").over(above), F.lit(0)))
    kept = F.when(F.col("passes"), F.least(F.col("n"), room)).otherwise(F.lit(0))
    placed = totals.withColumn("kept", kept)
    beyond = F.when(F.col("passes"), F.col("n") - F.col("kept")).otherwise(0)
    return placed.groupBy("block").agg(
        F.sum("kept").alias("kept"),
        F.sum(F.when(~F.col("passes"), F.col("n")).otherwise(0)).alias("below_floor"),
        F.sum(beyond).alias("beyond_size"),
        F.sum(F.col("kept") * F.col("tf")).alias("kept_uses"),
        F.sum(beyond * F.col("tf")).alias("beyond_uses"),
    )
