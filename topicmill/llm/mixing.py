"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source gets a share of the budget in proportion to its weight, but at most
`max_epochs` times its own size; what a capped source cannot take is shared out
again by weight until no source is above its cap. Each document is then repeated:
a ratio of 2.3 means two whole repetitions for all documents and a third one for
those first in a seeded order, until 0.3 of the source is reached.

DataFrame functions only. A source never comes together in one task: sizes are
summed per (source, hash bucket) on the map side first, the third repetition is
decided from those sums, and documents join the small table of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicmill.llm.common import SPACE_WORD, shielded
from topicmill.session import stage

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKETS = 1024
SEED = 17


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def _bits(key: Column, seed: int) -> Column:
    """32 bits from a row's key. md5 rather than a Spark hash, so that other
    engines can repeat it."""
    digest = F.md5(F.concat_ws("#", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def ranked_sources(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources in code point order, null last, with the repeating weights.

    Positions come from a range partitioning: the rank within the partition plus
    the rows of the partitions before it, so no task sees all sources.
    """
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = stage(
        sizes.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "mix_sources"
    )
    before = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per partition: bounded by the number of shuffle partitions.
    before = before.withColumn(
        "_before", F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before") - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_place"), F.lit(len(weights))) + 1).cast("int"))
    return (
        ranged.join(F.broadcast(before), "_part")
        .withColumn("_place", place)
        .withColumn("weight", weight.cast("long"))
        .select("source", "source_size", "weight")
    )


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds `target` to (source, source_size, weight).

    Each round clamps the sources whose share is above their cap and spreads the
    rest of the budget over the others by weight. A round is one aggregate to a
    single row; clamped sources stay clamped, since the level only rises.
    """
    sources = stage(sources, "mix_weighted")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap = F.col("source_size") * F.lit(max_epochs)
    rest, weight, clamped = total, 0, -1
    while True:
        # Clamped at a level of rest/weight per unit of weight, in whole numbers.
        share = F.col("weight").cast("decimal(10,0)") * F.lit(rest).cast("decimal(20,0)")
        is_capped = cap.cast("decimal(20,0)") * F.lit(weight).cast("decimal(18,0)") < share if weight else F.lit(False)
        row = sources.agg(
            F.coalesce(F.sum(F.when(is_capped, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_capped, F.col("weight"))), F.lit(0)),
            F.count(F.when(is_capped, 1)),
        ).first()
        if row[2] == clamped or not row[1]:
            break
        rest, weight, clamped = total - row[0], row[1], row[2]
    level = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight or 1))
    return sources.withColumn("target", F.least(cap.cast("double"), level) if weight else cap.cast("double"))


@shielded("doc_id", "source", "text", made=("size", "source_size", "target", "whole", "taken"))
def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """`docs` with size, source_size, target, whole, and taken.

    `whole` is the number of whole repetitions, `taken` the words of all of them
    plus those of a last partial one (only documents of the one bucket in which
    the source reaches its target have a partial repetition).

    Null and empty texts have size 0 and are taken 0 times; null sources are a
    source of their own, last in order. Repeated rows and rows without id are
    rows of their own, decided by the same hash. An empty table stays empty.
    Extra columns pass through; columns named like an output are replaced.
    """
    made = ["size", "source_size", "target", "whole", "taken"]
    kept = [c for c in docs.columns if c not in made]
    bucket = (_bits(F.col(id_col), seed) / F.lit(1 << 32) * F.lit(BUCKETS)).cast("int")
    sized = docs.select(*kept).withColumn("size", word_count(F.col("text"))).withColumn("_bucket", bucket)

    # Rows of (source, bucket): bounded by the sources, not by the documents.
    sums = sized.select("source", "_bucket", "size").groupBy("source", "_bucket").agg(F.sum("size").alias("_words"))
    sums = stage(sums, "mix_buckets")
    sizes = sums.groupBy("source").agg(F.sum("_words").alias("source_size"))
    plan = water_fill(ranked_sources(sizes, weights), max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("_whole", F.floor(ratio)).withColumn(
        "_left", F.greatest(F.col("target") - F.col("_whole") * F.col("source_size"), F.lit(0.0))
    )
    cumulative = F.sum("_words").over(
        Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    cut = sums.withColumn("_before", F.coalesce(cumulative, F.lit(0)))
    cut = cut.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # The last bucket with something left, and the share of it that is taken.
    cut = cut.where((F.col("_before") < F.col("_left")) & (F.col("_words") > 0))
    cut = cut.groupBy("source").agg(
        F.max_by(F.struct("_bucket", F.least((F.col("_left") - F.col("_before")) / F.col("_words"), F.lit(1.0)).alias("share")), "_bucket").alias("_cut")
    )
    plan = plan.join(cut.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    plan = stage(
        plan.select(F.col("source").alias("_s"), "source_size", "target", "_whole", "_cut"), "mix_plan"
    )
    jitter = _bits(F.col(id_col), seed + 1) / F.lit(1 << 32)
    partial = (
        F.when(F.col("_cut").isNull() | (F.col("_bucket") > F.col("_cut._bucket")), F.lit(0))
        .when(F.col("_bucket") < F.col("_cut._bucket"), F.col("size"))
        .otherwise(F.least(F.col("size"), F.floor(F.col("_cut.share") * F.col("size") + jitter)))
    )
    # A hot source is split by the planner: the plan's side is small or skew-joined.
    return (
        sized.join(plan, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("taken", (F.col("_whole") * F.col("size") + partial).cast("long"))
        .withColumn("whole", F.col("_whole").cast("long"))
        .select(*kept, *made)
    )
