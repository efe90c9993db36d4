"""The whole job: raw lines to posts, posts to feature tables, tables to a model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicmill import constants as C
from topicmill.functions.vectors import bare
from topicmill.learning import ChiSquareTopFeatures, FixedValidationTuner, RankingEvaluator, default_grid
from topicmill.operators import labelling, splitting
from topicmill.operators.cleaning import clean_posts
from topicmill.operators.features import feature_model
from topicmill.operators.language import LanguageFilter
from topicmill.operators.parsing import parse_posts
from topicmill.operators.sampling import stratified_sample
from topicmill.session import stage
from topicmill.sources.posts import GZIP_EXPANSION, read_raw_lines, spread
from topicmill.sources.sinks import write_monthly


def prepare_posts(
    spark: SparkSession,
    paths: str | list[str],
    output: str,
    language_filter: LanguageFilter | None = None,
    lang: str = "en",
    min_length: int = C.MIN_LINE_LENGTH,
) -> None:
    """Raw files to month folders of parsed posts in one language.

    Decoding and flattening run where the lines are read and throw most bytes away.
    Before the costly language filter the posts are dealt over as many tasks as the
    files' size asks for, since a gzip file is one task whatever its size. The other
    exchange sizes the output files.
    """
    lines = read_raw_lines(spark, paths)
    posts = parse_posts(lines, min_length, lang)
    if language_filter is not None:
        posts = language_filter.keep(spread(posts, lines, GZIP_EXPANSION), lang)
    write_monthly(posts, output)


def labelled_posts(posts: DataFrame, tags: DataFrame, unique_ids: bool = False, are_clean: bool = False) -> DataFrame:
    """Cleaned posts with `label`; `are_clean` where `posts` went through `clean_posts`."""
    cleaned = posts if are_clean else clean_posts(posts)
    if unique_ids:
        return labelling.label_by_row(cleaned, tags)
    return labelling.label_posts(cleaned, labelling.topical_ids(labelling.explode_hashtags(cleaned), tags))


def split_posts(
    labelled: DataFrame,
    tags: DataFrame,
    unique_ids: bool = False,
    train_share: float = C.TRAIN_SHARE,
    valid_share: float = C.VALID_SHARE,
) -> DataFrame:
    """Add `split` by hashtag birthdays and drop posts that leak earlier hashtags.

    The ranked hashtags (one row per curated hashtag) are written once: the cut
    times and the leakage guard then read that small table instead of walking
    the posts again. `labelled` is read twice, so pass a staged table.
    """
    birthdays = splitting.hashtag_birthdays(labelling.explode_hashtags(labelled), tags)
    ranked = stage(splitting.split_hashtags(birthdays, train_share, valid_share), "hashtag_periods")
    cutoffs = splitting.split_cutoffs(ranked, train_share, valid_share)
    split = splitting.assign_split(labelled, cutoffs)
    guard = splitting.drop_leaking_by_row if unique_ids else splitting.drop_leaking
    return guard(split, ranked)


@dataclass
class FeatureTables:
    """`combined`: tweet_id, create_time, features, label, type; `test` likewise without type."""

    combined: DataFrame
    test: DataFrame
    model: PipelineModel


def feature_tables(
    posts: DataFrame,
    tags: DataFrame,
    min_df: dict[str, int] | None = None,
    vocab_size: int = C.VOCAB_SIZE,
    train_fractions: dict[float, float] | None = None,
    valid_fractions: dict[float, float] | None = None,
    unique_ids: bool = False,
    fit_on_train: bool = False,
    seed: int = 0,
    are_clean: bool = False,
) -> FeatureTables:
    """Parsed posts to sampled train and valid rows and unsampled test rows.

    The cleaned, labelled posts, the split posts and both results are written
    once and read by every later step. Rows are sampled before they are
    vectorised, so the bulk of the negatives is never turned into vectors.
    `fit_on_train` keeps valid and test posts out of the vocabulary. `posts` are read
    twice: give a written table (cleaned, with `are_clean`) where building them is costly.
    """
    labelled = stage(labelled_posts(posts, tags, unique_ids, are_clean), "labelled_posts")
    split = stage(split_posts(labelled, tags, unique_ids), "split_posts")
    fitted_on = split.where(F.col("split") == "train") if fit_on_train else labelled
    model = feature_model(fitted_on, min_df, vocab_size)

    def part(name: str) -> DataFrame:
        return split.where(F.col("split") == name)

    def assembled(df: DataFrame) -> DataFrame:
        return model.transform(df).select("tweet_id", "create_time", bare("features"), "label")

    train = stratified_sample(part("train"), train_fractions or C.TRAIN_FRACTIONS, seed=seed)
    valid = stratified_sample(part("valid"), valid_fractions or C.VALID_FRACTIONS, seed=seed)
    combined = splitting.tag_and_union({"train": assembled(train), "valid": assembled(valid)})
    combined = stage(combined, "combined")

    test = model.transform(part("test"))
    compared = [f"{b}_features" for b in C.DEDUP_BLOCKS if f"{b}_features" in test.columns]
    columns = ["tweet_id", "create_time", bare("features"), "label", *[bare(c) for c in compared]]
    unique_test = splitting.drop_duplicate_content(test.select(*columns), compared)
    return FeatureTables(combined, stage(unique_test.drop(*compared), "test"), model)


def tune(
    combined: DataFrame,
    num_top_features=C.GRID_NUM_TOP_FEATURES,
    reg_param=C.GRID_REG_PARAM,
    max_iter=C.GRID_MAX_ITER,
    num_folds: int = C.NUM_FOLDS,
    parallelism: int = 4,
    seed: int = 0,
) -> tuple[CrossValidatorModel, FixedValidationTuner]:
    """Chi-square selection and logistic regression, tuned on average precision."""
    selector = ChiSquareTopFeatures(featuresCol="features", outputCol="selected", labelCol="label")
    classifier = LogisticRegression(featuresCol="selected", labelCol="label")
    tuner = FixedValidationTuner(
        estimator=Pipeline(stages=[selector, classifier]),
        estimatorParamMaps=default_grid(selector, classifier, num_top_features, reg_param, max_iter),
        evaluator=RankingEvaluator(metric="AP", idCol="tweet_id"),
        numFolds=num_folds,
        parallelism=parallelism,
        seed=seed,
    )
    return tuner.fit(combined), tuner
