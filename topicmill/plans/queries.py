"""Every operator as a query over the shared test tables.

Each takes `(spark, sf_dir)` and runs over the whole tables it names.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicmill import constants as C
from topicmill import learning
from topicmill.functions import (
    clean_hashtag,
    clean_location,
    clean_mention,
    clean_term,
    created_at_seconds,
    strip_urls,
    tokens,
    without_stop_words,
)
from topicmill.functions.time import year_month
from topicmill.functions.vectors import bare
from topicmill.operators import features as feats
from topicmill.operators import labelling, longform, parsing, quarantine, ranking, sampling, splitting, topics
from topicmill.operators.cleaning import clean_posts
from topicmill.operators.language import LanguageFilter, held_out_split
from topicmill.plans import flow
from topicmill.session import stage, stage_path
from topicmill.sources import sinks, testdata
from topicmill.sources.buckets import write_bucketed
from topicmill.sources.posts import GZIP_EXPANSION, folder_of, read_posts_json, read_raw_lines, spread
from topicmill.sources.topics import topic_tags

# The document-frequency floors of the test tables, which are small.
MIN_DF = {"term": 5, "hashtag": 2, "mention": 2, "user": 2, "loc": 2}
NEGATIVE_SHARE = {"train": 0.5, "valid": 0.75}
TOP_K = 100
NUM_TOP = 50
NUM_FOLDS = 5
# Tokens that are joined by broadcast in the long form; small, so that the test
# tables go both ways.
HEAVY = 50
MONTHS = ("1994-11", "1995-02")

posts = testdata.posts
raw_posts = testdata.raw_posts


def cleaned(spark, sf_dir):
    return clean_posts(posts(spark, sf_dir))


def staged_posts(spark, sf_dir):
    """Cleaned posts, written once for queries that read them more than once."""
    return stage(cleaned(spark, sf_dir), "cleaned_posts")


def tags(spark, sf_dir):
    return topic_tags(testdata.topic_hashtags(posts(spark, sf_dir)), "t1")


# --- sources and sinks ------------------------------------------------------


def json_decode(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events")
    return events.select("event_id", parsing.decode("props", "k bigint").alias("p")).select(
        "event_id", F.col("p.k").alias("k")
    )


def scan_parquet(spark, sf_dir):
    docs = testdata.table(spark, sf_dir, "documents")
    return docs.groupBy("lang", "source").agg(
        F.count("*").alias("doc_count"), F.sum("n_chars").alias("char_count")
    )


def typed_posts(spark, sf_dir):
    loose = posts(spark, sf_dir).withColumns(
        {
            "create_time": F.col("create_time").cast("bigint"),
            "from_id": F.col("from_id").cast("bigint"),
            "tweet_id": F.col("tweet_id").cast("bigint"),
        }
    )
    return parsing.typed_posts(loose)


def topic_hashtags(spark, sf_dir):
    return testdata.topic_hashtags(posts(spark, sf_dir))


def stage_roundtrip(spark, sf_dir):
    written = stage(cleaned(spark, sf_dir), "cleaned_posts")
    return written.select("tweet_id", "create_time", "location", "hashtag")


def monthly_counts(spark, sf_dir):
    path = stage_path(spark, "posts_by_month")
    sinks.write_monthly(posts(spark, sf_dir), path)
    by_month = spark.read.parquet(path)
    return by_month.groupBy(F.col("year_month").cast("string").alias("year_month")).agg(
        F.count("*").alias("post_count")
    )


def json_rescan(spark, sf_dir):
    """Posts written as JSON lines and scanned again."""
    path = stage_path(spark, "posts_json")
    sinks.write_json(posts(spark, sf_dir), path)
    return read_posts_json(spark, path)


def _month_layout(spark, sf_dir):
    path = stage_path(spark, "dated_posts")
    sinks.write_monthly(testdata.dated_posts(spark, sf_dir), path)
    return path


def month_volume(spark, sf_dir):
    """Posts per year and month, from the folders of the layout."""
    return sinks.month_volume(sinks.read_months(spark, _month_layout(spark, sf_dir)))


def month_range(spark, sf_dir):
    """The posts of four months across a year's end; the other folders are not read."""
    months = sinks.read_months(spark, _month_layout(spark, sf_dir), *MONTHS)
    return months.select("tweet_id", "create_time", "year_month")


def months_rewritten(spark, sf_dir):
    """The layout after four months were cleaned of posts by every third user."""
    path = _month_layout(spark, sf_dir)
    months = sinks.read_months(spark, path, *MONTHS).where(F.col("from_id").cast("long") % 3 != 0)
    sinks.rewrite_months(stage(months.drop("year_month"), "cleaned_months"), path)
    return sinks.read_months(spark, path).groupBy("year_month").agg(
        F.count("*").alias("post_count"), F.count_distinct("from_id").alias("user_count")
    )


def _raw_folders(spark, sf_dir):
    """Raw lines as gzip files in folders two levels deep, by the post's id."""
    post = F.regexp_extract("value", '"id":"?([0-9]+)', 1).cast("long")
    lines = raw_posts(spark, sf_dir).withColumns({"part": F.pmod(post, F.lit(2)), "day": F.pmod(post, F.lit(5))})
    path = stage_path(spark, "raw_folders")
    writer = lines.repartition("part", "day").write.option("compression", "gzip")
    writer.partitionBy("part", "day").text(path)
    return path


def gzip_intake(spark, sf_dir):
    """Gzip files under globs and a comma list to posts, counted by source folder."""
    path = _raw_folders(spark, sf_dir)
    lines = read_raw_lines(spark, f"{path}/part=0/day=[0-2],{path}/part=1/*", with_files=True)
    dealt = spread(lines, expansion=GZIP_EXPANSION)
    posted = (quarantine.rejection_of(dealt, min_length=0)).withColumn("folder", folder_of(F.col("file_path")))
    place = [F.regexp_extract("folder", f"{name}=([0-9]+)", 1).cast("int").alias(name) for name in ("part", "day")]
    return posted.groupBy(*place).agg(
        F.count("*").alias("line_count"), F.count(F.when(F.col("reason") == quarantine.ACCEPTED, 1)).alias("post_count")
    )


# --- parsing ------------------------------------------------------------------


def filter_min_length(spark, sf_dir):
    docs = testdata.table(spark, sf_dir, "documents")
    return parsing.long_lines(docs, column="text").select("doc_id", F.length("text").alias("line_length"))


def filter_min_keys(spark, sf_dir):
    kept = parsing.objects_with_keys(raw_posts(spark, sf_dir))
    return kept.select(
        F.get_json_object("value", "$.id").alias("tweet_id"),
        F.size(parsing.json_keys(F.col("value"))).alias("key_count"),
    )


def filter_lang(spark, sf_dir):
    kept = parsing.in_language(raw_posts(spark, sf_dir))
    return kept.select(F.get_json_object("value", "$.id").alias("tweet_id"))


def flatten_post(spark, sf_dir):
    return parsing.parse_posts(raw_posts(spark, sf_dir), min_length=0)


def rejected_lines(spark, sf_dir):
    return parsing.rejected_lines(raw_posts(spark, sf_dir), min_length=0)


_ID = '"id":"?([0-9]+)'


def _by_line(spark, path):
    """`(tweet_id, reason)` of every line of an ingest, accepted ones included."""
    taken = quarantine.accepted_posts(spark, path).select("tweet_id", F.lit(quarantine.ACCEPTED).alias("reason"))
    left = quarantine.rejected_lines(spark, path).select(F.regexp_extract("value", _ID, 1).alias("tweet_id"), "reason")
    return taken.unionByName(left)


def quarantined_lines(spark, sf_dir):
    path = stage_path(spark, "ingest")
    quarantine.ingest(raw_posts(spark, sf_dir), path, min_length=0)
    return _by_line(spark, path)


def reingested_lines(spark, sf_dir):
    """Malformed lines after those that only lack their last brace got it back."""
    path, mended = stage_path(spark, "ingest"), stage_path(spark, "ingest_mended")
    quarantine.ingest(raw_posts(spark, sf_dir), path, min_length=0)
    quarantine.reingest(spark, path, mended, parsing.close_object, min_length=0)
    return _by_line(spark, mended)


def parse_created_at(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events")
    stamp = F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy")
    return events.select("event_id", created_at_seconds(stamp).alias("create_time"))


def lang_filter(spark, sf_dir):
    docs = spread(testdata.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    model = LanguageFilter.train(docs, "text", "lang")
    return model.keep(docs, "en", "text").select("doc_id", "lang")


def lang_confusion(spark, sf_dir):
    """What the language filter says of documents it was not trained on."""
    docs = spread(testdata.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    seen, unseen = held_out_split(docs, "doc_id")
    return LanguageFilter.train(seen, "text", "lang").confusion(unseen, "text", "lang")


# --- cleaning and tokens ---------------------------------------------------------


def project_posts(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "create_time", "from_id", "from_user", "tweet_id", "location", "hashtag", "mention"
    )


def clean_location_(spark, sf_dir):
    return posts(spark, sf_dir).select("tweet_id", clean_location("location").alias("location"))


def clean_hashtag_(spark, sf_dir):
    return posts(spark, sf_dir).select("tweet_id", clean_hashtag("hashtag").alias("hashtag"))


def clean_mention_(spark, sf_dir):
    return posts(spark, sf_dir).select("tweet_id", clean_mention("mention").alias("mention"))


def clean_term_(spark, sf_dir):
    return posts(spark, sf_dir).select("tweet_id", clean_term("term", "mention", "hashtag").alias("term"))


def strip_urls_(spark, sf_dir):
    return posts(spark, sf_dir).select("tweet_id", strip_urls("term").alias("term"))


def tokenize(spark, sf_dir):
    docs = spread(testdata.table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = docs.select("doc_id", tokens("text").alias("words"))
    return words.select("doc_id", F.size("words").alias("word_count"), F.array_join("words", "|").alias("words"))


def stopwords_removed(spark, sf_dir):
    words = cleaned(spark, sf_dir).select("tweet_id", without_stop_words(tokens("term")).alias("words"))
    return words.select("tweet_id", F.size("words").alias("word_count"), F.array_join("words", "|").alias("words"))


# --- labels --------------------------------------------------------------------


def explode_hashtags(spark, sf_dir):
    return labelling.explode_hashtags(cleaned(spark, sf_dir))


def topic_semi_join(spark, sf_dir):
    return labelling.topical_ids(labelling.explode_hashtags(cleaned(spark, sf_dir)), tags(spark, sf_dir))


def _labelled(spark, sf_dir, unique_ids=False):
    return flow.labelled_posts(posts(spark, sf_dir), tags(spark, sf_dir), unique_ids)


def label_topic(spark, sf_dir):
    return _labelled(spark, sf_dir).select("tweet_id", "create_time", "hashtag", "label")


def label_topic_by_row(spark, sf_dir):
    return _labelled(spark, sf_dir, unique_ids=True).select("tweet_id", "create_time", "hashtag", "label")


def labelled_hashtags(spark, sf_dir):
    table = stage(_labelled(spark, sf_dir).select("tweet_id", "create_time", "hashtag", "label"), "labelled_hashtags")
    topical = table.where(F.col("label") == 1.0)
    exploded = labelling.restrict_to_labelled(labelling.explode_hashtags(table), topical)
    return exploded.groupBy("each_hashtag").agg(F.count("*").alias("use_count"))


# --- split -----------------------------------------------------------------------


def hashtag_birthdays(spark, sf_dir):
    exploded = labelling.explode_hashtags(cleaned(spark, sf_dir))
    return splitting.hashtag_birthdays(exploded, tags(spark, sf_dir))


def split_hashtags(spark, sf_dir):
    return splitting.split_hashtags(hashtag_birthdays(spark, sf_dir))


def split_cutoffs(spark, sf_dir):
    return splitting.split_cutoffs(split_hashtags(spark, sf_dir))


def _split_tables(spark, sf_dir):
    """Labelled posts with their split, and the ranked hashtags.

    A narrow table without the text, and the topic's few hashtags, are written
    once; all later steps read these instead of the posts.
    """
    narrow = cleaned(spark, sf_dir).select("tweet_id", "create_time", "hashtag")
    fact = stage(narrow, "post_hashtags")
    topic = stage(tags(spark, sf_dir), "topic_tags")
    exploded = labelling.explode_hashtags(fact)
    ranked = stage(splitting.split_hashtags(splitting.hashtag_birthdays(exploded, topic)), "hashtag_periods")
    labelled = labelling.label_posts(fact, labelling.topical_ids(exploded, topic))
    return splitting.assign_split(labelled, splitting.split_cutoffs(ranked)), ranked


def temporal_split(spark, sf_dir):
    return _split_tables(spark, sf_dir)[0].select("tweet_id", "create_time", "split")


def split_counts(spark, sf_dir):
    return _split_tables(spark, sf_dir)[0].groupBy("split").agg(F.count("*").alias("row_count"))


def leakage_anti_join(spark, sf_dir):
    kept = splitting.drop_leaking(*_split_tables(spark, sf_dir))
    return kept.select("tweet_id", "split", "label")


def leakage_by_row(spark, sf_dir):
    kept = splitting.drop_leaking_by_row(*_split_tables(spark, sf_dir))
    return kept.select("tweet_id", "split", "label")


def positive_counts(spark, sf_dir):
    """The flagship: posts to counted, leakage-free splits."""
    return splitting.split_counts(splitting.drop_leaking(*_split_tables(spark, sf_dir)))


def dedup_content(spark, sf_dir):
    content = ["term", "hashtag", "mention", "from_user"]
    return splitting.drop_duplicate_content(cleaned(spark, sf_dir), content, keep=["tweet_id", "from_user"])


def dedup_vectors(spark, sf_dir):
    """The same on count vectors of the four blocks."""
    table = staged_posts(spark, sf_dir)
    vectors = feats.feature_model(table, MIN_DF, blocks=C.DEDUP_BLOCKS, assemble=False).transform(table)
    compared = [f"{b}_features" for b in C.DEDUP_BLOCKS]
    vectors = vectors.select("tweet_id", *[bare(c) for c in compared])
    return splitting.drop_duplicate_content(vectors, compared, keep=["tweet_id"])


def union_typed(spark, sf_dir):
    kept = splitting.drop_leaking(*_split_tables(spark, sf_dir))
    parts = {s: kept.where(F.col("split") == s).select("tweet_id", "label") for s in ("train", "valid")}
    return splitting.tag_and_union(parts)


def _several_topics(spark, sf_dir):
    """The narrow fact table, the dictionary, and its periods, each written once."""
    fact = stage(cleaned(spark, sf_dir).select("tweet_id", "create_time", "hashtag"), "post_hashtags")
    names = stage(testdata.several_topics(fact), "topic_names")
    periods = stage(topics.topic_periods(topics.topic_birthdays(fact, names)), "topic_periods")
    return fact, names, periods


def topics_periods(spark, sf_dir):
    return _several_topics(spark, sf_dir)[2]


def topics_cutoffs(spark, sf_dir):
    return topics.topic_cutoffs(_several_topics(spark, sf_dir)[2])


def topics_split(spark, sf_dir):
    """Labels and leakage-free splits of all topics, from one pass over the posts."""
    return topics.split_all_topics(*_several_topics(spark, sf_dir)).select("topic", "tweet_id", "label", "split")


def hashtags_bucketed(spark, sf_dir):
    """Hashtags of labelled posts: posts and labels meet bucket by bucket."""
    fact = write_bucketed(cleaned(spark, sf_dir).select("tweet_id", "create_time", "hashtag"), "post_hashtags", "tweet_id")
    exploded = labelling.explode_hashtags(fact)
    topical = write_bucketed(labelling.topical_ids(exploded, tags(spark, sf_dir)), "topical_ids", "tweet_id")
    used = labelling.restrict_to_labelled(exploded, topical)
    return used.groupBy("each_hashtag").agg(F.count("*").alias("use_count"))


def leakage_bucketed(spark, sf_dir):
    """The guard on a table in buckets of id and split: nothing is exchanged."""
    split, ranked = _split_tables(spark, sf_dir)
    table = write_bucketed(split, "split_posts", "tweet_id", "split")
    return splitting.drop_leaking(table, ranked).select("tweet_id", "split", "label")


# --- samples -----------------------------------------------------------------------


def stratified_sample(spark, sf_dir):
    table = label_topic(spark, sf_dir).select("tweet_id", "label")
    return sampling.stratified_sample(table, {0.0: 0.1, 1.0: 1.0})


def cv_folds(spark, sf_dir):
    return sampling.with_folds(posts(spark, sf_dir).select("tweet_id"), NUM_FOLDS)


# --- features ------------------------------------------------------------------------


def _vocabulary(block):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = feats.fit_vocabularies(cleaned(spark, sf_dir), MIN_DF, blocks=[block])
        return found.select("token", "df", "tf", "idx")

    return query


def feature_names(spark, sf_dir):
    return feats.feature_names(feats.fit_vocabularies(cleaned(spark, sf_dir), MIN_DF))


def count_vectors(spark, sf_dir):
    table = staged_posts(spark, sf_dir)
    model = feats.feature_model(table, MIN_DF, blocks=["term"], assemble=False)
    return feats.long_counts(model.transform(table), "term_features")


def assemble_vectors(spark, sf_dir):
    table = staged_posts(spark, sf_dir)
    model = feats.feature_model(table, MIN_DF)
    long = feats.long_counts(model.transform(table), "features")
    return long.withColumnRenamed("idx", "global_idx")


def _block_summaries(vectors):
    blocks = []
    for block in feats.BLOCKS:
        entries = feats.vector_entries(F.col(f"{block}_features"))
        total = F.aggregate(entries, F.lit(0.0), lambda acc, e: acc + e["value"])
        blocks.append(
            vectors.select("tweet_id", F.size(entries).alias(f"{block}_nnz"), total.alias(f"{block}_total"))
        )
    return blocks


def _block_vectors(spark, sf_dir):
    table = staged_posts(spark, sf_dir)
    vectors = feats.feature_model(table, MIN_DF, assemble=False).transform(table)
    return vectors.select("tweet_id", *[bare(f"{b}_features") for b in feats.BLOCKS])


def join_feature_blocks(spark, sf_dir):
    return feats.join_blocks(_block_summaries(stage(_block_vectors(spark, sf_dir), "feature_blocks")))


def blocks_bucketed(spark, sf_dir):
    """The five blocks as bucketed tables: four joins, nothing exchanged."""
    vectors = stage(_block_vectors(spark, sf_dir), "feature_blocks")
    tables = [write_bucketed(b, f"block{i}", "tweet_id") for i, b in enumerate(_block_summaries(vectors))]
    return feats.join_blocks(tables)


def long_counts(spark, sf_dir):
    """Counts of the term block from a vocabulary that stays a table."""
    table = staged_posts(spark, sf_dir)
    vocabulary = stage(feats.fit_vocabularies(table, MIN_DF, blocks=["term"]), "vocabulary")
    return longform.encode(table, vocabulary, ["term"], heavy=HEAVY).select("tweet_id", "idx", "cnt")


def long_assembled(spark, sf_dir):
    table = staged_posts(spark, sf_dir)
    vocabularies = stage(feats.fit_vocabularies(table, MIN_DF), "vocabulary")
    return longform.assemble(longform.encode(table, vocabularies, heavy=HEAVY), vocabularies)


def vocab_cut(spark, sf_dir):
    """What vocabularies of 100 tokens a block leave out."""
    return longform.cut_tokens(cleaned(spark, sf_dir), MIN_DF, vocab_size=100)


def features_with_label(spark, sf_dir):
    table = stage(cleaned(spark, sf_dir).select("tweet_id", "create_time", "hashtag"), "post_hashtags")
    model = feats.feature_model(table, MIN_DF, blocks=["hashtag"], assemble=False)
    topic = tags(spark, sf_dir)
    labels = labelling.label_posts(table, labelling.topical_ids(labelling.explode_hashtags(table), topic))
    joined = feats.with_labels(model.transform(table).select("tweet_id", "hashtag_features"), labels)
    return feats.long_counts(joined, "hashtag_features", "tweet_id", "label")


def labels_bucketed(spark, sf_dir):
    """Feature rows meet their labels bucket by bucket."""
    table = stage(cleaned(spark, sf_dir).select("tweet_id", "create_time", "hashtag"), "post_hashtags")
    model = feats.feature_model(table, MIN_DF, blocks=["hashtag"], assemble=False)
    ids = labelling.topical_ids(labelling.explode_hashtags(table), tags(spark, sf_dir))
    labels = write_bucketed(labelling.label_posts(table, ids).select("tweet_id", "label"), "labels", "tweet_id")
    vectors = model.transform(table).select("tweet_id", bare("hashtag_features"))
    joined = feats.with_labels(write_bucketed(vectors, "hashtag_vectors", "tweet_id"), labels)
    return feats.long_counts(joined, "hashtag_features", "tweet_id", "label")


def libsvm_roundtrip(spark, sf_dir):
    """Labelled hashtag vectors written as LibSVM text by month and read back."""
    table = stage(cleaned(spark, sf_dir).select("tweet_id", "create_time", "hashtag"), "post_hashtags")
    vocabulary = stage(feats.fit_vocabularies(table, MIN_DF, blocks=["hashtag"]), "vocabulary")
    model = feats.model_from_vocabularies(feats.collect_vocabularies(vocabulary), assemble=False)
    ids = labelling.topical_ids(labelling.explode_hashtags(table), tags(spark, sf_dir))
    vectors = model.transform(labelling.label_posts(table, ids))
    path, month = stage_path(spark, "libsvm"), year_month(F.col("create_time"))
    rows = vectors.select("label", bare("hashtag_features").alias("features"), month.alias("year_month"))
    sinks.write_libsvm(rows, path, by="year_month")
    again = sinks.read_libsvm(spark, path, model.stages[-1].getVocabSize())
    entries = again.select(F.col("year_month").cast("string").alias("year_month"), "label", F.inline(feats.vector_entries(F.col("features"))))
    return entries.groupBy("year_month", "label", "idx").agg(F.count("*").alias("row_count"), F.sum("value").alias("uses"))


def _labelled_terms(spark, sf_dir):
    table = stage(_labelled(spark, sf_dir).select("term", "label"), "labelled_terms")
    model = feats.feature_model(table, MIN_DF, blocks=["term"], assemble=False)
    return model.transform(table).select("label", bare("term_features"))


def chi_square_scores(spark, sf_dir):
    selector = learning.ChiSquareTopFeatures(featuresCol="term_features")
    scores = selector.scores(_labelled_terms(spark, sf_dir))
    return scores.select("idx", F.round("statistic", 6).alias("statistic"), "dof")


def chi_square_top_n(spark, sf_dir):
    """What the selector keeps by default, with its scores."""
    selector = learning.ChiSquareTopFeatures(numTopFeatures=NUM_TOP, featuresCol="term_features")
    best = selector.best(_labelled_terms(spark, sf_dir), NUM_TOP)
    return best.select("idx", F.round("statistic", 6).alias("statistic"), "dof")


# --- ranking ------------------------------------------------------------------------


def _scored_documents(spark, sf_dir):
    docs = testdata.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = testdata.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("score"), F.col("toxic").cast("double").alias("label")
    )


def top_k(spark, sf_dir):
    return ranking.top_k(_scored_documents(spark, sf_dir), TOP_K, id_col="doc_id")


def average_precision(spark, sf_dir):
    found = ranking.average_precision(_scored_documents(spark, sf_dir))
    return found.select(F.round("average_precision", 9).alias("average_precision"))


def precision_at_k(spark, sf_dir):
    found = ranking.precision_at_k(_scored_documents(spark, sf_dir), TOP_K, id_col="doc_id")
    return found.select(F.round("precision_at_k", 9).alias("precision_at_k"))


def recall_at_k(spark, sf_dir):
    found = ranking.recall_at_k(_scored_documents(spark, sf_dir), TOP_K, id_col="doc_id")
    return found.select(F.round("recall_at_k", 9).alias("recall_at_k"))


# --- learning -------------------------------------------------------------------------


def _cleaned_once(spark, sf_dir, path=None):
    """Cleaned posts and the topic's hashtags. Posts are built and cleaned in one pass;
    the hashtags as they were before cleaning, which name the topic, are kept beside."""
    built = posts(spark, sf_dir).withColumn("raw_hashtag", F.col("hashtag"))
    written = stage(clean_posts(built), "cleaned_posts", path)
    uncleaned = written.select("tweet_id", F.col("raw_hashtag").alias("hashtag"))
    topic = stage(topic_tags(testdata.topic_hashtags(uncleaned), "t1"), "topic_tags")
    return written.drop("raw_hashtag"), topic


def _tables(table, topic):
    return flow.feature_tables(
        table,
        topic,
        min_df=MIN_DF,
        train_fractions={0.0: NEGATIVE_SHARE["train"], 1.0: 1.0},
        valid_fractions={0.0: NEGATIVE_SHARE["valid"], 1.0: 1.0},
        are_clean=True,
    )


def _scored_test(spark, sf_dir):
    tables = _tables(*_cleaned_once(spark, sf_dir))
    selector = learning.ChiSquareTopFeatures(numTopFeatures=200)
    slicer = selector.fit(tables.combined)
    classifier = LogisticRegression(featuresCol="selected", regParam=0.1, maxIter=20)
    model = classifier.fit(slicer.transform(tables.combined))
    scored = model.transform(slicer.transform(tables.test))
    return learning.score_rows(scored, "tweet_id", "label", "prediction")


def train_score(spark, sf_dir):
    """What SQL can know of a trained model's scores: exactly the test rows after
    guard and dedup with their labels, scores within [0, 1]."""
    scored = _scored_test(spark, sf_dir)
    follows = (F.col("prediction") == 1.0) == (F.col("score") > 0.5)
    return scored.select("tweet_id", "label", F.col("score").between(0.0, 1.0).alias("is_share"), follows.alias("follows"))


def saved_model_scores(spark, sf_dir):
    """Texts scored by a chain of JVM and Python stages, before it was saved and
    after it was loaded in another session."""
    model, texts, scores = (stage_path(spark, name) for name in ("model", "cleaned_posts", "scores_again"))
    table, topic = _cleaned_once(spark, sf_dir, texts)
    tables = _tables(table, topic)
    slicer = learning.ChiSquareTopFeatures(numTopFeatures=200).fit(tables.combined)
    classifier = LogisticRegression(featuresCol="selected", regParam=0.1, maxIter=20).fit(slicer.transform(tables.combined))
    whole = learning.save_chain(model, tables.model, slicer, classifier)
    before = learning.score_rows(whole.transform(table), "tweet_id")
    fresh = spark.newSession()
    again = learning.load_chain(model).transform(fresh.read.parquet(texts))
    stage(learning.score_rows(again, "tweet_id").withColumnRenamed("score", "_score"), "", scores)
    joined = before.join(spark.read.parquet(scores), "tweet_id")
    return joined.select("tweet_id", (F.col("score") == F.col("_score")).alias("same_score"))


def _ranked_documents(spark, sf_dir):
    """A model's place is taken by a score that SQL can repeat: the length."""
    scored = _scored_documents(spark, sf_dir).withColumns(
        {"tweet_id": F.col("doc_id").cast("string"), "prediction": (F.col("score") > 2000).cast("double")}
    )
    return ranking.rank_predictions(scored, id_col="doc_id")


def rank_predictions(spark, sf_dir):
    """The ranking with its places, numbered by the metrics' running totals."""
    ranked = _ranked_documents(spark, sf_dir)
    totals = ranking.threshold_totals(ranked).select("score", F.col("running_n").alias("last_place"), "n")
    return ranked.join(totals, "score").select("doc_id", "score", "label", "last_place", F.col("n").alias("tied"))


def predictions_with_text(spark, sf_dir):
    texts = testdata.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("tweet_id"), F.col("text").alias("term"), F.col("lang").alias("hashtag"),
        F.col("source").alias("from_user"),
    )
    return learning.readable_predictions(_ranked_documents(spark, sf_dir), texts)


def cv_summary(spark, sf_dir):
    """Mean metric per setting and the best one, over a table of metrics derived
    from the labels: a setting per source of the labelled documents."""
    docs = testdata.table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = testdata.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    place = F.dense_rank().over(Window.orderBy("source")) - 1
    fold = F.pmod(F.col("doc_id"), F.lit(NUM_FOLDS)).cast("int")
    cells = docs.join(labels, "doc_id").groupBy("source", fold.alias("fold")).agg(F.avg("quality").alias("metric"))
    metrics = cells.select(place.cast("int").alias("param_id"), F.col("source").alias("params"), "fold", "metric")
    summary = learning.summarise(metrics)
    best = learning.best_params(summary).scalar()
    return summary.select(
        "param_id", "params", F.round("avg_metric", 9).alias("avg_metric"), "folds", (F.col("param_id") == best).alias("is_best")
    )


def tuning_report(spark, sf_dir):
    """Which models a tuning run measures: each setting on each fold."""
    combined = _tables(*_cleaned_once(spark, sf_dir)).combined
    _, tuner = flow.tune(combined, [20, 100], [0.1, 1.0], [5], num_folds=2)
    found = tuner.metrics_table(spark)
    return found.select("param_id", "params", "fold", F.col("metric").between(0.0, 1.0).alias("is_share"))


QUERIES = {
    "json_decode": json_decode,
    "scan_parquet": scan_parquet,
    "typed_posts": typed_posts,
    "topic_hashtags": topic_hashtags,
    "stage_roundtrip": stage_roundtrip,
    "monthly_counts": monthly_counts,
    "filter_min_length": filter_min_length,
    "filter_min_keys": filter_min_keys,
    "filter_lang": filter_lang,
    "flatten_post": flatten_post,
    "rejected_lines": rejected_lines,
    "parse_created_at": parse_created_at,
    "lang_filter": lang_filter,
    "project_posts": project_posts,
    "clean_location": clean_location_,
    "clean_hashtag": clean_hashtag_,
    "clean_mention": clean_mention_,
    "clean_term": clean_term_,
    "strip_urls": strip_urls_,
    "tokenize": tokenize,
    "stopwords_removed": stopwords_removed,
    "explode_hashtags": explode_hashtags,
    "topic_semi_join": topic_semi_join,
    "label_topic": label_topic,
    "label_topic_by_row": label_topic_by_row,
    "labelled_hashtags": labelled_hashtags,
    "hashtag_birthdays": hashtag_birthdays,
    "split_hashtags": split_hashtags,
    "split_cutoffs": split_cutoffs,
    "temporal_split": temporal_split,
    "split_counts": split_counts,
    "leakage_anti_join": leakage_anti_join,
    "leakage_by_row": leakage_by_row,
    "positive_counts": positive_counts,
    "dedup_content": dedup_content,
    "dedup_vectors": dedup_vectors,
    "union_typed": union_typed,
    "stratified_sample": stratified_sample,
    "cv_folds": cv_folds,
    "vocab_term": _vocabulary("term"),
    "vocab_hashtag": _vocabulary("hashtag"),
    "vocab_mention": _vocabulary("mention"),
    "vocab_user": _vocabulary("user"),
    "vocab_location": _vocabulary("loc"),
    "feature_names": feature_names,
    "count_vectors": count_vectors,
    "assemble_vectors": assemble_vectors,
    "join_feature_blocks": join_feature_blocks,
    "features_with_label": features_with_label,
    "chi_square_scores": chi_square_scores,
    "chi_square_top_n": chi_square_top_n,
    "top_k": top_k,
    "average_precision": average_precision,
    "precision_at_k": precision_at_k,
    "recall_at_k": recall_at_k,
    "train_score": train_score,
    "rank_predictions": rank_predictions,
    "predictions_with_text": predictions_with_text,
    "cv_summary": cv_summary,
    "tuning_report": tuning_report,
    "month_volume": month_volume,
    "month_range": month_range,
    "months_rewritten": months_rewritten,
    "gzip_intake": gzip_intake,
    "quarantined_lines": quarantined_lines,
    "reingested_lines": reingested_lines,
    "lang_confusion": lang_confusion,
    "topics_periods": topics_periods,
    "topics_cutoffs": topics_cutoffs,
    "topics_split": topics_split,
    "leakage_bucketed": leakage_bucketed,
    "blocks_bucketed": blocks_bucketed,
    "long_counts": long_counts,
    "long_assembled": long_assembled,
    "vocab_cut": vocab_cut,
    "labels_bucketed": labels_bucketed,
    "libsvm_roundtrip": libsvm_roundtrip,
    "saved_model_scores": saved_model_scores,
    "json_rescan": json_rescan,
    "hashtags_bucketed": hashtags_bucketed,
}
