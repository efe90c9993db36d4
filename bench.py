"""Headline queries, one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from topicmill.operators.language import LanguageFilter
from topicmill.plans.queries import QUERIES
from topicmill.session import Stages, build_session, stage
from topicmill.sources import spread

HEADLINE = [
    "flatten_post",
    "lang_filter",
    "clean_term",
    "stopwords_removed",
    "explode_hashtags",
    "label_topic",
    "positive_counts",
    "dedup_content",
    "stratified_sample",
    "vocab_term",
    "feature_names",
    "count_vectors",
    "assemble_vectors",
    "long_assembled",
    "join_feature_blocks",
    "blocks_bucketed",
    "topics_split",
    "quarantined_lines",
    "months_rewritten",
    "chi_square_scores",
    "average_precision",
    "train_score",
]


def language_filter(spark, sf_dir: str) -> dict:
    """Training and scoring apart, in kept posts per second: on whole documents,
    and on texts of the length of a post."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = stage(spread(docs), "bench_documents")
    start = time.perf_counter()
    model = LanguageFilter.train(docs, "text", "lang")
    found = {"lang_train_sec": round(time.perf_counter() - start, 3)}
    pieces = F.explode(F.regexp_extract_all("text", F.lit(r"(?s).{1,140}"), 0))
    posts = stage(docs.select("doc_id", pieces.alias("text")), "bench_posts")
    for name, table in (("documents", docs), ("post_length", posts)):
        start = time.perf_counter()
        kept = model.keep(table, "en", "text").count()
        found[f"lang_kept_per_sec_{name}"] = round(kept / (time.perf_counter() - start), 1)
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "topicmill-bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="20g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Start-up and code generation are not what is measured.
    QUERIES["clean_term"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        with Stages(spark):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    if "lang_filter" in seconds:
        result |= language_filter(spark, sf_dir)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
