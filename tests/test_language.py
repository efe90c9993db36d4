import pandas as pd
import pytest
from conftest import plan_of

from topicmill.operators.language import (
    BUCKETS,
    STEP,
    TEXTS,
    LanguageFilter,
    trigram_buckets,
    trigram_counts,
)
from topicmill.session import stage
from topicmill.sources.testdata import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    docs = table(spark, SF, "documents")
    return LanguageFilter.train(docs, "text", "lang")


def test_detects_held_out_documents(spark, trained):
    known = table(spark, SF, "documents").select("doc_id")
    other = table(spark, "/root/testdata/sf0.01", "documents").join(known, "doc_id", "left_anti")
    found = trained.detect(other, "text").where("length(text) > 20")
    right, n = found.selectExpr("sum(int(lang = detected_lang))", "count(*)").first()
    assert n > 700 and right / n > 0.97


def test_keep_leaves_columns_and_moves_nothing(spark, trained):
    docs = stage(table(spark, SF, "documents"), "docs")
    kept = trained.keep(docs, "en", "text")
    assert kept.columns == docs.columns
    assert "Exchange" not in plan_of(kept)


def test_short_and_null_texts_get_a_language(spark, trained):
    rows = spark.createDataFrame([("",), (None,), ("ab",)], "text string")
    assert all(r.detected_lang in trained.languages for r in trained.detect(rows, "text").collect())


def test_languages_are_restricted(spark):
    docs = table(spark, SF, "documents")
    assert LanguageFilter.train(docs, "text", "lang", ["en", "de"]).languages == ["de", "en"]


def test_trigrams_do_not_cross_texts():
    buckets, owner = trigram_buckets(pd.Series(["abcd", "", "ab", "xyz"]))
    assert owner.tolist() == [0, 0, 3]
    assert buckets[0] == (97 * STEP * STEP + 98 * STEP + 99) % BUCKETS
    assert trigram_buckets(pd.Series([], dtype=object))[0].size == 0


def test_counts_are_whole(spark):
    rows = spark.createDataFrame([("en", "aaaa"), ("en", None), ("de", "ab"), ("xx", "zzz")], "lang string, text string")
    counts = {(r.lang, r.bucket): r.cnt for r in trigram_counts(rows.repartition(4), "text", "lang", ["en", "de"]).collect()}
    a = (97 * STEP * STEP + 97 * STEP + 97) % BUCKETS
    assert counts == {("en", a): 2, ("en", TEXTS): 2, ("de", TEXTS): 1}


def test_save_and_load(spark, trained, tmp_path):
    trained.save(spark, str(tmp_path / "m"))
    again = LanguageFilter.load(spark, str(tmp_path / "m"))
    rows = spark.createDataFrame([("the and of that with",)], "text string")
    assert again.detect(rows, "text").collect() == trained.detect(rows, "text").collect()
