"""The pipeline's stages on a small scale, each held against its own input."""

import re

import pytest

import corpus_pipeline
from topicmill.llm.common import table
from topicmill.session import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, found = table(spark, SF, "documents"), [table(spark, SF, "documents").toPandas()]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name.replace(" ", "_"))
        found.append(docs.toPandas())
    return found


def test_columns_and_order(outputs):
    assert [len(o) for o in outputs] == sorted((len(o) for o in outputs), reverse=True)
    assert all(list(o.columns) == corpus_pipeline.COLUMNS for o in outputs[1:-1])


def test_quality_keeps_good_documents(spark, outputs):
    labels = table(spark, SF, "labels").toPandas().set_index("doc_id")["quality"]
    kept = set(outputs[1].doc_id)
    good = labels[labels == 1].index
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    bad = labels[labels == 0].index
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    return frozenset([tuple(w[j : j + 5]) for j in range(len(w) - 4)] or ([tuple(w)] if w else []))


def test_one_of_each_group_stays(outputs):
    before = {d: shingles(t) for d, t in zip(outputs[1].doc_id, outputs[1].text)}
    label = {d: d for d in before}
    links = [(a, b) for a in before for b in before if a < b and before[a] and 100 * len(before[a] & before[b]) >= 75 * len(before[a] | before[b])]
    for _ in links:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert set(outputs[2].doc_id) == {d for d in label if label[d] == d}


def test_no_benchmark_window_is_left(spark, outputs):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)}))
    windows = set()
    for text in table(spark, SF, "benchmark").toPandas().text:
        w = words(text)
        windows |= {tuple(w[s : s + 10]) for s in range(max(len(w) - 9, 1))}
    hit = {
        d for d, t in zip(outputs[2].doc_id, outputs[2].text) for w in [words(t)] if any(tuple(w[s : s + n]) in windows for n in {len(x) for x in windows} for s in range(len(w) - n + 1))
    }
    assert set(outputs[3].doc_id) == set(outputs[2].doc_id) - hit


def test_personal_data_is_masked_and_nothing_else(outputs):
    before, after = outputs[3].set_index("doc_id"), outputs[4].set_index("doc_id")
    assert set(before.index) == set(after.index)
    assert not any("@mail" in t for t in after.text) and all(after.n_chars == after.text.str.len())
    clean = [d for d, t in before.text.items() if not re.search(r"[0-9@]", t)]
    assert clean and all(before.text[d] == after.text[d] for d in clean)


def test_mix_follows_its_targets(outputs):
    mixed = outputs[5]
    assert (mixed.taken > 0).all() and (mixed.taken <= 3 * mixed["size"]).all()
    for _, rows in mixed.groupby("source"):
        assert abs(rows.taken.sum() - rows.target.iloc[0]) <= 3


def test_run(spark, outputs):
    assert corpus_pipeline.run(spark, SF).count() == len(outputs[5])
