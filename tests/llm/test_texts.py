"""Operators on texts against brute force, with nulls, empty texts and repeats."""

import random
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from topicmill.llm import decontamination, pii, quality, set_join, substring_dedup, token_counts

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def texts():
    """Random texts, near and exact copies of them, and edge cases."""
    draw = random.Random(3)
    word = lambda: draw.choice("alpha Beta gamma délta eps zeta eta theta iota kappa lam mu nu xi omi pi".split()) + draw.choice(["", "x", "y7", "."])
    found = {}
    for i in range(60):
        found[i] = [word() for _ in range(draw.choice([3, 5, 12, 60, 130]))]
    for i in range(60, 110):
        copy = list(found[draw.randrange(60)])
        for _ in range(draw.choice([0, 0, 1, 2, 4])):
            copy[draw.randrange(len(copy))] = word()
        found[i] = copy
    for i in range(110, 130):  # a passage that many share
        found[i] = [word() for _ in range(draw.randrange(30))] + found[3 * (i % 2)] + [word() for _ in range(20)]
    rows = [(i, draw.choice([" ", "\n", "\t "]).join(w)) for i, w in found.items()]
    rows += [(200, None), (201, ""), (202, " \n "), (203, "one"), (204, "one"), (205, "periodic " * 300), (206, "z" * 50_000)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    extra = [(i, t, f"s{i % 3}") for i, t in texts] + [(0, dict(texts)[0], "s0")]  # a repeated row
    return spark.createDataFrame(extra, "doc_id long, text string, n_words string").repartition(5)


def components_of(links, ids):
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def shingles(text, k=5):
    w = space_words((text or "").translate(UPPER))
    return frozenset([tuple(w[j : j + k]) for j in range(len(w) - k + 1)] or ([tuple(w)] if w else []))


@pytest.mark.parametrize("frequent", [2, 64])
def test_set_join(monkeypatch, docs, texts, frequent):
    monkeypatch.setattr(set_join, "FREQUENT", frequent)
    sets = {i: shingles(t) for i, t in texts}
    links = [
        (a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[b]
    ]
    label = components_of(links, sets)
    found = set_join.link_components(docs.select("doc_id", "text")).collect()
    assert len(found) == len(texts) + 1
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == {(i, len(s), label[i]) for i, s in sets.items()}
    assert len(set(label.values())) < len(sets) - 20


def test_set_join_without_rows_or_ids(spark, docs):
    assert set_join.link_components(docs.limit(0).select("doc_id", "text")).count() == 0
    some = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, "a b c"), (4, "d e f"), (9, "d e f")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id) for r in set_join.link_components(some).collect()) == [
        (-1, None), (-1, None), (4, 4), (4, 4), (9, 4),
    ]
    kept = sorted((r.doc_id or -1, r.text) for r in set_join.keep_one(some.withColumn("_n", F.lit(1))).collect())
    assert kept == [(-1, "a b c"), (-1, "a b c"), (4, "a b c")]


@pytest.mark.parametrize("split_from", [2, 1000])
def test_remove_repeats(docs, texts, split_from):
    words = {i: space_words(t) for i, t in texts}
    least = {}
    for i in sorted(words):
        for a in range(len(words[i]) - 49):
            least.setdefault(tuple(words[i][a : a + 50]), i)
    expected = set()
    for i, w in words.items():
        stays = [True] * len(w)
        for a in range(len(w) - 49):
            if least[tuple(w[a : a + 50])] < i:
                stays[a : a + 50] = [False] * 50
        expected.add((i, str(len(w)), stays.count(False), " ".join(x for x, s in zip(w, stays) if s)))
    found = substring_dedup.remove_repeats(docs, split_from=split_from).collect()
    assert {(r.doc_id, str(r.n_words), r.n_removed, r.kept) for r in found} == expected and len(found) == len(texts) + 1
    assert sum(r.n_removed for r in found) > 500


def test_remove_repeats_edges(spark, docs):
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0
    long = " ".join(map(str, range(60)))
    some = spark.createDataFrame([(None, long), (1, long), (2, long), (2, long)], "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.remove_repeats(some).collect())
    assert found == [(0, 0), (1, 0), (2, 60), (2, 60)]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def test_decontaminate(spark, docs, texts):
    draw = random.Random(9)
    full = [w for w in (bench_words(t) for _, t in texts) if 30 < len(w) < 200]
    items = [(i, " ".join(draw.choice(full)[5:28])) for i in range(8)]
    items += [(8, "alpha beta"), (9, None), (10, "..."), (11, "nothing like this"), (None, "one"), (0, items[0][1])]
    expected = set()
    for i, t in texts:
        w, hit, names = bench_words(t), set(), set()
        for name, item in items:
            x = bench_words(item)
            for s in range(max(len(x) - 9, 1) if x else 0):
                win = x[s : s + 10]
                for a in range(len(w) - len(win) + 1):
                    if w[a : a + len(win)] == win:
                        hit |= set(range(a, a + len(win)))
                        names.add("" if name is None else str(name))
        expected.add((i, len(w), len(hit), len(names), ",".join(sorted(names)), bool(hit)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.decontaminate(docs, bench)
    assert found.columns[:2] == ["doc_id", "text"]
    rows = {(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r.item_ids), r.contaminated) for r in found.collect()}
    assert rows == expected and any(e[5] for e in expected)
    assert decontamination.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_decontaminate_long_items(spark):
    """Anchors more than 64 words apart, and letters that only A-Z rules leave alone."""
    draw = random.Random(4)
    item = [f"w{draw.randrange(60)}" for _ in range(200)]
    texts = [" ".join(item[a : a + n]) for a, n in ((0, 200), (3, 10), (64, 9), (130, 12), (70, 80))]
    texts += [" ".join(item[60:66] + item[124:140]), "A " + " ".join(item[150:160]).upper() + " Z", "\u0130 \u00c4B\u00c4 " + " ".join(item[20:31])]
    windows = {tuple(item[a : a + 10]) for a in range(191)}
    expected = {}
    for i, t in enumerate(texts):
        w = bench_words(t)
        hit = {p for a in range(len(w) - 9) if tuple(w[a : a + 10]) in windows for p in range(a, a + 10)}
        expected[i] = (len(w), len(hit))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_hit) for r in decontamination.decontaminate(docs, bench).collect()}
    assert found == expected and [i for i in found if found[i][1] == 0] == [2]


def test_alignments_are_met_in_numbers(spark):
    """What grows with the corpus is aggregated in numbers, not in arrays; words need no lambda."""
    docs = spark.createDataFrame([(1, 0, "a b c d")], "_k1 long, _k2 long, text string")
    anchors = spark.createDataFrame([(7, 0, 1, "b")], "item long, start int, place int, term string")
    plan = decontamination._alignments(docs, anchors)._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in plan and "collect_set" not in plan and "ObjectHashAggregate" not in plan and "lambda w" not in plan


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "cat x x dog"), (2, "dog y cat"), (3, "cat " + "x " * 30 + "dog")], "doc_id long, text string")
    keyed = docs.withColumns({"_k1": F.col("doc_id"), "_k2": F.lit(0).cast("long")})
    bench = spark.createDataFrame([(5, "cat dog")], "item_id long, text string")
    found = decontamination.proximity_matches(keyed, bench, reach=5)
    assert {r._k1 for r in found.collect()} == {1, 2}


def naive_base(text):
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii(spark):
    draw = random.Random(2)
    rows = [(i, "".join(draw.choice("a1é.@+- 2(3)45_\n") for _ in range(draw.randrange(60)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "é a@b.co, 10.0.0.1 +1 (423) 555-7379, 4111 1111 1111 1111"), (503, "@" * 1000 + "1" * 1000)]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), masked=True).collect()}
    for i, text in rows:
        base = naive_base(text)
        assert found[i].base_spans == pii.joined(base)
        assert set(filter(None, found[i].base_spans.split(","))) <= set(found[i].spans.split(","))
        assert [found[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
    assert found[500].masked is None and found[502].masked == "é <email>, <ip> <phone>, <card>"


def test_pii_model_held_out():
    model, draw = pii.trained(), random.Random(77)
    right = found = true = 0
    for _ in range(300):
        text, spans = pii._sentence(draw)
        got = model.decode(text)
        right, found, true = right + len({*got} & {*spans}), found + len(got), true + len(spans)
    assert right > 0.97 * found and right > 0.97 * true
    assert [s[0] for s in pii.all_spans("write jo (at) mail (dot) org or call (423) 555-7379", model)[1]] == ["email", "phone"]
    assert pii.all_spans("Version 4.0 of 2024-01-05, order 4652511922028857", model)[1] == []


def test_token_counts(spark):
    small = [("<unk>", 0.0), ("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("ba", -4.0), ("▁a", -3.0), ("aba", -6.0)]
    real = token_counts.Vocabulary.load()
    draw = random.Random(4)
    for vocabulary, letters in ((token_counts.Vocabulary(tuple(small), False), "abab xz"), (real, "the an 日\n😀▁x")):
        reference = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=0, byte_fallback=vocabulary.byte_fallback))
        reference.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        rows = [(i, "".join(draw.choice(letters) for _ in range(draw.randrange(25)))) for i in range(400)]
        df = spark.createDataFrame([*rows, (999, None), (998, "")], "id long, text string")
        found = {r.id: r.n_tokens for r in token_counts.with_token_counts(df, vocabulary).collect()}
        assert found.pop(999) == 0 and found.pop(998) == 0
        assert found == {i: len(reference.encode(t).ids) for i, t in rows}


def test_quality(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    assert model.held_out["good_kept"] > 0.98 and model.held_out["bad_rejected"] > 0.9
    odd = spark.createDataFrame([(1, None, None, None), (2, "", "en", "s"), (3, "the end of it", None, "s")], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in quality.score(odd, model).collect()}
    assert not found[1].keep and not found[2].keep and 0 < found[3].p_quality < 1
    assert quality.keep_good(odd, labels.limit(0)).count() == 1  # without labels all texts with words stay
    assert quality.score(odd.limit(0), model).count() == 0

