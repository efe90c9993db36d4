"""The manifest against a plain one, with ranges and blocks of more than one level."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from topicmill.llm import merkle

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Root, and for each leaf the siblings before and after it on every level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        runs = [level[i : i + 16] for i in range(0, len(level), 16)]
        for k, place in enumerate(at):
            run, inside = runs[place // 16], place % 16
            paths[k].append(("".join(run[:inside]), "".join(run[inside + 1 :])))
            at[k] = place // 16
        level = [sha("".join(run)) for run in runs]
    return level[0], paths


def expected(rows):
    if not rows:
        return []
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    low = {}
    for source in order:
        group = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        low[source] = (group, *tree([leaf_of(r) for r in group]))
    root, top = tree([low[s][1] for s in order])
    found = []
    for source, above in zip(order, top):
        group, subroot, paths = low[source]
        for row, path in zip(group, paths):
            path = path + above
            leaf = leaf_of(row)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf_of((*row[:4], row[4] and row[4].translate(UPPER))) if hit else leaf
            for before, after in path:
                folded = sha(before + folded + after)
            found.append((row[0], leaf, subroot, root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(found, key=repr)


def manifest(docs):
    leaves = docs.select("doc_id", "source", merkle.leaf_digest().alias("leaf"), merkle.tampered_leaf().alias("claimed"))
    found = merkle.verify(merkle.manifest(leaves))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof"), "folded_root", "verified")


def rows_of(sizes):
    return [
        (1000 * k + 7 * i % 997, source, None if i % 11 == 0 else "en", i, None if i % 13 == 0 else f"Text É {i % 50} of {source}")
        for k, (source, n) in enumerate(sizes.items())
        for i in range(n)
    ]


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 16, "b": 17, None: 1},
        {"hot": 600, "é": 256, "": 257, None: 33, "z": 2},
        {f"s{i}": 1 + i % 3 for i in range(40)},
    ],
    ids=["lone", "runs", "levels", "sources"],
)
def test_manifest(spark, sizes):
    rows = rows_of(sizes)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert sorted((tuple(r) for r in manifest(docs).collect()), key=repr) == expected(rows)


def test_three_levels_of_digits(spark):
    rows = rows_of({"big": 16**3 + 5, "small": 3})
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted((tuple(r) for r in manifest(docs).collect()), key=repr) == expected(rows)


def test_repeats_nulls_and_no_rows(spark):
    rows = [(5, "a", "en", 1, "X")] * 40 + [(None, None, None, None, None)] * 3 + [(5, "a", "en", 1, "Y"), (-2, "a", "", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted((tuple(r) for r in manifest(docs).collect()), key=repr) == expected(rows)
    assert manifest(docs.limit(0)).count() == 0


def test_other_columns_pass_through(spark):
    names = ["tree", "n", "rank", "digest", "row", "_key", "_row", "_task", "node", "nodes", "top", "path", "d", "level", "_tree"]
    docs = spark.createDataFrame([(1, "a", "en", 1, "X"), (2, "a", "en", 1, "Y")], SCHEMA)
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    docs = docs.withColumn("pairs", F.create_map(F.lit("k"), F.col("doc_id")))  # a type without an order
    found = merkle.manifest(docs.withColumn("leaf", merkle.leaf_digest())).collect()
    for r in found:
        assert [r[n] for n in names if n != "path"] == [f"{n}{r.doc_id}" for n in names if n != "path"]
        assert r.pairs == {"k": r.doc_id} and len(r.path) == 1
    assert len({r.root for r in found}) == 1


def test_any_change_shows(spark):
    rows = rows_of({"a": 20, "b": 3})
    docs = spark.createDataFrame(rows, SCHEMA)
    leaves = docs.withColumn("leaf", merkle.leaf_digest())
    wrong = F.when(F.col("doc_id") == rows[3][0], merkle.leaf_digest({"n_chars": F.col("n_chars") + 1}))
    found = merkle.verify(merkle.manifest(leaves.withColumn("claimed", wrong))).collect()
    assert [r.doc_id for r in found if not r.verified] == [rows[3][0]]
