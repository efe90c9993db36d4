"""Columns of any name pass through every operator that keeps its input's columns."""

import ast
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from topicmill.llm import decontamination, line_dedup, mixing, substring_dedup, url_filter, warc

LLM = Path(decontamination.__file__).parent
TEXT = " ".join(f"word{i}" for i in range(80))


def names_in(module):
    """All strings of a module that could be a column of its own making."""
    found = {n.value for n in ast.walk(ast.parse((LLM / f"{module}.py").read_text())) if isinstance(n, ast.Constant) and isinstance(n.value, str)}
    return sorted(n for n in found if n.isidentifier() and n.isascii() and len(n) < 25)


def items(spark):
    return spark.createDataFrame([("i1", " ".join(f"word{i}" for i in range(20, 35)))], "item_id string, text string")


OPERATORS = {
    "decontamination": (lambda d: decontamination.decontaminate(d, items(d.sparkSession)), ["doc_id", "text"], ["n_words", "n_hit", "n_items", "item_ids", "contaminated"]),
    "url_filter": (url_filter.judge, ["page_id", "url", "html"], ["host", "path", "rule", "verdict", "component"]),
    "substring_dedup": (substring_dedup.remove_repeats, ["doc_id", "text"], ["n_words", "n_removed", "kept"]),
    "warc": (warc.plan_records, ["page_id", "url", "html"], ["payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]),
    "mixing": (mixing.mix, ["doc_id", "source", "text"], ["size", "source_size", "target", "whole", "taken"]),
    "line_dedup": (line_dedup.dedup_lines, ["doc_id", "text"], ["n_lines", "n_dropped", "kept"]),
}


@pytest.mark.parametrize("module", OPERATORS)
def test_columns_pass_through(spark, module):
    operator, needed, made = OPERATORS[module]
    values = {"doc_id": [1, 2, 2], "page_id": [1, 2, 2], "text": [TEXT, TEXT, None], "source": ["a", None, "a"], "url": ["http://a.net/x", None, "http://b.org/fr/"], "html": ["<p>", "<p>", None]}
    rows = [tuple(values[n][i] for n in needed) for i in range(3)]
    kinds = ", ".join(f"{n} {'long' if n.endswith('_id') else 'string'}" for n in needed)
    plain = spark.createDataFrame(rows, kinds)
    others = [n for n in names_in(module) if n.lower() not in {x.lower() for x in needed}]
    others = list({n.lower(): n for n in others}.values())
    crowded = plain.select(*[F.concat(F.lit(n), F.coalesce(F.col(needed[0]).cast("string"), F.lit(""))).alias(n) for n in others], *needed)
    found = operator(crowded)
    passed = [n for n in crowded.columns if n not in made]
    assert found.columns == [*passed, *made]
    for r in found.collect():
        for n in passed:
            if n not in needed:
                assert r[n] == f"{n}{r[needed[0]]}"
    strip = lambda df: sorted((tuple(r) for r in df.select(*needed, *made).collect()), key=repr)
    assert strip(found) == strip(operator(plain))
