"""Lifetime of stages and bucketed tables."""

from pathlib import Path

import pytest

from topicmill import session
from topicmill.session import Stages, purge_stages, stage, stage_path
from topicmill.sources import write_bucketed


def folders(spark):
    root = Path(session.app_dir(spark).replace("file:", ""))
    return {p.name for p in root.iterdir()} if root.exists() else set()


def test_stages_end_with_their_block(spark):
    before = folders(spark)
    with Stages(spark):
        assert stage(spark.range(4), "numbers").count() == 4
        assert write_bucketed(spark.range(4), "ids", "id", buckets=2).count() == 4
        assert len(folders(spark) - before) == 2
        tables = {t.name for t in spark.catalog.listTables()}
        assert any(t.startswith("topicmill_ids") for t in tables)
    assert folders(spark) == before
    assert not any(t.name.startswith("topicmill_ids") for t in spark.catalog.listTables())


def test_stages_end_after_an_error(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), Stages(spark):
        stage(spark.range(4), "numbers")
        raise ZeroDivisionError
    assert folders(spark) == before


def test_kept_stages_go_to_the_outer_block(spark):
    before = folders(spark)
    with Stages(spark):
        with Stages(spark) as inner:
            path = inner.keep(stage_path(spark, "kept"))
            table = stage(spark.range(3), "", path)
            stage(spark.range(5), "dropped")
        assert len(folders(spark) - before) == 1 and table.count() == 3
    assert folders(spark) == before
    with Stages(spark) as only:
        path = only.keep(stage_path(spark, "kept"))
        stage(spark.range(3), "", path)
    assert spark.read.parquet(path).count() == 3
    session.delete_path(spark, path)
    assert folders(spark) == before


def test_a_query_leaves_nothing(spark):
    from topicmill.plans.queries import QUERIES

    before = folders(spark)
    for name in ("temporal_split", "blocks_bucketed", "average_precision"):
        with Stages(spark):
            assert QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        assert folders(spark) == before


def test_purge(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    stage(spark.range(3), "numbers")
    assert list((tmp_path / "shared").glob("topicmill/*/numbers-*"))
    purge_stages(spark)
    assert not list((tmp_path / "shared").glob("topicmill/*"))
