import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from topicmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "topicmill-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_posts(spark):
    """Posts from short tuples (tweet_id, create_time, hashtag[, term])."""
    from topicmill.schema import POST

    def build(rows):
        full = [
            (float(time), "1", "user1", tag, "here", "", rest[0] if rest else "some text", str(id_))
            for id_, time, tag, *rest in rows
        ]
        return spark.createDataFrame(full, POST)

    return build


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
