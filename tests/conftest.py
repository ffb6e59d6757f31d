import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kotonoha.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "kotonoha-tests",
        master="local[4]",
        extra={
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    from kotonoha.session import ship_package

    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def tokens(spark):
    """(doc, position, word, pos) rows to a token table."""

    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, token_id int, word string, pos string")

    return build


def rows_of(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
