import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app_name="tests",
        master="local[8]",
        settings={
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def tiny_chunks(monkeypatch):
    """With ``rows_per_chunk=1``: every row is a chunk of its own."""
    from tidemark.operators import chunks, joins

    monkeypatch.setattr(chunks, "SAMPLES_PER_CHUNK", 1)
    monkeypatch.setattr(joins, "SAMPLES_PER_CHUNK", 1)
