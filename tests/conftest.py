from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from asterloom.scratch import scratch_path  # noqa: E402
from asterloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A fresh folder per test."""
    path = scratch_path(spark, "test")
    Path(path.removeprefix("file:")).mkdir(parents=True)
    return path


@pytest.fixture
def local(folder):
    return Path(folder.removeprefix("file:"))


def rows(df):
    """Rows as sorted tuples; sorts NULLs and mixed types too."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
