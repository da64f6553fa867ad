import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidemark.workspace import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        os.environ.get("TEST_MASTER", "local[8]"),
        spark__sql__shuffle__partitions=4,
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def base(spark):
    return scratch_path(spark, "test")


@pytest.fixture
def put(base):
    """Write a text file below ``base``; the checkpoint folder is local in tests."""

    def write(name: str, text: str, encoding: str = "utf-8") -> str:
        path = os.path.join(base.removeprefix("file:"), name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding=encoding, newline="") as file:
            file.write(text)
        return path

    return write
