"""One Spark session for all tests, and helpers to write small file trees."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from poolweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "poolweave-tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def strings(spark):
    """A DataFrame of text columns from a header and rows."""

    def make(header: str, *rows: tuple):
        fields = ", ".join(f"`{name}` string" for name in header.split())
        return spark.createDataFrame(list(rows), fields)

    return make


def write_files(folder: Path, files: dict[str, str]) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / name).write_text(content)
    return str(folder)


def rows(df, *columns: str) -> list[tuple]:
    """Rows in a comparable order, nulls included."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
