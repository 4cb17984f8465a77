from __future__ import annotations

import gzip
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citelake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        "citelake-tests",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def write_gzip():
    def write(path, text: str) -> str:
        with gzip.open(path, "wt", encoding="utf-8") as out:
            out.write(text)
        return str(path)

    return write
