import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from innkeep.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "checkpoint"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={root}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows of literals as a frame of strings (or of the given types)."""

    def make(columns, rows, types=None):
        kinds = types or ["string"] * len(columns.split())
        schema = ", ".join(f"`{c}` {k}" for c, k in zip(columns.split(), kinds))
        return spark.createDataFrame(rows, schema)

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
