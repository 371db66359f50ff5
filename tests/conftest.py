import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from chroniq.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ev(spark):
    """Evaluate a Column function on inline values, one row each."""

    def run(fn, *rows, schema="x string"):
        cells = [r if isinstance(r, tuple) else (r,) for r in rows]
        frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], f"__i int, {schema}")
        out = frame.select("__i", fn(*[frame[c] for c in frame.columns[1:]]).alias("y")).orderBy("__i").collect()
        return [r.y for r in out]

    return run


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
