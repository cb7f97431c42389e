import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
        "spark.sql.shuffle.partitions": "4",
        # Small test tables would end up in one partition and leave nothing to stitch.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
    }
    session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def rows():
    """Rows of a frame as sorted plain tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted([tuple(r) for r in picked.collect()], key=repr)

    return collect
