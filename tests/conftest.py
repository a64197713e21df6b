import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from panelweave.session import DEFAULT_GROUP_ROWS, GROUP_ROWS, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cpus=8)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def tiny_groups(spark):
    """Three rows per task: nearly every series takes the route for long series."""
    spark.conf.set(GROUP_ROWS, "3")
    yield 3
    spark.conf.set(GROUP_ROWS, str(DEFAULT_GROUP_ROWS))


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
