import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slatecast.plans.warehouse import TABLES, StarWarehouse  # noqa: E402
from slatecast.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", cores=8, **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    """All models of the smallest star schema, built once."""
    return StarWarehouse(spark, SF, (*TABLES, "feat_batter_game"))


@pytest.fixture
def small_groups(spark):
    """Make every group of more than a few rows take the split path."""
    spark.conf.set("slatecast.maxGroupRows", "40")
    yield
    spark.conf.unset("slatecast.maxGroupRows")


def day(text):
    return dt.date.fromisoformat(text)
