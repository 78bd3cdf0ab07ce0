import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from loomtab.session import HOT_ROWS, build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    from loomtab.sources.tables import Tables
    return Tables(spark, sf_dir)


@pytest.fixture
def hot(spark):
    """Every group above 20 rows counts as hot."""
    spark.conf.set(HOT_ROWS, "20")
    yield
    spark.conf.unset(HOT_ROWS)
