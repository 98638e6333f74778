import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from histevents.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8, app_name="histevents-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def col_values(spark, exprs, data, schema):
    """Evaluate column expressions over a small literal frame."""
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]
