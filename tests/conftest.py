import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weirwatch.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle=4)
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="weirwatch-test-")


@pytest.fixture()
def one(spark):
    """Evaluate a Column function on text values."""
    from pyspark.sql import functions as F

    def run(fn, *values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i INT, v STRING")
        return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
