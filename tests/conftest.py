import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plantwatch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TZ", "UTC")
    session = local_session(4, "plantwatch-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def rows(spark):
    """DataFrame from tuples and a schema text; time columns are given as text."""
    from pyspark.sql import functions as F

    def build(data, schema):
        fields = [part.strip().split(" ", 1) for part in schema.split(",")]
        times = [n for n, kind in fields if kind == "timestamp_ntz"]
        text_schema = ", ".join(f"{n} {'string' if n in times else kind}" for n, kind in fields)
        return spark.createDataFrame(data, text_schema).withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})

    return build
