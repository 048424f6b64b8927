import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from inkwell.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column over literal values: ``one(fn, [v1, v2], 'string')``."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        rows = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
        return [r.r for r in rows]

    return run
