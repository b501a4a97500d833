import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import local_session

    session = local_session(8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def customers(spark):
    """500 rows, 100 positives, mixed feature kinds, built from row numbers."""
    from pyspark.sql import functions as F

    i = F.col("id")

    def pick(salt, n):
        return F.pmod(F.xxhash64(F.lit(salt), i), F.lit(n))

    return spark.range(500).select(
        i.alias("row_id"),
        (10_000 + pick(1, 490_000)).alias("credit"),
        (21 + pick(2, 58)).alias("age"),
        (1 + pick(3, 2)).alias("sex"),
        (pick(4, 11) - 2).alias("delay"),
        F.when(i % 5 == 0, 1).otherwise(0).alias("target"),
    )
