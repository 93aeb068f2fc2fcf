import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="strata-tests",
                    extra={"spark.default.parallelism": "4",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-wh-")})
    yield s
    s.stop()


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def one_col(spark, values, expr, dtype="string"):
    """Evaluate a column expression over a one-column frame of ``values`` (in order)."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]
