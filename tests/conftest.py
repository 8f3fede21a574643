import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from newsloom.session import build_session, checkpoint_dir
    s = build_session("local[4]", 8)
    checkpoint_dir(s)
    yield s
    s.stop()


def one(spark, expr_fn, values, schema="v string"):
    """Evaluate a Column function over a list of single values; returns results in input order."""
    from pyspark.sql import functions as F
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, " + schema)
    return [r["o"] for r in df.select("i", expr_fn(F.col("v")).alias("o")).orderBy("i").collect()]
