import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SMALL = os.environ.get("TIDEGRAPH_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidegraph.session import local_session

    s = local_session(4, 4)
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture()
def docs(spark):
    """rows -> a documents-like table with an extra column whose name clashes with the operators' own."""
    from pyspark.sql import functions as F

    def make(rows, kind="doc_id long, text string, source string"):
        return spark.createDataFrame(rows, kind).withColumn("component_id", F.lit("mine")).withColumn("size", F.lit(-1)).withColumn("score", F.lit("x"))

    return make
