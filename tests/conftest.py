import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from entitylake.session import local_session

    session = local_session("4", app="tests", memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate one expression on one text."""
    from pyspark.sql import functions as F

    def run(make, text):
        return spark.createDataFrame([(text,)], "t string").select(make(F.col("t")).alias("r")).first()["r"]

    return run


@pytest.fixture(scope="session")
def entity(spark):
    """Entities from Python objects through the JSON reader."""
    import json

    from entitylake.sources.payloads import scan_entities

    def build(*objects):
        return scan_entities(spark.createDataFrame([(json.dumps(o),) for o in objects], "raw string"))

    return build
