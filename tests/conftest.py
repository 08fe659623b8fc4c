import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from strata.session import RECOMMENDED_CONF

    builder = (SparkSession.builder.master("local[4]").appName("strata-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("ckpt"))))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
