import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from assaymill import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("ckpt"))))
    s = session.configure(builder).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression over one row of literals."""
    def run(expr, **columns):
        from pyspark.sql import functions as F
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
        return row.select(expr.alias("x")).first()["x"]
    return run
