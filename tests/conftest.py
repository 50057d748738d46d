import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lanecast.session import apply_conf
    b = (SparkSession.builder.master("local[4]").appName("lanecast-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    apply_conf(s)
    # tests set their own shared folder only when the session has none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lanecast-test-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    tables = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()

    def for_dir(sf_dir):
        for t in tables:
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return for_dir
