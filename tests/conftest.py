import os
import sys

import pytest

from tests import accounting

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import get_session, checkpoint_dir
    s = get_session("local[4]", 8, extra={"spark.sql.execution.arrow.pyspark.enabled": "true",
                                          "spark.driver.memory": "8g", **accounting.conf()})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from tidewater.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture
def tmpdir_run(tmp_path):
    return str(tmp_path)
