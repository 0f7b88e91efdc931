import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from remitlake.plans.staging import Lake  # noqa: E402
from remitlake.session import build_session  # noqa: E402
from remitlake.sources import tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def lake(spark, tmp_path):
    database = f"t_{uuid.uuid4().hex}"
    tables.ensure_database(spark, database, str(tmp_path / "db"))
    tables.ensure_tables(spark, database)
    yield Lake(str(tmp_path / "landing"), database)
    spark.sql(f"DROP DATABASE {database} CASCADE")
