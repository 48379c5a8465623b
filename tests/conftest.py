import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surgecast.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="surgecast-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="surgecast-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


def _duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture(scope="session")
def duck_small():
    return _duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_mid():
    return _duck(SF_MID)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="surgecast-test-")
