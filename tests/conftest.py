import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from lymphlake.plans.session import session

    s = session("local[8]", 8)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for t in Path(sf).glob("*.parquet"):
        con.execute(f"create view {t.stem} as select * from read_parquet('{t}')")
    return con
