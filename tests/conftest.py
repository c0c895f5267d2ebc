import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clipledger.session import build_session, release

    session = build_session("tests", 8, shuffle_partitions=4)
    # Small tables would end up in one range; keep several, as at scale.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield session
    release(session)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
