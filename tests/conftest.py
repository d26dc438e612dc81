import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shopstrata.session import local_session  # noqa: E402

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_dir():
    return "/root/testdata/sf0.001"
