import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mediaspark.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


def local_session(cpus: int = 8):
    return build_session(
        "tests",
        master=f"local[{cpus}]",
        shuffle_partitions=4,
        options={
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
