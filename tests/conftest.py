import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from burstwatch.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests", f"local[{os.environ.get('TEST_CPUS', '*')}]",
        spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def lines(spark):
    """JSON texts or plain lines as a ``value`` table."""

    def make(values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    return make
