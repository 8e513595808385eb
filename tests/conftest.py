from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rillstone.session import build_session  # noqa: E402
from tests.helpers import at  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def skewed(spark):
    """300 rows in arrival order, times with ties and gaps; key ``hot`` has two thirds, one key is NULL."""
    pick = random.Random(7)
    rows, ms = [], 0
    for seq in range(300):
        key = "hot" if pick.random() < 0.66 else pick.choice(["a", "b", "c", None])
        ms += pick.choice([0, 0, 1000, 2000, 5000, 40000])
        rows.append((seq * 3, key, at(ms), pick.randrange(1, 20), pick.choice("xyz")))
    df = spark.createDataFrame(rows, "seq bigint, key string, ts timestamp_ntz, v bigint, tag string")
    return df, rows
