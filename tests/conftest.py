from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidegauge.session import local_session

    session = local_session(cpus=8, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def ts():
    from pyspark.sql import functions as F

    return lambda text: F.lit(text).cast("timestamp_ntz")


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(row) for row in df.collect()), key=str)
