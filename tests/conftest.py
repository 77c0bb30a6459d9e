"""Shared fixtures: one local session, the driver's test tables, small edge rows."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    scratch = tempfile.mkdtemp(prefix="tidemark-tests-")
    session = local_session(
        cores=2, shuffle_partitions=4, app_name="tidemark-tests",
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
               "spark.checkpoint.dir": os.path.join(scratch, "checkpoints")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events_small(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


@pytest.fixture(scope="session")
def events_check(spark):
    return spark.read.parquet(f"{SF_CHECK}/events.parquet")
