from __future__ import annotations

import json
import tempfile

import pytest
from pyspark.sql import SparkSession

from tidemark.sources.events import RECORD, from_records


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_events(spark):
    """Events from (event_id, user_id, event_type, epoch seconds, properties)."""

    def make(rows):
        data = [(str(i), u, t, float(ts), json.dumps(p or {})) for i, u, t, ts, p in rows]
        return from_records(spark.createDataFrame(data, RECORD))

    return make
