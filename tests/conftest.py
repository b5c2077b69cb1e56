from __future__ import annotations

import json
import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratalake.schemas import BRONZE
from stratalake.session import configured

NOON = datetime(2024, 1, 1, 12)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    builder = configured("local[4]", shuffle_partitions=4).config("spark.checkpoint.dir", f"{shared}/stages")
    session = builder.config("spark.driver.memory", "6g").config("spark.sql.warehouse.dir", f"{shared}/warehouse").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(spark):
    """Bronze rows from ``(endpoint, payload[, ingested_at])``; a payload may be text or a dict."""

    def make(*rows):
        data = []
        for endpoint, payload, *at in rows:
            text = payload if isinstance(payload, str) else json.dumps(payload)
            data.append((None, at[0] if at else NOON, text, endpoint))
        return spark.createDataFrame(data, BRONZE)

    return make


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
