"""Sessions for trying things out on one machine."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from stratalake.session import configured


def local_session(cores: int, shuffle_partitions: int, memory: str = "12g") -> SparkSession.Builder:
    """A session with a folder of its own for intermediate tables; on a cluster both are for the submitter to set."""
    folder = tempfile.mkdtemp(prefix="stratalake-")
    return (
        configured(f"local[{cores}]", shuffle_partitions).config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", f"{folder}/stages").config("spark.sql.warehouse.dir", f"{folder}/warehouse")
    )
