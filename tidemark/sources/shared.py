"""The folder that all executors share, for scratch tables and checkpoints."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir. Only a local master, whose executors share this machine's disk, gets one of
    our own where that is unset, as in tests."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{named or '/tmp/checkpoints/' + spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
