"""Folders that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, label: str) -> str:
    """A new name in the folder of spark.checkpoint.dir; in local runs without the setting, in a temporary folder."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="gleaner-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
