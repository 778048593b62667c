"""The shared folder for tables that a session writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused path below the folder that the cluster names for checkpoints.

    Only a local session without that setting falls back to a temporary folder of the machine.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        base = f"{tempfile.gettempdir()}/orestack-{spark.sparkContext.applicationId}"
    return f"{base.rstrip('/')}/orestack/{purpose}-{uuid.uuid4().hex}"
