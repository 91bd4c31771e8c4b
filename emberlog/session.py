"""Where jobs may keep intermediate tables."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that all executors share.

    The folder is the cluster's ``spark.checkpoint.dir``. Only a local-mode
    session without that setting may use the machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/emberlog-{label}-{uuid.uuid4().hex}"
