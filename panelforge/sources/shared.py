"""The folder that all nodes share, for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``; where that is unset, as in tests on one machine, under a temporary one."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or _own.get(context.applicationId)
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
