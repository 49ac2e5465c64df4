"""The folder all executors can reach, for tables this package writes on its own account."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="symgrid-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the context's; a temporary one only where one process does all."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach")
        folder = _local_folder()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a folder that does not exist yet, under the shared folder."""
    return f"{shared_folder(spark)}/symgrid/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package made, on whatever filesystem it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
