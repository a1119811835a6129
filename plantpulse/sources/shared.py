"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session.

    Where it is unset, a session on one machine gets a temporary folder; on a
    cluster that is an error, because its machines would not see each other's
    files there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    return tempfile.mkdtemp(prefix="plantpulse-")
