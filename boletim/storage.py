"""Where intermediate data goes: the shared folder the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Without that setting it is a folder beside the managed tables. The caller owns it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
