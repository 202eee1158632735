"""Where intermediate tables, landed files and stream checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of this machine, the
    same for all it writes.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.gettempdir()}/tickloom-{spark.conf.get('spark.app.id', 'session')}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into a table of the shared folder and read that from now on.

    The lineage ends there, lost executors do not matter, and Spark knows the real size
    when it chooses how to join with it.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
