"""Session defaults and the shared folder for checkpoints and cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "rollbook", cores: str = "8", scratch: str | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own. ``scratch`` is its shared folder."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.checkpoint.dir", scratch or tempfile.mkdtemp(prefix="rollbook-"))
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("ROLLBOOK_DRIVER_MEMORY", "8g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``, which all executors share.

    The setting belongs to the cluster or to whoever builds the session, as ``local_session`` does; a missing one
    is an error at every master, because executors could not read what another machine wrote.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and kept when executors are lost."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
