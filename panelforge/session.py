"""Session set-up and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "panelforge", cores: int | str = "*",
                  shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the one the cluster names in ``spark.checkpoint.dir``.

    Executors on every machine must see the folder, so a machine-local one is only used where the
    setting is absent and the session is local, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="panelforge-")
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    For frames that several jobs or several branches of a plan use: the lineage is cut, a lost
    executor costs nothing already written, and later reads prune columns and push filters down.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
