"""Where intermediate data may go: the folder all executors share, named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session that names none gets one of its own."""
    context = spark.sparkContext
    folder = named = context.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="vitrine-llm-")
    if not named:
        context.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder, so that later branches neither recompute nor depend on executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps that have been settled and that nothing refers to any more.

    Its cleaner acts on what the driver's garbage collectors find, by default every half hour. Python's references reach the
    JVM with some delay, hence the second round.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
