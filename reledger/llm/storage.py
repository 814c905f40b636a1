"""Intermediate tables in the folder that all executors share, and input tables."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one on a local master without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='reledger-llm-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet and read back: its lineage ends at the files.

    The files survive the loss of executors. They stay until the owner of the folder removes
    them, since the result that reads them is lazy.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/reledger-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table from `written` that no later step reads.

    What was made of it must be written by then: a lost executor then never needs it again.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Seconds between two collections of garbage: steps shorter than that leave little to delete.
RELEASE_SECONDS = 2.0
_released = [0.0]


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished steps now, not at some later GC.

    The cleaner only sees what the driver has collected as garbage; a job of many steps would
    keep the shuffles of all of them on the executors' disks until then.
    """
    if time.monotonic() - _released[0] < RELEASE_SECONDS:
        return
    spark.range(0).collect()  # Spark's listeners hold on to the last query, and so to its shuffles
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()
    _released[0] = time.monotonic()
