"""Session helpers. Nothing here creates or keeps a session."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC; wall-clock columns are read and rendered as such."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def own_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for what is started within, for instance a stream; the session has its own again afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory for checkpoints and staged files, reachable by every executor.

    It lies under ``spark.checkpoint.dir``, or where that is unset beside the tables in ``spark.sql.warehouse.dir``. On
    a cluster a warehouse in a local folder would be another one on each machine, so it is refused there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir") + "/_staged"
        one_machine = re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master"))
        if not one_machine and re.match(r"/|file:", root):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to a shared folder and read it back, which cuts its lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`shared_dir` that is no longer needed, by the file system it lies on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_staged(df: DataFrame) -> None:
    """Delete the folder of a frame that :func:`materialise` returned, or of one that only filters it, once it is read to its end."""
    files = df.inputFiles()
    if files:
        remove_dir(df.sparkSession, files[0].rsplit("/", 1)[0])
