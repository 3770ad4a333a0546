"""Tables written once and read again: where a result is read twice, or its lineage has to end."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Where that is unset, a local master gets a temporary folder, a cluster one below its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local["):
        own = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        named = f"file://{own}"
    else:
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/_tessera"
    spark.conf.set("spark.checkpoint.dir", named)
    return named


#: Paths that the innermost block of ``held`` has to remove.
_HELD: ContextVar[list[str] | None] = ContextVar("held", default=None)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder; a lost executor or a repeated stage reads it again and finds the same rows.

    Inside a block of ``held`` it is there as long as the block lasts.
    """
    path = f"{folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    if (paths := _HELD.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(spark: SparkSession) -> Iterator[None]:
    """For steps whose results are stored elsewhere: tables that they write here go with the block, and shuffled rows with the job that needed them.

    Otherwise shuffled rows of all jobs stay on disk until the driver happens to collect its garbage.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    outer = _HELD.set(paths := [])
    try:
        yield
    finally:
        _HELD.reset(outer)
        spark.conf.set(SHUFFLE_CLEANUP, before)
        for path in paths:
            _remove(spark, path)


@contextmanager
def passing(df: DataFrame, tag: str) -> Iterator[DataFrame]:
    """``df`` written as ``written`` does, for as long as the block lasts."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _remove(spark, path)
