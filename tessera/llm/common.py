"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of ROWS rows where the session leaves them at Spark's 10,000: whole texts are long, and each batch stands
    several times over in the memory of an executor and its Python worker."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; sets bounded_batches as well.

    Where ``spark.checkpoint.dir`` is unset, a local master gets a temporary folder and a cluster a folder
    below its warehouse.
    """
    bounded_batches(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = f"file://{folder}"
    else:
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/_tessera"
    spark.conf.set("spark.checkpoint.dir", named)
    return named


_passing: list[list[tuple[str, str | None]]] = []


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go at the end: nothing that is handed on may read them. Those written to be kept go with the scope around, if there is one."""
    _passing.append([])
    try:
        yield
    finally:
        for path, name in _passing.pop():
            if name:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends there, so lost executors cost a read only."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _passes(path, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _passes(path: str, keep: bool, name: str | None = None) -> None:
    if len(_passing) > keep:
        _passing[-1 - keep].append((path, name))


def bucketed(df: DataFrame, by: list[str], tag: str, keep: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder, in as many buckets of the columns ``by`` as the session has shuffle partitions.

    Its rows are shuffled once; a join on all of ``by`` then moves the other side only. The catalog keeps an entry for it.
    """
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"tessera_{tag}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    _passes(path, keep, name)
    df.repartition(n, *by).write.format("parquet").bucketBy(n, *by).option("path", path).saveAsTable(name)
    return spark.table(name)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null becomes the empty string."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


_held: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a worker process keeps from one task to the next: one object, until another key takes its place.

    Workers outlive their tasks, so models and their caches of words stay warm, but no two operators' at once.
    """
    if key not in _held:
        hold_nothing()
        _held[key] = make()
    return _held[key]


def hold_nothing() -> None:
    """Gives up what the worker process keeps: for tasks that keep nothing, lest an earlier operator's model stands beside them."""
    _held.clear()
    pa.default_memory_pool().release_unused()
