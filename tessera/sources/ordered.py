"""Tables whose files keep an order, with a manifest of bounds: readers get the order without a sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.scratch import passing


def columns(order: Sequence[str | Column]) -> list[Column]:
    """Columns to order by; a name after a minus is for falling values."""
    return [c if isinstance(c, Column) else F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in order]


def _file() -> Column:
    return F.col("_metadata.file_name")


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}.manifest"


def write(df: DataFrame, path: str, order: Sequence[str | Column], most: int = 500_000) -> None:
    """Writes ``df`` in ranges of ``order``, each file sorted, and beside it (file, start, rows, first, last) for each file.

    Rows are dealt by sampled ranges of about ``most`` rows, so no task sorts more than one, however many rows there are. They are written once before,
    since they are counted, sampled and dealt. ``first`` and ``last`` are a file's first and last row as JSON.
    Where rows tie, what is written is their order from then on.
    """
    spark = df.sparkSession
    with passing(df, "unordered") as rows:
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // most))
        rows.repartitionByRange(ranges, *columns(order)).sortWithinPartitions(*columns(order)).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).select(_file().alias("file"), F.col("_metadata.row_index").alias("at"), F.struct(*df.columns).alias("row"))
    # rows are counted without their values, and only the first and last of a file are spelled
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    ends = rows.join(F.broadcast(files), "file").filter("at = 0 or at = rows - 1").select("file", "rows", "at", F.to_json("row").alias("row"))
    files = ends.groupBy("file", "rows").agg(F.max(F.when(F.col("at") == 0, F.col("row"))).alias("first"), F.max(F.when(F.col("at") == F.col("rows") - 1, F.col("row"))).alias("last"))
    # tasks write their range under their own number, and a task's further files are numbered as well
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    before = F.coalesce(F.sum("rows").over(Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files.withColumn("start", before).select("file", "start", "rows", "first", "last").coalesce(1).write.mode("overwrite").parquet(manifest_path(path))


def read(spark: SparkSession, path: str, place: str = "place") -> DataFrame:
    """The table with each row's place in the order, from 0: where its file starts and its row within it."""
    starts = spark.read.parquet(manifest_path(path)).select("file", "start")
    rows = spark.read.parquet(path)
    placed = rows.select("*", _file().alias("_file"), F.col("_metadata.row_index").alias("_row")).join(F.broadcast(starts), F.col("_file") == F.col("file"))
    return placed.select(*rows.columns, (F.col("start") + F.col("_row")).alias(place))
