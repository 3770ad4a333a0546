"""Dated snapshots of tables by stage, and the published one."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import entity_key
from tessera.operators.quality import LISTING_COLUMNS, PROPERTY_COLUMNS
from tessera.sources import ordered

STAGES = ("1_scrape", "2_clean", "3_report", "4_website")
#: The twins repeat every text in every row, so they are zipped; level 1 is a tenth of their size already.
CSV = {"header": True, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
LATEST, POINTERS, SEAL, REVISION = "latest", "_published", "_sealed", "~"


@dataclass(frozen=True)
class Snapshots:
    """Tables below root/run_date/stage/name, as Parquet for code with a zipped CSV twin for people.

    A run that was published is sealed: writing to its date again starts a revision of it, root/run_date~2, and so on,
    and reading a date finds the newest revision of each table. All paths go through Spark's own file systems, so root may be any
    store that Spark reads.
    """

    spark: SparkSession
    root: str

    def path(self, run_date: str, stage: str, name: str = "") -> str:
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage!r}")
        return "/".join(x for x in (self.root, run_date, stage, name) if x)

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _names(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _folders(self, run_date: str) -> list[str]:
        """The run's revisions, the newest first; of the published one, those it was published with."""
        if run_date == LATEST:
            found = self.published()
            return found["folders"] if found else []
        own = [n for n in self._names(self.root) if n.partition(REVISION)[0] == run_date]
        return sorted(own, key=lambda n: int(n.partition(REVISION)[2] or 1), reverse=True)

    def _open_folder(self, run_date: str) -> str:
        if run_date == LATEST:
            raise ValueError("the published snapshot is not written to")
        newest = next(iter(self._folders(run_date)), run_date)
        fs, seal = self._fs(f"{self.root}/{newest}/{SEAL}")
        return f"{run_date}{REVISION}{int(newest.partition(REVISION)[2] or 1) + 1}" if fs.exists(seal) else newest

    def write(self, run_date: str, stage: str, name: str, df: DataFrame, csv: bool = True, order: Sequence[str | Column] = ()) -> None:
        """Writes a table; with an ``order`` its files keep it, and ``read_ordered`` gives each row its place."""
        path = self.path(self._open_folder(run_date), stage, name)
        if order:
            ordered.write(df, path, order)
        else:
            df.write.mode("overwrite").parquet(path)
        if csv:
            flat = self.spark.read.parquet(path)
            nested = {c for c, t in flat.dtypes if t.startswith(("array", "map", "struct"))}
            flat.selectExpr(*(f"to_json({c}) AS {c}" if c in nested else f"`{c}`" for c in flat.columns)).write.mode("overwrite").options(**CSV).csv(f"{path}.csv")

    def _found(self, run_date: str, stage: str, name: str) -> str | None:
        for folder in self._folders(run_date):
            fs, where = self._fs(path := self.path(folder, stage, name))
            if fs.exists(where):
                return path
        return None

    def read(self, run_date: str, stage: str, name: str) -> DataFrame | None:
        """The table, or None where it was never written."""
        self.path(run_date, stage)
        path = self._found(run_date, stage, name)
        return self.spark.read.parquet(path) if path else None

    def read_ordered(self, run_date: str, stage: str, name: str, place: str = "place") -> DataFrame:
        """A table that was written with an order, and where each row stands in it, from 0."""
        path = self._found(run_date, stage, name)
        if path is None:
            raise FileNotFoundError(f"no {name} of {stage} for {run_date}")
        return ordered.read(self.spark, path, place)

    def need(self, run_date: str, stage: str, name: str) -> DataFrame:
        found = self.read(run_date, stage, name)
        if found is None:
            raise FileNotFoundError(f"no {name} of {stage} for {run_date}")
        return found

    def runs(self) -> list[str]:
        """Run dates in order."""
        return sorted({n.partition(REVISION)[0] for n in self._names(self.root) if n != LATEST and n[0] not in "._"})

    def previous(self, run_date: str) -> str | None:
        return max((r for r in self.runs() if r < run_date), default=None)

    def is_usable(self, run_date: str) -> bool:
        """Both tables are there, have their columns and at least a row."""
        try:
            for name, columns in (("malls", PROPERTY_COLUMNS[:3]), ("stores", LISTING_COLUMNS[:3])):
                df = self.read(run_date, STAGES[0], name)
                if df is None or not set(columns) <= set(df.columns) or df.isEmpty():
                    return False
        except AnalysisException:
            return False
        return True

    def latest_usable(self) -> str | None:
        return next((r for r in reversed(self.runs()) if self.is_usable(r)), None)

    def published(self) -> dict | None:
        """What the newest pointer says: the published run and its folders."""
        newest = max((n for n in self._names(f"{self.root}/{POINTERS}") if n.isdigit()), default=None)
        if newest is None:
            return None
        fs, where = self._fs(f"{self.root}/{POINTERS}/{newest}")
        stream = fs.open(where)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, run_date: str) -> None:
        """Makes ``run_date`` the published snapshot; an unusable one is refused and leaves the old in place.

        Nothing is copied: the run is sealed, and a pointer to its folders, whole before it gets its name, follows the ones before. The newest
        pointer counts, and none is ever changed or replaced, so a reader finds a published snapshot at any time.
        """
        if not self.is_usable(run_date):
            raise ValueError(f"{run_date} is not usable")
        folders = self._folders(run_date)
        fs, seal = self._fs(f"{self.root}/{folders[0]}/{SEAL}")
        fs.create(seal, True).close()
        _, draft = self._fs(f"{self.root}/{POINTERS}/_{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps({"run": run_date, "folders": folders}).encode()))
        stream.close()
        while True:
            n = max((int(x) for x in self._names(f"{self.root}/{POINTERS}") if x.isdigit()), default=0) + 1
            _, pointer = self._fs(f"{self.root}/{POINTERS}/{n:012d}")
            if not fs.exists(pointer) and fs.rename(draft, pointer):
                return

    def listings(self, run_date: str) -> DataFrame:
        """Cleaned listings where there are any; else raw ones, keyed by their raw name."""
        cleaned = self.read(run_date, STAGES[1], "stores_clean")
        if cleaned is not None:
            return cleaned
        raw = self.need(run_date, STAGES[0], "stores")
        return raw if "brand_key" in raw.columns else raw.withColumn("brand_key", entity_key(F.col("store_name_raw")))
