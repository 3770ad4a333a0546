"""Carry-forward between dated snapshots, provenance and fallbacks."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def stamped(fresh: DataFrame, run_date: str, column: str = "scraped_at") -> DataFrame:
    return fresh.withColumn(column, F.lit(run_date))


def carry_forward(previous: DataFrame | None, fresh: DataFrame, groups: list[str] | None, group: str = "chain") -> DataFrame:
    """``fresh`` and, on a run of some ``groups`` only, the previous rows of all others as they were."""
    if previous is None or groups is None:
        return fresh
    return previous.filter(F.col(group).isNull() | ~F.col(group).isin(*groups)).unionByName(fresh, allowMissingColumns=True)


def with_fallback(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``secondary`` only for keys of which ``primary`` has none."""
    return primary.unionByName(secondary.join(primary.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def first_rows(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key; null and blank parts of a key count as equal and stay part of it."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*parts).orderBy(*order))).filter("_rank = 1").drop("_rank")


def extended_roster(roster: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """The roster and what is live but not on it, marked as new."""
    fresh = live.join(roster, key, "left_anti").withColumn("is_new", F.lit(True))
    return roster.withColumn("is_new", F.lit(False)).unionByName(fresh, allowMissingColumns=True)


def unlisted(live: DataFrame, known: list[DataFrame], key: str) -> DataFrame:
    """Rows of ``live`` whose key none of the ``known`` tables has; their keys are one set first, so ``live`` is joined once."""
    keys = functools.reduce(DataFrame.union, (df.select(key) for df in known)).distinct()
    return live.join(keys, key, "left_anti")


def check_groups(groups: list[str], known: DataFrame, group: str = "chain") -> None:
    """Raises where a wanted group is none of those known, so that a misspelt run does not carry everything forward."""
    spark = known.sparkSession
    odd = spark.createDataFrame([(g,) for g in groups], f"{group} string").join(known.select(group), group, "left_anti").orderBy(group).first()
    if odd:
        raise ValueError(f"unknown {group} {odd[0]!r}")


def last_bucket(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value for each key, the one of the last bucket."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def tagged_regions(properties: DataFrame, buckets: DataFrame, key: str = "mall_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Properties with the region of the last bucket that lists them, bucket rows that are no property, properties in no bucket."""
    region = last_bucket(buckets, key, "region", "bucket")
    return properties.drop("region").join(region, key, "left"), buckets.join(properties, key, "left_anti"), properties.join(buckets, key, "left_anti")
