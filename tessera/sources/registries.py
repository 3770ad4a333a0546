"""Committed registries: aliases, coverage gaps, excluded operators, coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COORDINATE_SCHEMA = 1
#: How each line of a sharded registry begins.
LINE = '{"schema":'
ENTRY = "struct<lat: double, lon: double, source: string, precision: string, matched: string, ref: string>"
GAP = "struct<name: string, region: string, location: string, slug: string, opened: string, property_type: string, note: string, directory_source: string>"
EXCLUDED = "struct<chain: string, name: string, site: string, malls_known: string, status: string, finding: string, recheck: string>"


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """(variant, canonical); a variant of two canonical keys is an error, since neither would be right."""
    doc = spark.read.schema("aliases map<string, array<string>>").json(path, multiLine=True)
    pairs = doc.select(F.explode("aliases").alias("canonical", "variants")).select(F.explode("variants").alias("variant"), "canonical").filter("variant <> canonical").distinct()
    twice = pairs.groupBy("variant").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice:
        raise ValueError(f"{twice.variant!r} has several canonical keys")
    return pairs


def coverage_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Properties that a publisher's listing is known to lack, with the file each comes from."""
    doc = spark.read.schema(f"not_in_api array<{GAP}>").json(path, multiLine=True)
    return doc.select(F.input_file_name().alias("registry"), F.explode("not_in_api").alias("g")).select("registry", "g.*").withColumnRenamed("name", "gap_name")


def excluded_operators(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"chains array<{EXCLUDED}>").json(path, multiLine=True).select(F.explode("chains").alias("c")).select("c.*")


def coordinates(spark: SparkSession, path: str) -> DataFrame:
    """(chain, mall_id, lat, lon, source, precision, matched, ref) of one document, or of the shards that ``write_coordinates`` leaves.

    Every document and every line of a shard tells its schema version; another one is refused before anything is returned.
    """
    lines = spark.read.text(path)
    sharded = not lines.filter(F.col("value").startswith(LINE)).isEmpty()
    if sharded:
        doc = spark.read.schema(f"schema int, key string, entry {ENTRY}").json(path)
    else:
        doc = spark.read.schema(f"schema int, entries map<string, {ENTRY}>").json(path, multiLine=True)
    odd = doc.filter(~F.col("schema").eqNullSafe(COORDINATE_SCHEMA)).first()
    if odd:
        raise ValueError(f"coordinate registry of schema {odd['schema']}")
    rows = doc.select("key", F.col("entry").alias("e")) if sharded else doc.select(F.explode("entries").alias("key", "e"))
    return rows.select(F.substring_index("key", ":", 1).alias("chain"), F.expr("substring(key, instr(key, ':') + 1)").alias("mall_id"), "e.*")


def write_coordinates(registry: DataFrame, path: str) -> None:
    """Shards of one line an entry, in the order of their keys; a key twice is an error, and nothing is written then."""
    key = F.concat_ws(":", "chain", "mall_id")
    twice = registry.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice:
        raise ValueError(f"{twice['key']!r} has several coordinates")
    entry = F.struct("lat", "lon", "source", "precision", "matched", "ref").alias("entry")
    lines = registry.select(F.lit(COORDINATE_SCHEMA).alias("schema"), key.alias("key"), entry)
    lines.repartitionByRange("key").sortWithinPartitions("key").write.mode("overwrite").json(path)
