"""The driver's tables as properties and listings.

Suppliers are properties of their region; line items are listings of parts. Coordinates are fixed arithmetic of the
supplier's key, so some are missing and some lie out of bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    k = F.col("s_suppkey")
    placed = k % 10 != 0
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("chain"),
        k.cast("string").alias("mall_id"),
        F.col("s_name").alias("mall_name"),
        F.col("n_name").alias("region"),
        F.concat(F.lit("Unit "), k % 50, F.lit(", Block "), k % 7, F.lit(", "), F.col("n_name"), F.lit(", "), F.col("r_name")).alias("address"),
        F.when(k % 7 == 0, "office-annex").otherwise("mall").alias("property_type"),
        F.when(placed, 4 + ((k * 37) % 1800) / 100).alias("lat"),
        F.when(placed, 115 + ((k * 53) % 1300) / 100).alias("lon"),
        F.when(~placed, F.lit(None)).when(k % 3 == 0, "operator").otherwise("osm").alias("geo_source"),
        F.when(placed, F.when(k % 4 == 0, "exact").when(k % 4 == 1, "address").otherwise("locality")).alias("geo_precision"),
        F.concat(F.lit("2024-0"), k % 3 + 1, F.lit("-01")).alias("scraped_at"),
    )


def listings(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Line items of parts as listings, with ``more`` columns of theirs."""
    item, part, s = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    chains = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    return item.join(part, F.col("l_partkey") == F.col("p_partkey")).join(chains, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("r_name").alias("chain"),
        F.col("l_suppkey").cast("string").alias("mall_id"),
        F.concat_ws(" ", "p_name", "p_brand").alias("store_name_raw"),
        F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("brand_key"),
        F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("brand_canonical"),
        F.initcap("p_name").alias("store_name"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_type") == "STANDARD", "unknown").when(F.col("p_type") == "PROMO", "shopping").otherwise(F.lower("p_type")).alias("category_std"),
        F.concat(F.lit("Level "), "l_linenumber").alias("floor"),
        F.concat(F.lit("Level "), "l_linenumber").alias("floor_std"),
        F.when(F.col("l_linenumber") < 6, F.col("l_linenumber")).alias("floor_level"),
        F.when(F.col("l_partkey") % 5 == 0, F.concat(F.lit("0917"), F.lpad((F.col("l_partkey") % 10_000_000).cast("string"), 7, "0"))).when(F.col("l_partkey") % 5 == 1, F.lit("555-1234")).alias("phone"),
        F.date_format("l_shipdate", "yyyy-MM").alias("scraped_at"),
        *more,
    )


#: The same two as common table expressions of ANSI SQL.
PROPS_SQL = """props AS (
  SELECT r_name AS chain, CAST(s_suppkey AS VARCHAR) AS mall_id, s_name AS mall_name, n_name AS region,
    concat('Unit ', s_suppkey % 50, ', Block ', s_suppkey % 7, ', ', n_name, ', ', r_name) AS address,
    CASE WHEN s_suppkey % 7 = 0 THEN 'office-annex' ELSE 'mall' END AS property_type,
    CASE WHEN s_suppkey % 10 <> 0 THEN 4 + CAST((s_suppkey * 37) % 1800 AS DOUBLE) / 100 END AS lat,
    CASE WHEN s_suppkey % 10 <> 0 THEN 115 + CAST((s_suppkey * 53) % 1300 AS DOUBLE) / 100 END AS lon,
    CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'operator' ELSE 'osm' END AS geo_source,
    CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 4 = 0 THEN 'exact' WHEN s_suppkey % 4 = 1 THEN 'address' ELSE 'locality' END AS geo_precision,
    concat('2024-0', s_suppkey % 3 + 1, '-01') AS scraped_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LIST_SQL = """list AS (
  SELECT r_name AS chain, CAST(l_suppkey AS VARCHAR) AS mall_id, concat(p_name, ' ', p_brand) AS store_name_raw,
    concat(p_name, ' ', p_size) AS brand_key, concat(p_name, ' ', p_size) AS brand_canonical,
    concat(upper(substr(p_name, 1, 1)), substr(split_part(p_name, ' ', 1), 2), ' ', upper(substr(split_part(p_name, ' ', 2), 1, 1)), substr(split_part(p_name, ' ', 2), 2)) AS store_name,
    p_type AS category,
    CASE p_type WHEN 'STANDARD' THEN 'unknown' WHEN 'PROMO' THEN 'shopping' ELSE lower(p_type) END AS category_std,
    concat('Level ', l_linenumber) AS floor, concat('Level ', l_linenumber) AS floor_std,
    CASE WHEN l_linenumber < 6 THEN l_linenumber END AS floor_level,
    CASE WHEN l_partkey % 5 = 0 THEN concat('0917', lpad(CAST(l_partkey % 10000000 AS VARCHAR), 7, '0')) WHEN l_partkey % 5 = 1 THEN '555-1234' END AS phone,
    strftime(l_shipdate, '%Y-%m') AS scraped_at
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
