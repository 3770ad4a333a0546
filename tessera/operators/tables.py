"""Presence, summaries and counts of entities in containers that groups publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GROUP, CONTAINER, ENTITY = "chain", "mall_id", "brand_key"


def usable(entity: str = ENTITY) -> Column:
    return F.col(entity).isNotNull() & (F.col(entity) != "")


def groups_of(properties: DataFrame, group: str = GROUP, most: int = 1000) -> list[str]:
    """The groups in order: a dimension, so its size is checked."""
    found = [r[0] for r in properties.select(group).filter(F.col(group).isNotNull()).distinct().orderBy(group).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values of {group}")
    return found


def edges(listings: DataFrame, entity: str = ENTITY, group: str = GROUP, container: str = CONTAINER) -> DataFrame:
    """Each (entity, group, container) once."""
    return listings.filter(usable(entity)).select(entity, group, container).dropDuplicates()


def links(listings: DataFrame, entity: str = ENTITY, group: str = GROUP, container: str = CONTAINER) -> DataFrame:
    """Each edge once, with the number of its listings: what summaries of the same listings share."""
    return listings.filter(usable(entity)).groupBy(entity, group, container).agg(F.count(F.lit(1)).alias("listings"))


def most_frequent(df: DataFrame, key: str, column: str, out: str) -> DataFrame:
    """(key, out): each key's most frequent value of ``column``, ties to the lowest; null only where a key has no other.

    Values are counted where the rows are, so rows are moved once counted and none is held for its key.
    """
    counts = df.groupBy(key, F.col(column).alias(out)).agg(F.count(column).alias("_n"))
    return counts.groupBy(key).agg(F.min_by(out, F.struct(-F.col("_n"), F.col(out))).alias(out))


def presence(listings: DataFrame, properties: DataFrame, entity: str = ENTITY, group: str = GROUP, container: str = CONTAINER, linked: DataFrame | None = None) -> DataFrame:
    """Edges with the name and region of their property; edges of unknown properties drop out.

    ``linked`` are the ``links`` of the listings, where they are at hand; here and below they spare a pass over all listings.
    """
    found = edges(listings, entity, group, container) if linked is None else linked.select(entity, group, container)
    return found.join(properties.select(group, container, "mall_name", "region"), [group, container])


def entity_summary(
    listings: DataFrame, properties: DataFrame, groups: list[str] | None = None, entity: str = ENTITY, group: str = GROUP, container: str = CONTAINER, linked: DataFrame | None = None
) -> DataFrame:
    """Per entity: containers in each group, in all, number of groups and the most frequent raw name.

    Ties of names go to the lowest. Groups without listings get a column of zeros.
    """
    groups = groups_of(properties, group) if groups is None else groups
    found = edges(listings, entity, group, container) if linked is None else linked
    counts = found.join(properties.select(group, container), [group, container], "left_semi").groupBy(entity, group).agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy(entity).agg(
        *(F.coalesce(F.sum(F.when(F.col(group) == g, F.col("n"))), F.lit(0)).alias(f"n_malls_{g}") for g in groups),
        F.sum("n").alias("n_malls_total"),
        F.count(group).alias("n_chains"),
    )
    names = most_frequent(listings.filter(usable(entity)), entity, "store_name_raw", "display_name")
    return per.join(names, entity).withColumns({"in_all_chains": F.col("n_chains") == len(groups), "in_multiple_chains": F.col("n_chains") > 1})


def _alone(found: DataFrame, entity: str) -> DataFrame:
    """The rows of entities that have one only. Rows are counted first: their least values, which are texts, would be told by sorting all."""
    return found.join(found.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select(entity), entity, "left_semi")


def unique_entities(listings: DataFrame, properties: DataFrame, entity: str = ENTITY, group: str = GROUP, container: str = CONTAINER, linked: DataFrame | None = None) -> DataFrame:
    """Entities in one container only, with that container."""
    only = _alone(presence(listings, properties, entity, group, container, linked), entity)
    names = most_frequent(listings.filter(usable(entity)), entity, "store_name_raw", "display_name")
    return only.join(names, entity).select(entity, "display_name", group, container, "mall_name", "region")


def top_categories(listings: DataFrame, k: int = 3, entity: str = ENTITY, group: str = GROUP, container: str = CONTAINER, category: str = "category") -> DataFrame:
    """The ``k`` most frequent raw categories of each container as "name (n), ..."; "" where there is none."""
    counts = listings.filter(usable(entity)).groupBy(group, container, category).agg(F.count(category).alias("n"))
    best = Window.partitionBy(group, container).orderBy(F.desc("n"), category)
    ranked = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    shown = F.when(F.col(category).isNotNull(), F.struct("rank", F.concat(category, F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("text")))
    return ranked.groupBy(group, container).agg(F.array_join(F.transform(F.array_sort(F.collect_list(shown)), lambda s: s["text"]), ", ").alias("top_categories"))


def container_summary(
    listings: DataFrame, properties: DataFrame, entity: str = ENTITY, group: str = GROUP, container: str = CONTAINER, category: str = "category", linked: DataFrame | None = None
) -> DataFrame:
    """Per container with listings: how many, of how many entities, its top categories and its exclusive entities."""
    keys = [group, container]
    linked = links(listings, entity, group, container) if linked is None else linked
    counts = linked.groupBy(*keys).agg(F.sum("listings").alias("n_stores"), F.count(F.lit(1)).alias("n_brands"))
    alone = _alone(presence(listings, properties, entity, group, container, linked), entity).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_unique_brands"))
    return (
        counts.join(top_categories(listings, 3, entity, group, container, category), keys)
        .join(properties.select(*keys, "mall_name", "region"), keys)
        .join(alone, keys, "left")
        .withColumn("n_unique_brands", F.coalesce("n_unique_brands", F.lit(0)))
    )


def listing_counts(properties: DataFrame, listings: DataFrame, group: str = GROUP, container: str = CONTAINER) -> DataFrame:
    """Properties with the number of their listings, 0 where there is none."""
    counts = listings.groupBy(group, container).agg(F.count(F.lit(1)).alias("listings"))
    return properties.join(counts, [group, container], "left").withColumn("listings", F.coalesce("listings", F.lit(0)))


def group_totals(properties: DataFrame, listings: DataFrame, group: str = GROUP, container: str = CONTAINER) -> DataFrame:
    """Per group and in all (null group): properties, malls among them, listings and sorted fetch dates."""
    counted = listing_counts(properties, listings, group, container)
    return counted.rollup(group).agg(
        F.count(F.lit(1)).alias("properties"),
        F.count_if(F.col("property_type") == "mall").alias("malls"),
        F.sum("listings").alias("listings"),
        F.array_join(F.array_sort(F.collect_set("scraped_at")), ", ").alias("fetched"),
        F.grouping(group).cast("int").alias("is_total"),
    )


def placed_counts(properties: DataFrame, column: str) -> DataFrame:
    """Properties with a coordinate by ``column``."""
    return properties.filter(F.col("lat").isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("properties"))


def exclusive_counts(listings: DataFrame, properties: DataFrame, entity: str = ENTITY, group: str = GROUP, container: str = CONTAINER) -> DataFrame:
    """Per group: entities found in that group only."""
    return (
        presence(listings, properties, entity, group, container)
        .groupBy(entity)
        .agg(F.countDistinct(group).alias("n"), F.min(group).alias(group))
        .filter(F.col("n") == 1)
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("exclusive"))
    )


def headline_counts(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count_if("in_all_chains").alias("in_all"), F.count_if("in_multiple_chains").alias("in_several"), F.count(F.lit(1)).alias("entities"))


def top_entities(summary: DataFrame, k: int = 20, entity: str = ENTITY) -> DataFrame:
    return summary.orderBy(F.desc("n_malls_total"), entity).limit(k)


def top_within(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key, with the number of all its rows."""
    here = Window.partitionBy(*keys)
    return df.withColumns({"rank": F.row_number().over(here.orderBy(*order)), "of": F.count(F.lit(1)).over(here)}).filter(F.col("rank") <= k)


def totals(properties: DataFrame, listings: DataFrame, entity: str = "brand_canonical") -> DataFrame:
    """One row: properties, malls, listings, entities and placed properties."""
    p = properties.agg(
        F.count(F.lit(1)).alias("properties"), F.count_if(F.col("property_type") == "mall").alias("malls"), F.count("lat").alias("mapped")
    )
    return p.crossJoin(listings.agg(F.count(F.lit(1)).alias("listings"), F.countDistinct(F.when(usable(entity), F.col(entity))).alias("brands")))


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def reach(listings: DataFrame, entity: str = ENTITY, container: str = CONTAINER) -> DataFrame:
    """Distinct containers of each entity, whatever the group."""
    return listings.filter(usable(entity)).groupBy(entity).agg(F.countDistinct(container).alias("reach"))
