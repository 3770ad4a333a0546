"""Containers whose listings run names together, mentions of entities inside names, and how fresh sources are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.tables import groups_of, usable


def _words(column: str) -> Column:
    return F.filter(F.split(column, " "), lambda w: w != "")


def attested(listings: DataFrame, least: int = 3, least_single: int = 8, entity: str = "brand_key", group: str = "chain", container: str = "mall_id") -> DataFrame:
    """(group, entity): for each group, entities that enough containers of other groups carry; single words need more."""
    spread = listings.filter(usable(entity)).select(entity, group, container).distinct()
    own = spread.groupBy(entity, group).agg(F.count(F.lit(1)).alias("own"))
    total = own.groupBy(entity).agg(F.sum("own").alias("all"))
    groups = F.array(*map(F.lit, groups_of(spread, group)))
    need = F.when(F.size(_words(entity)) > 1, least).otherwise(least_single)
    enough = total.filter(F.col("all") >= need)  # an entity that falls short everywhere needs no row for each group
    here = enough.withColumn(group, F.explode(groups)).join(own, [entity, group], "left")
    return here.filter(F.col("all") - F.coalesce("own", F.lit(0)) >= need).select(group, entity)


def combined_names(listings: DataFrame, known: DataFrame, words: float = 4, share: float = 0.40, entity: str = "brand_key", group: str = "chain", container: str = "mall_id") -> DataFrame:
    """Containers whose median name has ``words`` words or where a known entity begins ``share`` of the longer names.

    Each name offers its shorter beginnings, which are joined to the known entities by equality.
    """
    rows = listings.filter(usable(entity)).groupBy(group, container, entity).agg(F.count(F.lit(1)).alias("n")).withColumn("w", _words(entity))
    starts = F.when(F.size("w") > 1, F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda n: F.array_join(F.slice("w", F.lit(1), n), " ")))
    names = rows.select(group, entity, F.explode(starts).alias("start")).distinct()
    begun = names.join(known.withColumnRenamed(entity, "start"), [group, "start"], "left_semi").select(group, entity).distinct().withColumn("begun", F.lit(1))
    marked = rows.join(begun, [group, entity], "left")
    share_begun = F.sum(F.col("n") * F.coalesce("begun", F.lit(0))) / F.sum("n")
    per = marked.groupBy(group, container).agg(F.percentile(F.size("w"), F.lit(0.5), F.col("n")).alias("median_words"), share_begun.alias("share_begun"))
    return per.withColumn("combined", (F.col("median_words") >= words) | (F.col("share_begun") >= share))


def mentions(listings: DataFrame, known: DataFrame, most_words: int = 6, entity: str = "brand_key", group: str = "chain", container: str = "mall_id") -> DataFrame:
    """(group, container, name, mention): known entities inside longer names, whole words only.

    Every run of up to ``most_words`` words is joined to the known entities. Of what is found in a name, the scan
    goes left to right, takes the longest at each place and continues after it.
    """
    rows = listings.filter(usable(entity)).select(group, container, F.col(entity).alias("name")).distinct().withColumn("w", _words("name")).filter(F.size("w") > 1)
    spot = rows.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w")))).withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.lit(most_words), F.size("w") - F.col("at") + 1))))
    runs = spot.filter(F.col("n") < F.size("w")).select(group, container, "name", "at", "n", F.array_join(F.slice("w", F.col("at"), F.col("n")), " ").alias(entity))
    found = runs.join(known, [group, entity])
    each = found.groupBy(group, container, "name").agg(F.array_sort(F.collect_list(F.struct("at", (-F.col("n")).alias("less"), F.col(entity).alias("mention")))).alias("hits"))
    start = F.struct(F.lit(1).alias("next"), F.expr("cast(array() as array<string>)").alias("taken"))
    step = lambda s, h: F.when(h["at"] >= s["next"], F.struct((h["at"] - h["less"]).alias("next"), F.array_append(s["taken"], h["mention"]).alias("taken"))).otherwise(s)
    return each.select(group, container, "name", F.explode(F.array_distinct(F.aggregate("hits", start, step, lambda s: s["taken"]))).alias("mention"))


def freshness(rows: DataFrame, today: str, days: int = 730, group: str = "chain", date: str = "scraped_at") -> DataFrame:
    """Per group the newest date, its age in days and whether that is more than ``days``."""
    newest = rows.groupBy(group).agg(F.max(F.to_date(date)).alias("newest"))
    return newest.withColumn("age", F.date_diff(F.lit(today).cast("date"), F.col("newest"))).withColumn("stale", F.col("age") > days)


def gaps_in_runs(listings: DataFrame, snapshot: str, group: str = "chain", container: str = "mall_id") -> DataFrame:
    """Containers that a snapshot lacks although an earlier and a later one have them."""
    order = listings.select(snapshot).distinct().withColumn("n", F.dense_rank().over(Window.orderBy(snapshot)))  # a row for each snapshot
    seen = listings.select(group, container, snapshot).distinct().join(F.broadcast(order), snapshot)
    next_ = F.lead("n").over(Window.partitionBy(group, container).orderBy("n"))
    return seen.withColumn("missed", next_ - F.col("n") - 1).filter("missed > 0").select(group, container, F.col(snapshot).alias("after"), "missed")
