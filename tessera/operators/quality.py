"""Flags, contract checks, snapshot comparisons and key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PROPERTY_COLUMNS = ("chain", "mall_id", "mall_name", "region", "property_type", "scraped_at")
LISTING_COLUMNS = ("chain", "mall_id", "store_name_raw", "scraped_at")
GEO_SOURCES, GEO_PRECISIONS = ("operator", "osm", "nominatim"), ("exact", "address", "locality")


def is_repeated(*keys: str) -> Column:
    """Whether other rows have the same keys; nulls are equal.

    A hash of the keys stands before them: rows are sorted by it, and texts, which begin alike, are compared only where it ties.
    """
    return F.count(F.lit(1)).over(Window.partitionBy(F.xxhash64(*keys), *keys)) > 1


def quality_flags(listings: DataFrame, repeated: Column | None = None) -> DataFrame:
    """``listings`` with dq_flags, what is odd about each row in a fixed order, "" where nothing is. ``repeated`` tells the repeated rows, where that is known."""
    c = F.col
    flags = (
        (c("brand_key") == "", "empty_brand_key"),
        (c("category_std") == "unknown", "category_unmapped"),
        (c("floor").isNotNull() & c("floor_level").isNull(), "floor_level_unresolved"),
        (c("phone").isNotNull() & c("phone_e164").isNull(), "phone_unparsed"),
        (F.length("store_name") > 60, "name_suspiciously_long"),
        (c("store_name").rlike(r"\d+\.\d+$"), "numeric_tail"),
        (c("_repeated"), "duplicate_in_mall"),
    )
    marked = listings.withColumn("_repeated", is_repeated("chain", "mall_id", "brand_canonical", "floor_std") if repeated is None else repeated)
    return marked.withColumn("dq_flags", F.concat_ws("|", *(F.when(test, name) for test, name in flags))).drop("_repeated")


def mapping_audit(listings: DataFrame, standard: Column, group: str = "chain", category: str = "category", weight: str | None = None) -> DataFrame:
    """Listings of each raw category and the standard one it maps to; the null category is a group. A row counts once, or as often as ``weight`` says."""
    rows = listings.select(group, category, standard.alias("category_std"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("_n"))
    return rows.groupBy(group, category, "category_std").agg(F.sum("_n").alias("listings"))


def variant_review(listings: DataFrame, entity: str = "brand_key", raw: str = "store_name_raw", clean: str = "store_name", group: str = "chain", shown: int = 8) -> DataFrame:
    """Keys whose spellings deserve a look, with the first ``shown`` of them."""
    rows = listings.filter(F.col(entity) != "").groupBy(entity, raw, clean, group).agg(F.count(F.lit(1)).alias("_n"))  # spellings are far fewer than listings
    per = rows.groupBy(entity).agg(
        F.countDistinct(raw).alias("raw_variants"), F.countDistinct(clean).alias("clean_variants"), F.sum("_n").alias("listings"), F.countDistinct(group).alias("chains")
    )
    odd = per.filter((F.col("raw_variants") > 1) & ((F.col("clean_variants") > 1) | (F.col("raw_variants") >= 5)))
    first = rows.select(entity, raw).distinct().withColumn("rank", F.row_number().over(Window.partitionBy(entity).orderBy(raw))).filter(F.col("rank") <= shown)
    examples = first.groupBy(entity).agg(F.array_join(F.array_sort(F.collect_list(raw)), " | ").alias("examples"))
    return odd.join(examples, entity)


def quality_figures(listings: DataFrame, entity: str = "brand_key") -> DataFrame:
    """One row: rows, distinct keys, shares mapped and placed on a floor, flagged rows."""
    share = lambda test: F.round(F.avg(test.cast("double")), 6)
    return listings.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(entity).alias("keys"),
        share(F.col("category_std") != "unknown").alias("share_mapped"),
        share(F.col("floor_level").isNotNull()).alias("share_floor"),
        F.count_if(F.col("dq_flags") != "").alias("flagged"),
        F.count_if(F.col("category_std") == "unknown").alias("unmapped"),
    )


# --- contracts ---
def _finding(df: DataFrame, severity: str, kind: str, key: Column, detail: Column | None = None) -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), key.cast("string").alias("key"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def _key(group: str, container: str) -> Column:
    return F.concat_ws(":", group, container)


def contract_findings(properties: DataFrame, listings: DataFrame, group: str = "chain", container: str = "mall_id") -> DataFrame:
    """(severity, kind, key, detail): missing columns, repeated property keys, listings without property, properties without listing."""
    spark = properties.sparkSession
    missing = [("error", "missing_column", f"{n}.{c}", "") for n, df, cols in (("properties", properties, PROPERTY_COLUMNS), ("listings", listings, LISTING_COLUMNS)) for c in cols if c not in df.columns]
    keys = [group, container]
    out = spark.createDataFrame(missing, "severity string, kind string, key string, detail string")
    repeated = properties.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = listings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    known = properties.select(*keys).distinct()
    return (
        out.unionByName(_finding(repeated, "error", "repeated_property", _key(*keys), F.col("n")))
        .unionByName(_finding(held.join(known, keys, "left_anti"), "error", "orphan_listings", _key(*keys), F.col("n")))
        .unionByName(_finding(known.join(held, keys, "left_anti"), "warning", "no_listings", _key(*keys)))
    )


def check_contract(properties: DataFrame, listings: DataFrame) -> None:
    """Raises with the first broken rule."""
    broken = contract_findings(properties, listings).filter("severity = 'error'").orderBy("kind", "key").first()
    if broken:
        raise ValueError(f"{broken.kind}: {broken.key} {broken.detail}".strip())


def check_vocabulary(properties: DataFrame) -> None:
    """Raises where a source or precision of a coordinate is not one of the known words."""
    for column, allowed in (("geo_source", GEO_SOURCES), ("geo_precision", GEO_PRECISIONS)):
        odd = properties.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).select(column).first() if column in properties.columns else None
        if odd:
            raise ValueError(f"{column} holds {odd[0]!r}")


# --- comparisons of two snapshots ---
def counts_by_container(listings: DataFrame, group: str = "chain", container: str = "mall_id") -> DataFrame:
    return listings.groupBy(group, container).agg(F.count(F.lit(1)).alias("n"))


def snapshot_difference(previous: DataFrame, current: DataFrame, key: str = "mall_id") -> DataFrame:
    """(key, change): containers that are new or gone, by the container's id alone."""
    old, new = previous.select(key).distinct(), current.select(key).distinct()
    return new.join(old, key, "left_anti").withColumn("change", F.lit("added")).unionByName(old.join(new, key, "left_anti").withColumn("change", F.lit("gone")))


def drop_alerts(previous: DataFrame, current: DataFrame, most: float = 0.20, group: str = "chain", container: str = "mall_id") -> DataFrame:
    """Containers of both snapshots that lost more than ``most`` of their listings."""
    keys = [group, container]
    both = counts_by_container(current, *keys).join(counts_by_container(previous, *keys).withColumnRenamed("n", "before"), keys)
    change = (F.col("n") - F.col("before")) / F.col("before")
    return both.withColumn("change", F.round(change, 6)).filter(change < -most)


def drop_history(listings: DataFrame, snapshot: str, most: float = 0.20, group: str = "chain", container: str = "mall_id") -> DataFrame:
    """The same over a run of snapshots, each against the one before in which the container was listed."""
    keys = [group, container]
    counts = listings.groupBy(*keys, snapshot).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n").over(Window.partitionBy(*keys).orderBy(snapshot))
    change = (F.col("n") - F.col("before")) / F.col("before")
    return counts.withColumn("before", before).withColumn("change", F.round(change, 6)).filter(change < -most)


def key_history(rows: DataFrame, snapshot: str, keys: list[str], snapshots: DataFrame | None = None) -> DataFrame:
    """(keys, snapshot, n, before, change, first_seen, times): what happened to each key at each snapshot, in one pass over all of them.

    ``change`` is first, back, gone or kept; n is the key's rows there (0 where gone) and before those at the last snapshot that had it. A key is
    gone at the first snapshot without it, and back at the next with it. ``snapshots`` are the dates in order (those of the rows by default), a small table
    that is numbered and broadcast; everything else is grouped and ordered by key, so a key's whole history is one window.
    """
    dates = rows.select(snapshot).distinct() if snapshots is None else snapshots.select(snapshot).distinct()
    numbered = dates.filter(F.col(snapshot).isNotNull()).withColumn("_at", F.row_number().over(Window.orderBy(snapshot)))
    counts = rows.groupBy(*keys, snapshot).agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(numbered), snapshot)
    own = Window.partitionBy(*keys).orderBy("_at")
    state = counts.withColumns(
        {"before": F.lag("n").over(own), "_last": F.lag("_at").over(own), "_next": F.lead("_at").over(own), "first_seen": F.min(snapshot).over(own), "times": F.row_number().over(own)}
    )
    change = F.when(F.col("_last").isNull(), "first").when(F.col("_last") < F.col("_at") - 1, "back").otherwise("kept")
    there = state.select(*keys, "_at", "n", "before", change.alias("change"), "first_seen", "times")
    ended = state.filter(F.col("_next").isNull() | (F.col("_next") > F.col("_at") + 1))
    gone = ended.select(*keys, (F.col("_at") + 1).alias("_at"), F.lit(0).cast("long").alias("n"), F.col("n").alias("before"), F.lit("gone").alias("change"), "first_seen", "times")
    return there.unionByName(gone).join(F.broadcast(numbered), "_at").select(*keys, snapshot, "n", "before", "change", "first_seen", "times")


def history_findings(properties: DataFrame, listings: DataFrame, snapshot: str = "scraped_at", most: float = 0.20) -> DataFrame:
    """(snapshot, severity, kind, key, detail) of every snapshot against the one before it, as ``run_findings`` tells them for one pair.

    ``properties`` and ``listings`` hold all snapshots. Properties are gone or added by their id alone; drops are of containers that
    both snapshots list; counts are of every group.
    """
    tell = lambda df, severity, kind, key, detail: df.select(snapshot, F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), key.alias("key"), detail.cast("string").alias("detail"))
    dates = properties.select(snapshot).union(listings.select(snapshot)).distinct()
    first = dates.agg(F.min(snapshot)).first()[0]
    known = key_history(properties, snapshot, ["mall_id"], dates)
    held = key_history(listings, snapshot, ["chain", "mall_id"], dates)
    drops = held.filter((F.col("change") == "kept") & ((F.col("n") - F.col("before")) / F.col("before") < -most))
    groups = properties.groupBy(snapshot, "chain").agg(F.count(F.lit(1)).alias("p")).join(listings.groupBy(snapshot, "chain").agg(F.count(F.lit(1)).alias("l")), [snapshot, "chain"], "left")
    counted = F.concat_ws(" properties, ", F.col("p"), F.concat(F.coalesce("l", F.lit(0)).cast("string"), F.lit(" listings")))
    added = known.filter(F.col("change").isin("first", "back") & (F.col(snapshot) > F.lit(first)))
    return (
        tell(groups, "info", "counts", F.col("chain"), counted)
        .unionByName(tell(known.filter("change = 'gone'"), "warning", "gone", F.col("mall_id"), F.lit("")))
        .unionByName(tell(added, "info", "added", F.col("mall_id"), F.lit("")))
        .unionByName(tell(drops, "warning", "count_drop", _key("chain", "mall_id"), F.concat_ws(" -> ", F.col("before"), F.col("n"))))
    )


def capped_groups(df: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """Groups with exactly as many rows as a source is known to serve at most."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == cap)


def completeness(served: DataFrame, declared: DataFrame, keys: list[str], shortfall: float = 0.20) -> DataFrame:
    """Rows served against the number declared, with a severity: none, mismatch, alert."""
    counts = served.groupBy(*keys).agg(F.count(F.lit(1)).alias("served"))
    joined = declared.join(counts, keys, "left").withColumn("served", F.coalesce("served", F.lit(0)))
    n, d = F.col("served"), F.col("declared")
    return joined.withColumn("severity", F.when((d > 0) & ((n == 0) | (n < (1 - shortfall) * d)), "alert").when(n != d, "mismatch").otherwise("none"))


def run_findings(properties: DataFrame, listings: DataFrame, previous: tuple[DataFrame, DataFrame] | None = None, warnings: DataFrame | None = None) -> DataFrame:
    """All that a run should tell, as (severity, kind, key, detail)."""
    per = properties.groupBy("chain").agg(F.count(F.lit(1)).alias("p")).join(listings.groupBy("chain").agg(F.count(F.lit(1)).alias("l")), "chain", "left")
    out = _finding(per, "info", "counts", F.col("chain"), F.concat_ws(" properties, ", F.col("p"), F.concat(F.coalesce("l", F.lit(0)).cast("string"), F.lit(" listings"))))
    out = out.unionByName(contract_findings(properties, listings))
    if previous:
        diff = snapshot_difference(previous[0], properties)
        out = out.unionByName(_finding(diff.filter("change = 'gone'"), "warning", "gone", F.col("mall_id"))).unionByName(
            _finding(diff.filter("change = 'added'"), "info", "added", F.col("mall_id"))
        )
        drops = drop_alerts(previous[1], listings)
        out = out.unionByName(_finding(drops, "warning", "count_drop", _key("chain", "mall_id"), F.concat_ws(" -> ", F.col("before"), F.col("n"))))
    return out if warnings is None else out.unionByName(warnings)
