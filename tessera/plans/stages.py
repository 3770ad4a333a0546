"""Ingest, place, clean, report, bundle: what a user runs, one after the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import geo, text
from tessera.operators import places, quality, resolve, serving, snapshots, tables
from tessera.scratch import held, written
from tessera.sources.snapshots import STAGES, Snapshots

CLEAN_COLUMNS = (
    "chain", "mall_id", "store_name_raw", "store_name", "brand_key", "brand_canonical", "category", "category_std", "category_source", "store_format",
    "floor", "floor_std", "floor_level", "building", "phone", "phone_e164", "source", "scraped_at", "dq_flags",
)


#: The orders in which people read the written tables; a minus is for falling values.
CLEAN_ORDER = ("chain", "mall_id", "brand_key", "store_name_raw")
AUDIT_ORDER = ("category_std", "-listings", "chain", "category")
REVIEW_ORDER = ("-raw_variants", "-listings", "brand_key")
PROPERTY_ORDER = ("chain", "-listings", "mall_id")


def once_each(df: DataFrame, column: str, made: dict[str, Column]) -> DataFrame:
    """``df`` with columns made of ``column``, each computed once for each of its distinct values.

    The distinct values are written with what is made of them and joined back on plain exchanges: where they are few,
    Spark broadcasts them, and else it can split the rows of a value that many have.
    """
    values = written(df.select(column).distinct().withColumns(made), f"values_{column}").withColumnRenamed(column, "_value")
    return df.join(values, df[column].eqNullSafe(F.col("_value")), "left").drop("_value")


def enriched(listings: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Listings with standard columns beside the raw ones, and what is odd about each.

    A directory spells few names, floors and categories very often, so each distinct one is worked out once; phones are worked out where they stand. All that follows from a name and a category,
    votes included, is told from the counted pairs of the two and joined back once.
    """
    for column in ("category", "floor", "phone"):
        if column not in listings.columns:
            listings = listings.withColumn(column, F.lit(None).cast("string"))
    made = [c for c in CLEAN_COLUMNS if c in listings.columns and c not in ("chain", "mall_id", "store_name_raw", "category", "floor", "building", "phone", "source", "scraped_at")]
    raw, rows = F.col("store_name_raw"), listings.drop(*made)
    kinds = written(rows.groupBy("store_name_raw", "category").agg(F.count(F.lit(1)).alias("_n")), "kinds")
    names = once_each(kinds, "store_name_raw", {"store_name": text.clean_name(raw), "store_format": text.listing_format(raw)})
    keyed = once_each(names, "store_name", {"brand_key": text.entity_key(F.col("store_name"))})
    keyed = resolve.resolve_aliases(keyed, aliases) if aliases is not None else keyed.withColumn("brand_canonical", F.col("brand_key"))
    voted = resolve.propagate_categories(once_each(keyed, "category", {"category_std": text.category(F.col("category"))}), weight="_n").drop("_n")
    floors = once_each(rows, "floor", {"_floor": text.floor(F.col("floor"))}).withColumns({"floor_std": F.col("_floor.label"), "floor_level": F.col("_floor.level")}).drop("_floor")
    told = written(voted, "told").withColumnsRenamed({"store_name_raw": "_raw", "category": "_category"})
    own = raw.eqNullSafe(F.col("_raw")) & F.col("category").eqNullSafe(F.col("_category"))
    # repeated rows are told while rows are narrow, for that moves them all
    keyed = floors.join(told.select("_raw", "_category", "brand_canonical"), own, "left").drop("_raw", "_category")
    marked = keyed.withColumn("_twice", quality.is_repeated("chain", "mall_id", "brand_canonical", "floor_std")).drop("brand_canonical")
    # phones are nearly as many as the listings that have one, so a join would only move all rows once more
    phone = text.clean_phone(F.col("phone"))
    phones = marked.withColumns({"phone": phone, "phone_e164": text.e164(phone)})
    flagged = quality.quality_flags(phones.join(told, own, "left"), F.col("_twice"))
    return flagged.select(*(c for c in CLEAN_COLUMNS if c in flagged.columns))


def placed(properties: DataFrame, registry: DataFrame) -> DataFrame:
    """Properties with registry coordinates, and a region for those that have none yet; twice gives what once gives."""
    at = places.attach_registry(properties, registry)
    return at.withColumn("region", F.coalesce("region", geo.region_of_coordinate(F.col("lat"), F.col("lon"))))


def ingested(
    properties: DataFrame,
    listings: DataFrame,
    run_date: str,
    registry: DataFrame,
    groups: list[str] | None = None,
    previous: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Properties, listings and findings of a run over typed landed rows.

    Regions come from text first and from coordinates once placed. A run of some groups carries the other
    groups' rows forward with the date they had. A broken contract raises, and so does a group that neither the landed rows nor the
    previous run has.
    """
    if groups is not None:
        snapshots.check_groups(groups, properties.select("chain") if previous is None else properties.select("chain").union(previous[0].select("chain")))
    told = F.coalesce(F.col("region"), geo.region_of_text(F.concat_ws(" ", "mall_name", "address")))
    fresh = snapshots.stamped(properties.withColumn("region", told), run_date), snapshots.stamped(listings, run_date)
    old = previous or (None, None)
    malls, stores = (snapshots.carry_forward(o, n, groups) for o, n in zip(old, fresh, strict=True))
    malls = placed(malls, registry)
    quality.check_contract(malls, stores)
    return malls, stores, quality.run_findings(malls, stores, previous)


def resolved_places(properties: DataFrame, registry: DataFrame, features: DataFrame, hits: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The registry with what map features and landed geocoder results settle, and why other properties stay open."""
    todo = places.unplaced(properties, registry)
    best = places.best_named(todo, features)
    found = best.filter("id is not null").select(
        "chain", "mall_id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), F.lit("osm").alias("source"), F.lit("exact").alias("precision"),
        F.lit(None).cast("string").alias("matched"), F.col("id").alias("ref"),
    )
    rest = todo.join(found, ["chain", "mall_id"], "left_anti")
    news = [found]
    if hits is not None:
        news.append(places.accepted_results(places.attempts(rest), hits))
    registry = places.updated_registry(registry, *news)
    open_ = todo.join(registry.select("chain", "mall_id"), ["chain", "mall_id"], "left_anti").join(best.select("chain", "mall_id", "reason"), ["chain", "mall_id"], "left")
    return registry, open_.select("chain", "mall_id", F.coalesce(F.nullif("reason", F.lit("")), F.lit("no name match")).alias("reason"))


def report_tables(properties: DataFrame, listings: DataFrame) -> dict[str, DataFrame]:
    """brand_presence, brand_summary, unique_brands and mall_summary, told from the same links."""
    linked = written(tables.links(listings), "links")
    return {
        "brand_presence": tables.presence(listings, properties, linked=linked),
        "brand_summary": tables.entity_summary(listings, properties, linked=linked),
        "unique_brands": tables.unique_entities(listings, properties, linked=linked),
        "mall_summary": tables.container_summary(listings, properties, linked=linked),
    }


def breakdown(properties: DataFrame, listings: DataFrame, gaps: DataFrame | None = None, excluded: DataFrame | None = None) -> dict[str, DataFrame]:
    """The frames of a full report: quality, places, groups, properties, gaps and reach."""
    counted = tables.listing_counts(properties, listings)
    out = {
        "quality": quality.quality_figures(listings),
        "geo_source": tables.placed_counts(properties, "geo_source"),
        "geo_precision": tables.placed_counts(properties, "geo_precision"),
        "unplaced": properties.filter("lat is null").select("chain", "mall_id"),
        "no_region": properties.filter("region is null").select("chain", "mall_id"),
        "chains": tables.group_totals(properties, listings),
        "properties": counted.select("chain", "mall_id", "mall_name", "region", "listings"),
        "no_listings": counted.filter("listings = 0").select("chain", "mall_id"),
        "property_types": tables.count_by(properties, "property_type"),
        "reach": tables.top_entities(tables.entity_summary(listings, properties)),
        "exclusive": tables.exclusive_counts(listings, properties),
    }
    if gaps is not None:
        out |= {"known_gaps": gaps, "reappeared": places.reappeared(gaps, properties)}
    return out if excluded is None else out | {"excluded": excluded}


def clean(store: Snapshots, run_date: str, aliases: DataFrame | None = None) -> None:
    stores = store.need(run_date, STAGES[0], "stores")
    store.write(run_date, STAGES[1], "stores_clean", enriched(stores, aliases), order=CLEAN_ORDER)
    cleaned = store.need(run_date, STAGES[1], "stores_clean")
    counted = cleaned.groupBy("chain", "category").agg(F.count(F.lit(1)).alias("_n"))  # so each category is mapped once
    store.write(run_date, STAGES[1], "category_mapping", quality.mapping_audit(counted, text.category(F.col("category")), weight="_n"), order=AUDIT_ORDER)
    store.write(run_date, STAGES[1], "normalization_review", quality.variant_review(cleaned), order=REVIEW_ORDER)


def report(store: Snapshots, run_date: str) -> None:
    malls, stores = store.need(run_date, STAGES[0], "malls"), store.listings(run_date)
    for name, df in report_tables(malls, stores).items():
        store.write(run_date, STAGES[2], name, df)


def write_breakdown(store: Snapshots, run_date: str, gaps: DataFrame | None = None, excluded: DataFrame | None = None) -> None:
    """The frames of ``breakdown`` as tables of the report, properties in their order."""
    for name, df in breakdown(store.need(run_date, STAGES[0], "malls"), store.need(run_date, STAGES[1], "stores_clean"), gaps, excluded).items():
        store.write(run_date, STAGES[2], f"breakdown_{name}", df, order=PROPERTY_ORDER if name == "properties" else ())


def website(store: Snapshots, run_date: str) -> str:
    """Writes the serving tables and returns their digest."""
    malls, stores = store.need(run_date, STAGES[0], "malls"), store.need(run_date, STAGES[1], "stores_clean")
    quality.check_contract(malls, stores)
    quality.check_vocabulary(malls)
    digests = []
    for name, df in sorted(serving.bundle(malls, stores).items()):
        store.write(run_date, STAGES[3], name, df, csv=False)
        digests.append((name, serving.digest(store.need(run_date, STAGES[3], name))))
    manifest = malls.sparkSession.createDataFrame(digests, "table string, digest string")
    store.write(run_date, STAGES[3], "manifest", manifest)
    return serving.digest(manifest)


def build(store: Snapshots, run_date: str, aliases: DataFrame | None = None) -> str:
    """Clean, report, bundle, publish. What a step writes on its way goes when its tables are stored."""
    with held(store.spark):
        clean(store, run_date, aliases)
    with held(store.spark):
        report(store, run_date)
    with held(store.spark):
        digest = website(store, run_date)
    store.publish(run_date)
    return digest
