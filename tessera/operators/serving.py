"""The serving tables: coded dimensions, properties, entities and edges, and a digest of their content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import search_alias
from tessera.operators.quality import GEO_PRECISIONS, GEO_SOURCES
from tessera.operators.tables import edges, listing_counts, most_frequent, totals, usable
from tessera.scratch import written

ENTITY = "brand_canonical"
COORDINATE_DIGITS = 5
#: Bits of one word of a bitmap of groups, its sign left out.
WORD = 63


def codes(values: DataFrame, column: str, most: int = 100_000) -> DataFrame:
    """(value, code) of a small dimension in sorted order from 0; its size is checked."""
    distinct = values.select(F.col(column).alias("value")).filter(F.col(column).isNotNull()).distinct()
    if distinct.count() > most:
        raise ValueError(f"more than {most} values of {column}")
    return distinct.withColumn("code", F.row_number().over(Window.orderBy("value")) - 1)


def dense_codes(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with positions 0, 1, ... in the order of the given columns, for tables of any size.

    First pass: rows are dealt by ranges, sorted and numbered within theirs where they are and written, which settles the sampled bounds and the order of ties.
    Second pass: one count for each range of the written table tells where the range begins. Whatever is repeated later reads
    the same table, so a row keeps its code.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    own = F.col("_id")  # a task's number times 2^33, and how many rows of it went before
    ranked = written(dealt.withColumn("_id", F.monotonically_increasing_id()).withColumns({"_part": F.shiftright(own, 33), "_in": F.pmod(own, F.lit(1 << 33))}).drop("_id"), "ranges")
    sizes = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_start")
    return ranked.join(F.broadcast(starts), "_part").withColumn(out, (F.col("_start") + F.col("_in")).cast("long")).drop("_part", "_in", "_start")


def adjacency(edges: DataFrame, nodes: DataFrame, node: str, neighbour: str, distinct: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sparse rows of a graph: offsets (node, first, n), and a flat array (pos, neighbour) in the order of nodes and then neighbours.

    ``nodes`` are numbered 0, 1, ... without gaps; those without edges have n = 0 and begin where the next one does. One numbering of edges
    and nodes together, each node ahead of its own edges, gives both: as many nodes as a row's own number tells stand before it.
    Repeated edges count once; where the caller knows that there are none, ``distinct`` spares looking for them.
    """
    pairs = edges.select(F.col(node).cast("long").alias(node), F.col(neighbour).cast("long").alias(neighbour))
    marked = nodes.select(F.col(node).cast("long").alias(node), F.lit(None).cast("long").alias(neighbour)).unionByName(pairs if distinct else pairs.distinct())
    placed = dense_codes(marked, [node, neighbour], "_at")  # nulls come first; its rows are written, so whatever reads them finds the same codes
    own = placed.filter(F.col(neighbour).isNotNull())
    flat = own.select((F.col("_at") - F.col(node) - 1).alias("pos"), neighbour)
    counts = own.groupBy(node).agg(F.count(F.lit(1)).alias("n"))
    starts = placed.filter(F.col(neighbour).isNull()).select(node, (F.col("_at") - F.col(node)).alias("first"))
    return starts.join(counts, node, "left").select(node, "first", F.coalesce("n", F.lit(0)).alias("n")), flat


def coded(df: DataFrame, dim: DataFrame, column: str, out: str, missing: int = -1) -> DataFrame:
    """``df`` with the code of ``column``, ``missing`` where the dimension lacks it."""
    named = F.broadcast(dim.select(F.col("value").alias(column), F.col("code").alias(out)))
    return df.join(named, column, "left").withColumn(out, F.coalesce(out, F.lit(missing)))


def chain_mask(code: Column) -> Column:
    """Bits of the groups an entity is in; for up to WORD groups."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), code.cast("int")))


def group_bits(members: DataFrame, key: str, code: str, groups: int, out: str = "group_bits") -> DataFrame:
    """(key, bits): the groups each key is in, as an array of longs that hold WORD bits each, for any number of groups.

    Group ``code`` is bit ``code % WORD`` of word ``code div WORD``. Words are made where the rows are and gathered key by key; words
    without a group are 0, and all arrays are equally long. Negative codes are no group.
    """
    word = F.floor(F.col(code) / WORD).cast("int")
    words = members.filter(F.col(code) >= 0).groupBy(key, word.alias("_word")).agg(chain_mask(F.col(code) % WORD).alias("_bits"))
    held = words.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_held"))
    every = F.sequence(F.lit(0), F.lit(max(0, (groups - 1) // WORD)))
    return held.select(key, F.transform(every, lambda w: F.coalesce(F.try_element_at("_held", w), F.lit(0).cast("long"))).alias(out))


def has_group(bits: Column, code: int) -> Column:
    return F.call_function("getbit", F.element_at(bits, code // WORD + 1), F.lit(code % WORD)) == 1


def entity_rows(listings: DataFrame, chains: DataFrame, entity: str = ENTITY, linked: DataFrame | None = None) -> DataFrame:
    """Per entity: shown name, primary and all categories, containers, groups as bits, and a search alias.

    ``linked`` are the edges of the listings, where they are at hand.
    ``chain_bits`` holds the bits of any number of groups; ``chain_mask`` is the single word of up to WORD groups, null beyond.
    """
    groups = chains.count()
    named = listings.filter(usable(entity))
    known = F.when(F.col("category_std") != "unknown", F.col("category_std"))
    kinds = named.groupBy(entity, known.alias("_known")).agg(F.count(known).alias("_n"))  # an entity's categories, counted
    held = kinds.groupBy(entity).agg(F.min_by("_known", F.struct(-F.col("_n"), F.col("_known"))).alias("category"), F.array_sort(F.collect_set("_known")).alias("categories"))
    shown = most_frequent(named, entity, "store_name", "name").join(held, entity)
    spread = coded(edges(listings, entity) if linked is None else linked, chains, "chain", "chain_code")
    bits = group_bits(spread, entity, "chain_code", groups, "chain_bits")
    none = F.array_repeat(F.lit(0).cast("long"), max(1, -(-groups // WORD)))
    mask = F.element_at("chain_bits", 1) if groups <= WORD else F.lit(None).cast("long")
    counted = spread.groupBy(entity).agg(F.count(F.lit(1)).alias("malls")).join(bits, entity, "left")
    counted = counted.withColumn("chain_bits", F.coalesce("chain_bits", none)).withColumn("chain_mask", mask)
    return shown.join(counted, entity).withColumn("alias", search_alias(F.col(entity), F.col("name")))


def property_flags(properties: DataFrame, listings: DataFrame, caveats: dict[str, str] | None = None) -> DataFrame:
    """(chain, mall_id, flags): the group's caveat, a missing region, and categories that are all unknown."""
    keys = ["chain", "mall_id"]
    dark = listings.groupBy(*keys).agg(F.bool_and(F.col("category_std") == "unknown").alias("dark"))
    caveat = F.lit(None).cast("string")
    for chain, text in (caveats or {}).items():
        caveat = F.when(F.col("chain") == chain, text).otherwise(caveat)
    flags = F.array(caveat, F.when(F.col("region").isNull(), "region unavailable"), F.when(F.col("dark"), "categories unavailable"))
    return properties.join(dark, keys, "left").select(*keys, F.filter(flags, lambda f: f.isNotNull()).alias("flags"))


def digest(df: DataFrame) -> str:
    """Twelve hex digits that are the same for the same rows, repeats included, whatever their order.

    Four hashes of each row are added up as whole numbers beside the count, so any number of tasks combine
    their sums and none gathers rows.
    """
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)")), F.lit(0)).cast("string") for seed in range(4)]
    return df.agg(F.sha2(F.concat_ws(",", F.count(F.lit(1)).cast("string"), *sums), 256).substr(1, 12).alias("d")).first()["d"]


def coded_graph(properties: DataFrame, listings: DataFrame, entity: str = ENTITY) -> tuple[dict[str, DataFrame], DataFrame, DataFrame, DataFrame]:
    """Dimensions by name, and coded properties, entities and edges."""
    spark = properties.sparkSession
    fixed = lambda words: spark.createDataFrame([(w, i) for i, w in enumerate(words)], "value string, code int")
    kinds = properties.withColumn("property_type", F.coalesce("property_type", F.lit("mall")))
    dims = {
        "chains": codes(properties, "chain"),
        "regions": codes(properties, "region"),
        "property_types": codes(kinds, "property_type"),
        "categories": codes(listings, "category_std"),
        "geo_sources": fixed(GEO_SOURCES),
        "geo_precisions": fixed(GEO_PRECISIONS),
    }
    rows = dense_codes(listing_counts(kinds, listings), ["mall_id", "chain"], "mall_ix")
    for dim, column, missing in (("chains", "chain", -1), ("regions", "region", -1), ("property_types", "property_type", 0), ("geo_sources", "geo_source", -1), ("geo_precisions", "geo_precision", -1)):
        rows = coded(rows, dims[dim], column, f"{column}_ix", missing)
    rows = rows.withColumns({c: F.round(c, COORDINATE_DIGITS) for c in ("lat", "lon")})
    linked = written(edges(listings, entity), "linked")
    named = coded(entity_rows(listings, dims["chains"], entity, linked), dims["categories"], "category", "category_ix")
    entities = dense_codes(named, [entity], "brand_ix")
    entities, rows = written(entities, "entities"), written(rows, "properties")
    pairs = linked.join(entities.select(entity, "brand_ix"), entity).join(rows.select("chain", "mall_id", "mall_ix"), ["chain", "mall_id"])
    return dims, rows, entities, pairs.select("brand_ix", "mall_ix")


def bundle(properties: DataFrame, listings: DataFrame, entity: str = ENTITY, caveats: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Dimensions, properties, entities, edges, sparse rows of both directions and totals, all coded."""
    dims, rows, entities, pairs = coded_graph(properties, listings, entity)
    pairs = written(pairs, "edges")
    sparse = {}
    for name, nodes, node, other in (("entity", entities, "brand_ix", "mall_ix"), ("property", rows, "mall_ix", "brand_ix")):
        sparse[f"{name}_offsets"], sparse[f"{name}_neighbours"] = adjacency(pairs, nodes, node, other, distinct=True)
    return {
        **dims,
        "properties": rows.join(property_flags(properties, listings, caveats), ["chain", "mall_id"]),
        "entities": entities,
        "edges": pairs,
        **sparse,
        "totals": totals(properties.withColumn("property_type", F.coalesce("property_type", F.lit("mall"))), listings, entity),
    }
