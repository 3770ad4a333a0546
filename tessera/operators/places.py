"""Coordinates of properties: whose they are, and how map features and geocoder results are matched to names."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import geo
from tessera.functions.text import core_tokens, match_name, usable
from tessera.operators.resolve import with_ratio
from tessera.operators.similar import similar_candidates
from tessera.scratch import written

KEYS = ["chain", "mall_id"]
ACCEPT, CERTAIN, CONTAINED = 0.90, 1.0, 0.93
TIE, TIE_KM = 0.02, 5.0


def is_operator_placed() -> Column:
    """The publisher itself gave the coordinate; that a coordinate is set does not tell."""
    return F.coalesce((F.col("geo_source") == "operator") & F.col("lat").isNotNull(), F.lit(False))


def attach_registry(properties: DataFrame, registry: DataFrame) -> DataFrame:
    """Coordinates of the registry for all properties that their operator did not place; without an entry they are cleared.

    Twice gives what once gives.
    """
    entry = registry.select(*KEYS, *(F.col(c).alias(f"_{c}") for c in ("lat", "lon", "source", "precision")))
    own = is_operator_placed()
    take = lambda c, given: F.when(own, F.col(c)).otherwise(F.col(given)).alias(c)
    new = {"lat": take("lat", "_lat"), "lon": take("lon", "_lon"), "geo_source": take("geo_source", "_source"), "geo_precision": take("geo_precision", "_precision")}
    joined = properties.join(entry, KEYS, "left")
    others = [c for c in properties.columns if c not in new]
    return joined.select(*others, *new.values()).select(*properties.columns)


def unplaced(properties: DataFrame, registry: DataFrame) -> DataFrame:
    """Properties that neither their operator nor the registry places."""
    return properties.filter(~is_operator_placed()).join(registry.select(*KEYS), KEYS, "left_anti")


def _named(properties: DataFrame, features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The properties, and the names of features in bounds, with their plain forms and distinctive words."""
    ours = properties.select(*KEYS, match_name(F.col("mall_name")).alias("ours")).withColumn("our_words", core_tokens(F.col("ours")))
    theirs = (
        features.filter(geo.in_bounds(F.col("lat"), F.col("lon")))
        .select("id", "lat", "lon", F.explode("names").alias("name"))
        .select("id", "lat", "lon", match_name(F.col("name")).alias("theirs"))
        .withColumn("their_words", core_tokens(F.col("theirs")))
    )
    return ours, theirs


def _scored_names(ours: DataFrame, theirs: DataFrame, accept: float) -> DataFrame:
    """(ours, theirs, score) of distinct names that score ``accept`` or more, as name_matches has it."""
    tasks = int(ours.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # in as many files, as names are few bytes and much work
    once = lambda df, name, words: written(df.select(name, words).repartition(tasks, name).distinct(), name)
    a, b = once(ours, "ours", "our_words"), once(theirs, "theirs", "their_words")
    pair = lambda df, score: df.select("ours", "theirs", score.cast("double").alias("score"))
    same = pair(a.join(b, F.col("ours") == F.col("theirs")), F.lit(1.0))
    words = pair(a.filter(F.size("our_words") > 0).join(b, F.col("our_words") == F.col("their_words")), F.lit(1.0))
    # containment by the rarest of our words
    df = b.select(F.explode("their_words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    each = a.filter(F.size("our_words") > 1).select("ours", "our_words", F.explode("our_words").alias("word")).join(df, "word", "left")
    rarest = each.groupBy("ours", "our_words").agg(F.min_by("word", F.struct(F.coalesce("df", F.lit(0)), "word")).alias("word"))
    held = rarest.join(b.select("theirs", "their_words", F.explode("their_words").alias("word")), "word").filter(
        (F.size(F.array_except("our_words", "their_words")) == 0) & (F.size("their_words") - F.size("our_words")).between(1, 2)
    )
    contained = pair(held, F.lit(CONTAINED))
    close = with_ratio(
        similar_candidates(a.select(F.col("ours").alias("text")), b.select(F.col("theirs").alias("text")), accept).withColumnsRenamed({"left": "ours", "right": "theirs"}),
        "ours",
        "theirs",
        "score",
    )
    return same.unionByName(words).unionByName(contained).unionByName(close).groupBy("ours", "theirs").agg(F.max("score").alias("score")).filter(F.col("score") >= accept)


def name_matches(properties: DataFrame, features: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(chain, mall_id, id, lat, lon, score) of features in bounds whose best name scores ``accept`` or more.

    Equal names and equal sets of distinctive words score 1. A feature that has all of our two words or more
    and at most two others scores at least CONTAINED. All else is the matching ratio of the two names. Each
    of these ways is a join on a key of its own, so no two tables are compared row by row. Properties and features of one name
    each match each: where many share a name, ask name_classes.
    """
    ours, theirs = _named(properties, features)
    return ours.join(_scored_names(ours, theirs, accept), "ours").join(theirs, "theirs").groupBy(*KEYS, "id").agg(F.max("score").alias("score"), F.first("lat").alias("lat"), F.first("lon").alias("lon"))


def name_classes(properties: DataFrame, features: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(part, ours, theirs, score, chain, mall_id, id): what name_matches finds, a name standing for all that have it.

    Part pair is two distinct names that match and their score, part ours a property and part theirs a feature in bounds, each of a name in some pair.
    A property matches the features of all names that its own is paired with; rows grow with names and tables, not with their copies' product.
    """
    ours, theirs = _named(properties, features)
    pairs = written(_scored_names(ours, theirs, accept), "names")
    none = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    score = F.lit(None).cast("double").alias("score")
    mine = ours.select(*KEYS, "ours").distinct().join(pairs.select("ours").distinct(), "ours", "left_semi")
    other = theirs.select("id", "theirs").distinct().join(pairs.select("theirs").distinct(), "theirs", "left_semi")
    return (
        pairs.select(F.lit("pair").alias("part"), "ours", "theirs", "score", *none(*KEYS, "id"))
        .union(mine.select(F.lit("ours"), "ours", *none("theirs"), score, *KEYS, *none("id")))
        .union(other.select(F.lit("theirs"), *none("ours"), "theirs", score, *none(*KEYS), "id"))
    )


def best_features(properties: DataFrame, matches: DataFrame, certain: float = CERTAIN) -> DataFrame:
    """(chain, mall_id, id, lat, lon, score, reason): one feature for each matched property, or why there is none.

    Features in the property's region come before all others, which need a certain name. Where one as good as
    the best lies far from it the match is ambiguous.
    """
    here = Window.partitionBy(*KEYS)
    m = matches.join(properties.select(*KEYS, "region"), KEYS).withColumn("agrees", geo.region_agrees(F.col("region"), F.col("lat"), F.col("lon")))
    m = m.withColumn("any_agrees", F.max("agrees").over(here)).withColumn("pooled", F.when(F.col("any_agrees"), F.col("agrees")).otherwise(F.col("score") >= certain))
    rank = F.struct(~F.col("pooled"), -F.col("score"), F.col("id"))
    top = F.min(F.struct(rank.alias("r"), "lat", "lon", "score", "id", "pooled")).over(here)
    m = m.withColumn("top", top)
    far = geo.distance_km(F.col("top.lat"), F.col("top.lon"), F.col("lat"), F.col("lon")) > TIE_KM
    tied = F.col("pooled") & (F.col("top.score") - F.col("score") <= TIE) & far
    one = m.groupBy(*KEYS).agg(F.first("top").alias("top"), F.max(tied).alias("ambiguous"), F.max("pooled").alias("found"))
    reason = F.when(~F.col("found"), "no match in the region").when(F.col("ambiguous"), "ambiguous").otherwise("")
    good = reason == ""
    return one.select(*KEYS, *(F.when(good, F.col(f"top.{c}")).alias(c) for c in ("id", "lat", "lon", "score")), reason.alias("reason"))


def best_named(properties: DataFrame, features: DataFrame) -> DataFrame:
    """What best_features gives for all name_matches, settled once for each name and region that properties share."""
    region = F.coalesce("region", F.lit(""))
    kinds = properties.select(region.alias("chain"), F.col("mall_name").alias("mall_id"), "mall_name", region.alias("region")).distinct()
    best = best_features(kinds, name_matches(kinds, features)).withColumnsRenamed({"chain": "_region", "mall_id": "mall_name"})
    return properties.select(*KEYS, region.alias("_region"), "mall_name").join(best, ["_region", "mall_name"]).select(*KEYS, "id", "lat", "lon", "score", "reason")


def attempts(properties: DataFrame, country: str = "Philippines") -> DataFrame:
    """(chain, mall_id, attempt, query, by_name, cap): what to ask a geocoder, best first."""
    address, name = usable(F.col("address")), F.col("mall_name")
    ask = lambda text, by_name, cap: F.struct(F.concat_ws(", ", text, F.lit(country)).alias("query"), F.lit(by_name).alias("by_name"), F.lit(cap).cast("string").alias("cap"))
    none = F.expr("cast(array() as array<struct<query:string,by_name:boolean,cap:string>>)")
    full = F.when(address.isNotNull(), F.array(ask(F.concat_ws(", ", name, address), True, None))).otherwise(none)
    alone = F.when(address.isNotNull(), F.array(ask(address, False, "address"))).otherwise(none)
    tails = F.when(address.isNotNull(), F.transform(geo.address_tails(address), lambda t: ask(t, False, "locality"))).otherwise(none)
    every = F.concat(full, F.array(ask(name, True, None)), alone, tails)
    return properties.select(*KEYS, "mall_name", "region", F.posexplode(every).alias("attempt", "a")).select(*KEYS, "mall_name", "region", "attempt", "a.*")


def accepted_results(asked: DataFrame, hits: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(chain, mall_id, lat, lon, source, precision, matched, ref): the first acceptable hit of the first attempt that has one.

    ``hits`` are landed results (query, pos, name, display_name, lat, lon, place_rank, osm_type, osm_id). A hit
    needs its name to be ours, where the name was asked for, or its place to lie in our region.
    """
    found = asked.join(hits.withColumns({"lat": F.col("lat").cast("double"), "lon": F.col("lon").cast("double")}), "query").filter(geo.in_bounds(F.col("lat"), F.col("lon")))
    found = found.withColumns({"ours": match_name(F.col("mall_name")), "theirs": match_name(F.coalesce("name", F.lit("")))})
    found = found.withColumns({"our_words": core_tokens(F.col("ours")), "their_words": core_tokens(F.col("theirs"))})
    exact = (F.col("ours") == F.col("theirs")) | ((F.size("our_words") > 0) & (F.col("our_words") == F.col("their_words")))
    within = (F.size("our_words") > 1) & (F.size(F.array_except("our_words", "their_words")) == 0) & (F.size("their_words") - F.size("our_words")).between(1, 2)
    # only names that no plain test settles are compared letter by letter
    told = found.withColumn("_good", (F.col("by_name") & (exact | within)) | geo.region_agrees(F.col("region"), F.col("lat"), F.col("lon")))
    unsettled = told.filter(~F.coalesce("_good", F.lit(False)) & F.col("by_name"))
    good = told.filter("_good").unionByName(with_ratio(unsettled, "ours", "theirs", "ratio").filter(F.col("ratio") >= accept).drop("ratio"))
    first = good.withColumn("_rank", F.row_number().over(Window.partitionBy(*KEYS).orderBy("attempt", "pos"))).filter("_rank = 1")
    return first.select(
        *KEYS,
        F.round("lat", 6).alias("lat"),
        F.round("lon", 6).alias("lon"),
        F.lit("nominatim").alias("source"),
        geo.cap_precision(geo.precision_of_rank(F.coalesce(F.col("place_rank"), F.lit(0))), F.col("cap")).alias("precision"),
        F.substring("display_name", 1, 120).alias("matched"),
        F.concat_ws("/", F.coalesce("osm_type", F.lit("?")), F.coalesce(F.col("osm_id").cast("string"), F.lit("?"))).alias("ref"),
    )


def updated_registry(registry: DataFrame, *found: DataFrame) -> DataFrame:
    """The registry with new entries in place of old ones of the same key; earlier arguments outrank later ones."""
    out = registry
    for new in reversed(found):
        out = out.join(new.select(*KEYS), KEYS, "left_anti").unionByName(new, allowMissingColumns=True)
    return out


def _substrings(text: Column, sizes: Column) -> Column:
    """All parts of a text with the lengths that ``sizes`` holds."""
    each = F.transform(sizes, lambda q: F.when(F.length(text) >= q, F.transform(F.sequence(F.lit(1), F.length(text) - q + 1), lambda i: F.substr(text, i, q))).otherwise(F.expr("cast(array() as array<string>)")))
    return F.array_distinct(F.flatten(each))


def containing(parts: DataFrame, wholes: DataFrame, gram: int = 5) -> DataFrame:
    """(part, whole) of ``text``: all pairs in which the whole holds the part; empty texts are in none.

    A part meets wholes on one of its grams only, the one that fewest wholes hold; a part shorter than ``gram`` is its own gram. So
    pairs meet by equality, and each whole spells its grams once.
    """
    parts = parts.select(F.col("text").alias("part")).filter("part <> ''").distinct()
    wholes = wholes.select(F.col("text").alias("whole")).filter("whole <> ''").distinct()
    grams = wholes.select("whole", F.explode(_substrings(F.col("whole"), F.array(*map(F.lit, range(1, gram + 1))))).alias("gram"))
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    size = F.least(F.length("part"), F.lit(gram))
    own = parts.select("part", F.explode(_substrings(F.col("part"), F.array(size))).alias("gram")).join(held, "gram", "left")
    rarest = own.groupBy("part").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    return rarest.join(grams, "gram").filter(F.contains("whole", "part")).select("part", "whole")


def reappeared(gaps: DataFrame, names: DataFrame) -> DataFrame:
    """Known gaps whose name contains a published name or stands in one, whatever the case; blank names are in none."""
    lower = lambda df, c: df.select(F.col(c), F.lower(c).alias("text")).distinct()
    gap, name = lower(gaps, "gap_name"), lower(names, "mall_name")
    inside = containing(name, gap).select(F.col("whole").alias("gap"), F.col("part").alias("name"))
    around = containing(gap, name).select(F.col("part").alias("gap"), F.col("whole").alias("name"))
    both = inside.union(around).distinct()
    return both.join(gap.withColumnRenamed("text", "gap"), "gap").join(name.withColumnRenamed("text", "name"), "name").select("gap_name", "mall_name")


def open_gaps(gaps: DataFrame, today: str) -> DataFrame:
    """Missing properties that are malls and open by ``today``; dates compare as text, so partial ones work."""
    return gaps.filter(F.col("property_type").endswith("mall") & (F.col("opened").isNull() | (F.substring("opened", 1, 10) <= today)))


def _beginnings(df: DataFrame, key: str, others: DataFrame, other: str) -> DataFrame:
    """(key, text): each key with those of its beginnings, the whole included, that are as long as one of ``others``."""
    sizes = others.agg(F.collect_set(F.length(other)).alias("_sizes"))
    fits = F.filter("_sizes", lambda n: n <= F.length(key))
    return df.crossJoin(F.broadcast(sizes)).select(key, F.explode(F.transform(fits, lambda n: F.substring(F.col(key), F.lit(1), n))).alias("text"))


def unmatched_roster(roster: DataFrame, live: DataFrame, roster_key: str = "roster_key", live_key: str = "live_key") -> DataFrame:
    """Roster rows of which no live key is a prefix or an extension; null keys match none.

    Keys meet by equality with the beginnings of the other side that are as long as one of its own keys. All three joins are
    on sorted exchanges: sizes of made texts can't be told before they are there, so none may be broadcast on a guess.
    """
    keys = roster.select(roster_key).filter(F.col(roster_key).isNotNull()).distinct()
    live = live.select(F.col(live_key).alias("live")).filter("live is not null").distinct()
    above = _beginnings(keys, roster_key, live, "live").join(live.withColumnRenamed("live", "text").hint("merge"), "text", "left_semi").select(roster_key)
    below = _beginnings(live, "live", keys, roster_key).select(F.col("text").alias(roster_key)).distinct()
    below = keys.join(below.hint("merge"), roster_key, "left_semi")
    return roster.join(above.union(below).distinct().hint("merge"), roster_key, "left_anti")


def pair_distances(points: DataFrame, group: str = "region", key: str = "mall_id", most: int = 2000) -> DataFrame:
    """(one, other, km) of every two points of a group, the lower key first; points without a place or a group are in none.

    The pairs grow with the square of a group. Points are dealt into blocks of about ``most`` of the largest group, and each two blocks meet on a key of
    their own, so no task holds more than blocks and the number of tasks grows with the pairs.
    """
    placed = points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col(group).isNotNull()).select(F.col(key).alias("key"), F.col(group).alias("group"), "lat", "lon")
    sizes = placed.groupBy("group").agg(F.count(F.lit(1)).cast("double").alias("n"))
    largest, pairs = sizes.agg(F.max("n"), F.sum(F.col("n") * F.col("n"))).first()
    blocks = max(1, math.ceil((largest or 0) / most))
    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(2 * (pairs or 0) / most**2))
    own, each = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    meet = ["group", "i", "j"]
    a = placed.withColumn("i", own).withColumn("j", each).repartition(tasks, *meet)
    b = placed.withColumn("j", own).withColumn("i", each).repartition(tasks, *meet).withColumnsRenamed({c: f"_{c}" for c in ("key", "lat", "lon")})
    met = a.join(b.hint("merge"), meet).filter(F.col("key") < F.col("_key"))
    return met.select(F.col("key").alias("one"), F.col("_key").alias("other"), geo.distance_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")).alias("km"))


def map_clusters(points: DataFrame, zoom: int) -> DataFrame:
    """Grid cells of the map at a zoom: how many points each holds, their bounds and the middle of those."""
    x, y = geo.map_cell(F.col("lat"), F.col("lon"), zoom)
    placed = points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    cells = placed.groupBy(x, y).agg(
        F.count(F.lit(1)).alias("points"),
        *(f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for n, f in (("min", F.min), ("max", F.max))),
    )
    return cells.withColumns({"lat": (F.col("min_lat") + F.col("max_lat")) / 2, "lon": (F.col("min_lon") + F.col("max_lon")) / 2})
