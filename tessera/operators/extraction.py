"""Records out of landed JSON and HTML, by specifications that name patterns and not pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window


def page_records(pages: DataFrame, item: str, fields: dict[str, str], html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """A row for each match of ``item`` in a page, in page order (pos), with a column for each field's first group.

    A field that does not match is null. Patterns see one item's text each.
    """
    items = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(item), F.lit(0))).alias("pos", "item"))
    return items.select(*keep, "pos", *(F.nullif(F.regexp_extract("item", p, 1), F.lit("")).alias(n) for n, p in fields.items()))


def json_rows(landed: DataFrame, schema: StructType | str, path: str, raw: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each element of the array at ``path``; payloads of another shape give none."""
    parsed = landed.select(*keep, F.from_json(raw, schema).alias("_doc"))
    return parsed.select(*keep, F.posexplode(F.col(f"_doc.{path}")).alias("pos", "row")).select(*keep, "pos", "row.*")


def bad_records(landed: DataFrame, schema: StructType | str, path: str, raw: str = "value", key: str = "page") -> DataFrame:
    """Findings of payloads that don't parse, or that hold no row; the others proceed."""
    rows = F.col(f"_doc.{path}")
    parsed = landed.withColumn("_doc", F.from_json(raw, schema))
    kind = F.when(F.col("_doc").isNull() | rows.isNull(), "unparsed").when(F.size(rows) == 0, "no_rows")
    return parsed.select(F.lit("warning").alias("severity"), kind.alias("kind"), F.col(key).cast("string").alias("key"), F.lit("").alias("detail")).filter("kind is not null")


def embedded_json(pages: DataFrame, attribute: str, schema: StructType | str, html: str = "html") -> DataFrame:
    """``pages`` with the JSON that an HTML attribute holds, as the column doc."""
    from tessera.functions.text import unescape

    return pages.withColumn("doc", F.from_json(unescape(F.regexp_extract(html, rf'{attribute}="([^"]*)"', 1)), schema))


def unnested(df: DataFrame, *levels: str) -> DataFrame:
    """Arrays opened one below the other: each level's element becomes a column of the level's last name."""
    for level in levels:
        df = df.withColumn(level.rpartition(".")[2], F.explode(level))
    return df


def filled_down(df: DataFrame, is_header: Column, value: Column, page: str = "page_id", pos: str = "pos", out: str = "section") -> DataFrame:
    """Rows that are no header, each with the value of the last header before it on its page."""
    before = Window.partitionBy(page).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    filled = df.withColumn(out, F.last(F.when(is_header, value), ignorenulls=True).over(before))
    return filled.filter(~F.coalesce(is_header, F.lit(False)))


def assembled(lines: DataFrame, page: str = "page_id", pos: str = "pos", marker: str = "📍", most_name: int = 60, most_section: int = 30) -> DataFrame:
    """Listings out of lines of (tag, text): headings, names, "name | marker floor" rows and words that finish a floor.

    A heading of at most ``most_section`` characters is the section of what follows. A marker row is a listing,
    whose name is its own or the name line just before; floor words right after it belong to it. Rows before a
    section, of opening hours, or whose floor is an address are dropped.
    """
    line = Window.partitionBy(page).orderBy(pos)
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    text = F.trim(F.regexp_replace("text", r"(?U)\s+", " "))
    heading = F.col("tag").isin("h2", "h3")
    marked = ~heading & F.contains("text", F.lit(marker))
    more = ~heading & ~marked & F.col("text").rlike(r"(?i)^(?:floor|level|bldg\.?|building|\d+f?)$")
    strip = lambda c: F.nullif(F.regexp_replace(c, r"^[ |]+|[ |]+$", ""), F.lit(""))
    df = lines.withColumn("text", text).filter(F.col("text") != "").withColumns({"_head": heading, "_mark": marked, "_more": more})
    df = df.withColumn("_section", F.last(F.when(F.col("_head") & (F.length("text") <= most_section), F.lower("text")), ignorenulls=True).over(upto))
    df = df.withColumns({"_name": strip(F.substring_index("text", marker, 1)), "_floor": strip(F.element_at(F.split("text", marker, 2), -1))})
    plain = ~F.col("_head") & ~F.col("_mark") & (F.length("text") <= most_name)
    df = df.withColumn("_pending", F.when(F.lag(plain).over(line), F.lag("text").over(line)))
    junk = F.col("_section").isNull() | (F.col("_section") == "mall hours") | F.coalesce(F.contains("_floor", F.lit(",")) & (F.length("_floor") > 35), F.lit(False))
    name = F.coalesce("_name", "_pending")
    df = df.withColumn("_row", F.col("_mark") & name.isNotNull() & ~junk).withColumn("_store", F.when(F.col("_row"), name))
    df = df.withColumn("_run", F.sum((F.col("_mark") | F.col("_head") | (plain & ~F.col("_more"))).cast("int")).over(upto))
    runs = df.groupBy(page, "_run").agg(
        F.min(F.when(F.col("_row"), F.col(pos))).alias(pos),
        F.max("_store").alias("store_name_raw"),
        F.max(F.when(F.col("_row"), F.col("_section"))).alias("category"),
        F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_row") | F.col("_more"), F.struct(F.col(pos).alias("p"), F.when(F.col("_row"), F.col("_floor")).otherwise(F.col("text")).alias("t"))))), lambda s: s["t"]), " "), F.lit("")).alias("floor"),
    )
    return runs.filter(F.col("store_name_raw").isNotNull()).select(page, pos, "store_name_raw", "category", "floor")


def labelled(df: DataFrame, labels: DataFrame, key: str, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """``df`` with the label of its foreign key, and the keys that have none."""
    return df.join(labels, key, "left"), df.filter(F.col(key).isNotNull()).select(key).distinct().join(labels, key, "left_anti")


def bridged(df: DataFrame, references: str, targets: DataFrame, key: str) -> DataFrame:
    """A row for each target that an array of references names."""
    return df.withColumn(key, F.explode(references)).join(targets, key)


def map_features(elements: DataFrame, names: tuple[str, ...] = ("name", "name:en", "alt_name", "official_name", "short_name")) -> DataFrame:
    """(id, names, lat, lon) of map elements: the node's own place or else its centre; without place or name they go."""
    node = F.col("type") == "node"
    lat, lon = (F.when(node, F.col(c)).otherwise(F.col(f"center.{c}")).cast("double") for c in ("lat", "lon"))
    given = F.filter(F.array(*(F.try_element_at("tags", F.lit(n)) for n in names)), lambda n: F.coalesce(n, F.lit("")) != "")
    out = elements.select(F.concat_ws("/", "type", F.col("id").cast("string")).alias("id"), given.alias("names"), lat.alias("lat"), lon.alias("lon"))
    return out.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.size("names") > 0))


def is_junk(name: Column, floor: Column | None = None, pattern: str = r"(?i)\b(?:rates?|notice|advisory|per hour|php)\b") -> Column:
    """Blank names, prose about rates and notices, and addresses in the place of a floor."""
    out = name.isNull() | (F.trim(name) == "") | name.rlike(pattern)
    return out if floor is None else out | F.coalesce(F.contains(floor, F.lit(",")) & (F.length(floor) > 35), F.lit(False))
