"""Faceted exploration: filters, leave-one-out counts, reach and map points.

Within a facet selected values are alternatives; facets all have to hold. An entity passes if a single property
meets all property facets together.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Filters:
    query: str = ""
    chain: frozenset = field(default_factory=frozenset)
    region: frozenset = field(default_factory=frozenset)
    category: frozenset = field(default_factory=frozenset)
    malls_only: bool = False
    focus: str | None = None


KEYS = ["chain", "mall_id"]


def _in(column: str, values: frozenset) -> Column:
    return F.coalesce(F.col(column).isin(*sorted(values)), F.lit(False)) if values else F.lit(True)


def property_test(f: Filters) -> Column:
    """Chain, region and kind of one property."""
    kind = (F.col("property_type") == "mall") if f.malls_only else F.lit(True)
    return _in("chain", f.chain) & _in("region", f.region) & kind


class Explorer:
    """Queries over properties (with listings), entities (with categories) and edges (entity, chain, mall_id)."""

    def __init__(self, properties: DataFrame, entities: DataFrame, edges: DataFrame, entity: str = "brand_canonical"):
        self.entity, self.properties, self.edges = entity, properties, edges
        self.entities = entities.withColumn("_search", F.lower(F.concat_ws(" ", "name", "alias")))
        self.at = edges.join(properties.select(*KEYS, "region", "property_type", "listings"), KEYS)

    def _entity_test(self, f: Filters) -> Column:
        query = F.contains("_search", F.lit(f.query.lower())) if f.query else F.lit(True)
        cats = F.arrays_overlap("categories", F.array(*map(F.lit, sorted(f.category)))) if f.category else F.lit(True)
        return query & cats

    def scope(self, f: Filters) -> DataFrame:
        """Properties that the property facets leave; text and categories don't narrow it."""
        return self.properties.filter(property_test(f))

    def entity_results(self, f: Filters) -> DataFrame:
        """Entities that pass with the number of their properties in scope and their share of it, most spread first."""
        spread = self.at.filter(property_test(f)).groupBy(self.entity).agg(F.count(F.lit(1)).alias("in_scope"))
        bare = not (f.chain or f.region or f.malls_only)
        rows = self.entities.filter(self._entity_test(f)).join(spread, self.entity, "left" if bare else "inner")
        total = self.scope(f).agg(F.count(F.lit(1)).alias("_scope"))
        n = F.coalesce("in_scope", F.lit(0))
        share = F.when(F.col("_scope") > 0, F.floor(100 * n / F.col("_scope") + 0.5))
        return rows.crossJoin(F.broadcast(total)).select(self.entity, "name", n.alias("in_scope"), share.alias("share")).orderBy(F.desc("in_scope"), "name", self.entity)

    def property_results(self, f: Filters) -> DataFrame:
        """Properties that pass all facets, carry the focused entity and one of a selected category; most listings first."""
        rows = self.scope(f)
        if f.query:
            rows = rows.filter(F.contains(F.lower("mall_name"), F.lit(f.query.lower())))
        if f.focus is not None:
            rows = rows.join(self.edges.filter(F.col(self.entity) == f.focus).select(*KEYS), KEYS, "left_semi")
        if f.category:
            wanted = self.entities.filter(self._entity_test(replace(f, query=""))).select(self.entity)
            rows = rows.join(self.edges.join(wanted, self.entity, "left_semi").select(*KEYS), KEYS, "left_semi")
        return rows.orderBy(F.desc("listings"), "mall_name", *KEYS)

    def _with_all(self, counts: DataFrame, facet: str) -> DataFrame:
        """Every value of the facet, 0 where selecting it would give nothing."""
        values = self.entities.select(F.explode("categories").alias("value")) if facet == "category" else self.properties.select(F.col(facet).alias("value"))
        return values.filter("value is not null").distinct().join(counts, "value", "left").select(F.lit(facet).alias("facet"), "value", F.coalesce("n", F.lit(0)).alias("n"))

    def entity_facet(self, f: Filters, facet: str) -> DataFrame:
        """Entities for each value of a facet with all other facets in force; an entity counts once for a value."""
        free = replace(f, **{facet: frozenset()})
        passing = self.entities.filter(self._entity_test(free))
        at = self.at.filter(property_test(free))
        if facet == "category":
            if free.chain or free.region or free.malls_only:
                passing = passing.join(at.select(self.entity), self.entity, "left_semi")
            counts = passing.select(F.explode("categories").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        else:
            counts = at.join(passing.select(self.entity), self.entity, "left_semi").groupBy(F.col(facet).alias("value")).agg(F.countDistinct(self.entity).alias("n"))
        return self._with_all(counts, facet)

    def property_facet(self, f: Filters, facet: str) -> DataFrame:
        """Properties for each value of a facet with all other property facets in force.

        Categories count pairs of property and entity, and selected categories narrow nothing here.
        """
        free = replace(f, category=frozenset(), **({facet: frozenset()} if facet != "category" else {}))
        rows = self.property_results(free)
        if facet == "category":
            at = self.edges.join(rows.select(*KEYS), KEYS, "left_semi").join(self.entities.select(self.entity, "categories"), self.entity)
            counts = at.select(F.explode("categories").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        else:
            counts = rows.groupBy(F.col(facet).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        return self._with_all(counts, facet)

    def facets(self, f: Filters, view: str = "entities") -> DataFrame:
        count = self.entity_facet if view == "entities" else self.property_facet
        return count(f, "chain").unionByName(count(f, "region")).unionByName(count(f, "category"))

    def scope_stats(self, f: Filters) -> DataFrame:
        """One row: properties in scope, malls among them, their listings and distinct entities."""
        scope = self.scope(f)
        p = scope.agg(F.count(F.lit(1)).alias("properties"), F.count_if(F.col("property_type") == "mall").alias("malls"), F.coalesce(F.sum("listings"), F.lit(0)).alias("listings"))
        return p.crossJoin(self.edges.join(scope.select(*KEYS), KEYS, "left_semi").agg(F.countDistinct(self.entity).alias("brands")))

    def search_bridge(self, query: str, scan: int = 60, k: int = 4) -> DataFrame:
        """Entities that a property search also finds: of the first ``scan`` by key, the ``k`` most spread."""
        hits = self.entities.filter(F.contains("_search", F.lit(query.lower()))).orderBy(self.entity).limit(scan)
        return hits.orderBy(F.desc("malls"), self.entity).limit(k).select(self.entity, "name", "malls")

    def map_points(self, f: Filters) -> tuple[DataFrame, DataFrame]:
        """Passing properties that have a coordinate, and one row with the number of those that have none."""
        rows = self.property_results(f)
        return rows.filter(F.col("lat").isNotNull()), rows.agg(F.count_if(F.col("lat").isNull()).alias("unplaced"))
