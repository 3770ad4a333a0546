"""Entity resolution: aliases, category votes and proposals of similar keys."""

from __future__ import annotations

import difflib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.similar import similar_candidates
from tessera.operators.tables import reach, usable
from tessera.scratch import written

GENERIC_CATEGORIES = ("unknown", "shopping")


def resolve_aliases(listings: DataFrame, aliases: DataFrame, entity: str = "brand_key", out: str = "brand_canonical") -> DataFrame:
    """``listings`` with the canonical key: one hop through (variant, canonical), or the key itself."""
    dim = aliases.select(F.col("variant").alias(entity), F.col("canonical").alias("_canonical"))
    return listings.join(dim, entity, "left").withColumn(out, F.coalesce("_canonical", entity)).drop("_canonical")


def category_votes(listings: DataFrame, entity: str = "brand_canonical", category: str = "category_std", weight: str | None = None) -> DataFrame:
    """The most frequent specific category of each entity; ties go to the lowest name. A row counts once, or as often as ``weight`` says."""
    specific = listings.filter(usable(entity) & ~F.col(category).isin(*GENERIC_CATEGORIES))
    counts = specific.groupBy(entity, category).agg(F.sum(F.col(weight) if weight else F.lit(1)).alias("_n"))
    return counts.groupBy(entity).agg(F.min_by(category, F.struct(-F.col("_n"), category)).alias("vote"))


def propagate_categories(listings: DataFrame, entity: str = "brand_canonical", category: str = "category_std", source: str = "category_source", weight: str | None = None) -> DataFrame:
    """Generic categories take the vote of their entity; ``source`` tells where each comes from.

    Where no listing has a specific category, all sources say "operator".
    """
    votes = written(category_votes(listings, entity, category, weight), "votes")
    generic = F.col(category).isin(*GENERIC_CATEGORIES)
    joined = listings.join(votes, entity, "left").crossJoin(F.broadcast(votes.agg((F.count(F.lit(1)) > 0).alias("_any"))))
    filled = F.when(generic & F.col("vote").isNotNull(), F.col("vote")).otherwise(F.col(category))
    return (
        joined.withColumns({"_filled": filled, "_given": generic & F.col("vote").isNotNull()})
        .withColumn(source, F.when(~F.col("_any"), "operator").when(F.col("_filled") == "unknown", "none").when(F.col("_given"), "propagated").otherwise("operator"))
        .withColumn(category, F.col("_filled"))
        .drop("_filled", "_given", "_any", "vote")
    )


def _matching_ratio() -> Callable[[str, str], float]:
    """What gives ``difflib.SequenceMatcher(None, a, b).ratio()``; made here, so that workers get it with the task."""

    def ratio(a: str, b: str) -> float:
        if len(b) >= 200 or not a or not b:  # from 200 on, difflib leaves frequent characters out
            return difflib.SequenceMatcher(None, a, b).ratio()
        matched, todo = 0, [(a, b)]
        while todo:
            x, y = todo.pop()
            at = size = i = 0
            while i + size < len(x):  # the longest block that both hold: the first in x, and there the first in y
                while i + size < len(x) and x[i : i + size + 1] in y:
                    at, size = i, size + 1
                i += 1
            if size:
                there = y.find(x[at : at + size])
                matched += size
                if at and there:
                    todo.append((x[:at], y[:there]))
                if at + size < len(x) and there + size < len(y):
                    todo.append((x[at + size :], y[there + size :]))
        return 2.0 * matched / (len(a) + len(b))

    return ratio


matching_ratio = _matching_ratio()


def with_ratio(pairs: DataFrame, left: str = "left", right: str = "right", out: str = "ratio") -> DataFrame:
    """``pairs`` with the sequence-matching ratio, whose value depends on the order of the two."""
    told = matching_ratio

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: [told(a, b) for a, b in zip(pdf[left], pdf[right], strict=True)]})

    from pyspark.sql.types import DoubleType, StructField, StructType

    return pairs.mapInPandas(run, StructType([*pairs.schema.fields, StructField(out, DoubleType())]))


def propose_merges(
    listings: DataFrame, aliases: DataFrame | None = None, entity: str = "brand_key", container: str = "mall_id", least_reach: int = 5, threshold: float = 0.86, apart: int = 8
) -> DataFrame:
    """Pairs of well-spread keys that look alike and that no alias has settled, with their reach and ratio."""
    wide = reach(listings, entity, container).filter(F.col("reach") >= least_reach).withColumnRenamed(entity, "text")
    pairs = similar_candidates(wide.select("text"), wide.select("text"), threshold, same=True).filter(F.abs(F.length("left") - F.length("right")) <= apart)
    if aliases is not None:
        known = aliases.select(F.least("variant", "canonical").alias("left"), F.greatest("variant", "canonical").alias("right"))
        pairs = pairs.join(known, ["left", "right"], "left_anti")
    scored = with_ratio(pairs).filter(F.col("ratio") >= threshold)
    return (
        scored.join(wide.select(F.col("text").alias("left"), F.col("reach").alias("malls")), "left")
        .join(wide.select(F.col("text").alias("right"), F.col("reach").alias("candidate_malls")), "right")
        .select(F.col("left").alias(entity), F.col("right").alias("candidate"), "malls", "candidate_malls", F.round("ratio", 3).alias("similarity"))
    )
