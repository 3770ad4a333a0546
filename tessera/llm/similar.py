"""Exact links of the SimHash operator where it is asked for a similarity of shingle sets.

Two texts that share four fifths of their shingles differ in some ten bits of 64, beyond any ball that can be hashed. So
fingerprints link what lies close, each set also meets the hub of every rare shingle it has, those links are verified
on the sets themselves, and a prefix-filter join finds the similar pairs between groups that these left apart. No similar pair is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import bucketed, hold_nothing, written
from tessera.llm.components import connected_components
from tessera.llm.simhash import links, majority, shingle_hashes

#: Documents whose shingles tell which are common, and the most that are kept; they set an order only, never a result.
SAMPLE, COMMON = 20_000, 200_000


def text_key(text: Column) -> Column:
    """A hash that tells texts apart; null is not the empty text here, though both have no shingle."""
    return F.xxhash64(text.cast("binary"))


#: What tells rows apart, without nulls, so that a join on it is one on plain columns.
PLACE = ["own_id", "no_id", "own_key"]


def placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` as the struct ``row``, in buckets of PLACE: texts are shuffled here and nowhere else.

    Copies of a text have ids of their own, so no bucket is hot; only rows that repeat both id and text share one.
    """
    own = F.col(id_col).cast("long")
    rows = docs.select(F.coalesce(own, F.lit(0)).alias("own_id"), own.isNull().alias("no_id"), text_key(F.col(text_col)).alias("own_key"), F.struct(*docs.columns).alias("row"))
    return bucketed(rows, PLACE, "rows", keep=True)


def at_place(doc_id: str, key: str) -> list[Column]:
    """PLACE of a row whose id and text key are these columns."""
    return [F.coalesce(doc_id, F.lit(0)).alias("own_id"), F.col(doc_id).isNull().alias("no_id"), F.col(key).alias("own_key")]


def _set(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, "<u8"), *parts]).view("<i8"))


def shingles(text: bytes, words: int, seed: int) -> np.ndarray:
    """Sorted distinct hashes of every shingle."""
    return _set(list(shingle_hashes(text, words, seed)))


def _common(rows: DataFrame, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of some 20,000 documents have, sorted, and in how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        for batch in batches:
            own = [shingles(t or b"", words, seed) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *own]))], names=["shingle"])

    share = int(min(1.0, SAMPLE / max(1, rows.count())) * (1 << 20))
    some = rows.filter(F.pmod("key", F.lit(1 << 20)) < share).select("text")
    seen = some.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2)
    found = sorted((r["shingle"], r["n"]) for r in seen.orderBy(F.desc("n"), "shingle").limit(COMMON).collect())
    return np.array([s for s, _ in found], np.int64), np.array([n for _, n in found], np.int64)


def _sets(rows: DataFrame, words: int, seed: int, share: Fraction) -> DataFrame:
    """(doc_id, key, fp, set, size, prefix): prefix lists the rarest shingles, one of which any similar set has in its own."""
    common, often = _common(rows, words, seed)

    def prefix(own: np.ndarray) -> np.ndarray:
        rank = np.zeros(len(own), np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, own), len(common) - 1)
            rank = np.where(common[at] == own, often[at], 0)
        return own[np.lexsort((own, rank))][: len(own) + 1 - _least(share, len(own))] if len(own) else own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        for batch in batches:
            parts = [list(shingle_hashes(t or b"", words, seed)) for t in batch.column(2).to_pylist()]
            sets = [_set(p) for p in parts]
            ids = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(map(majority, parts), pa.int64()), pa.array(ids, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array([prefix(s) for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "key", "fp", "digest", "size", "prefix"],
            )

    return rows.mapInArrow(run, "doc_id long, key long, fp long, digest binary, size long, prefix array<long>")


def _least(share: Fraction, size: int) -> int:
    """The least whole number that is ``share`` of ``size`` or more."""
    return -(-share.numerator * size // share.denominator)


def _close(groups: DataFrame, radius: int) -> DataFrame:
    """(a, b): sets whose fingerprints meet, each with the least of its own fingerprint and those with one another."""
    hubs = written(groups.groupBy("fp").agg(F.min("set").alias("hub")), "hubs")
    own = groups.select("fp", "set").join(hubs, "fp").filter(F.col("set") != F.col("hub")).select(F.col("set").alias("a"), F.col("hub").alias("b"))
    met = links(hubs.select("fp"), radius)
    end = lambda s: hubs.select(F.col("fp").alias(s), F.col("hub").alias(f"hub_{s}"))
    return own.unionByName(met.join(end("a"), "a").join(end("b"), "b").select(F.col("hub_a").alias("a"), F.col("hub_b").alias("b")))


def _entries(groups: DataFrame) -> DataFrame:
    """(set, size, rest, known, at, shingle): the prefixes' shingles that several sets have, each at its place in the prefix.

    rest is how much of the set lies beyond its prefix, known how many such shingles it has: of a group of
    near copies the text that the others were edited from has the most.
    """
    all_ = groups.select("set", F.posexplode("prefix").alias("at", "shingle"))
    several = all_.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("shingle")
    shared = written(all_.join(several, "shingle", "left_semi"), "shared")
    sizes = groups.select("set", "size", (F.col("size") - F.size("prefix")).alias("rest"))
    about = shared.groupBy("set").agg(F.count(F.lit(1)).alias("known")).join(sizes, "set")
    return written(shared.join(about, "set").select("set", "size", "rest", "known", "at", "shingle"), "entries")


def _need(share: Fraction) -> Column:
    """How many shingles two prefixes must share if their sets are similar, times the sum of the share's parts.

    Two prefixes share a shingle if their sets are similar, since both list shingles in one order. Of all
    shared shingles, those outside both prefixes' common part lie beyond the prefix that ends first.
    """
    up, both = F.lit(share.numerator), F.lit(share.numerator + share.denominator)
    return (F.col("n_a") + F.col("n_b")) * up - F.greatest("rest_a", "rest_b") * both


def _sizes(share: Fraction) -> Column:
    up, down = F.lit(share.numerator), F.lit(share.denominator)
    return (F.col("n_a") * down >= F.col("n_b") * up) & (F.col("n_b") * down >= F.col("n_a") * up)


def _sharing(sides: DataFrame, share: Fraction) -> DataFrame:
    """(a, b): those whose rows, one for each shared shingle of their prefixes, are as many as similar sets have.

    Pairs of which either set has fewer known shingles than that, or whose sizes are too far apart, go at the join.
    """
    both = F.lit(share.numerator + share.denominator)
    may = _sizes(share) & (F.least("known_a", "known_b") * both >= _need(share))
    counted = sides.filter(may).groupBy("a", "b", _need(share).alias("need")).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") * both >= F.col("need")).select("a", "b")


def _side(entries: DataFrame, name: str) -> DataFrame:
    return entries.withColumnsRenamed({c: f"{'n' if c == 'size' else c}_{name}" for c in ("size", "rest", "known", "near", "left")} | {"set": name})


def _stars(entries: DataFrame, share: Fraction) -> DataFrame:
    """(a, b): sets with the hub of a shingle they share, where the two may be similar; a row an entry at most.

    The hub is the set with most known shingles. A large group of near copies is joined by these alone, so
    its pairs need no listing.
    """
    hubs = entries.groupBy("shingle").agg(F.max(F.struct("known", "set", "size", "rest")).alias("hub")).select("shingle", "hub.*")
    return _sharing(_side(entries, "a").join(_side(hubs, "b"), "shingle").filter(F.col("a") != F.col("b")), share)


def _apart(entries: DataFrame, near: DataFrame, share: Fraction) -> DataFrame:
    """(a, b): pairs of sets of different ``near`` that may be similar; none that is similar is missing.

    A pair is met at the first shingle that both prefixes have, and from there on each of them must still have as
    many as the two need to share. So a set on the edge of a large group of near copies, whose every known
    shingle would have to be shared, meets others at its rarest one only, and not at each that the group has.
    """
    placed = written(entries.join(near, "set", "left").withColumn("near", F.coalesce("near", "set")), "placed")
    mixed = placed.groupBy("shingle").agg(F.min("near").alias("low"), F.max("near").alias("high")).filter(F.col("low") < F.col("high")).select("shingle")
    onward = Window.partitionBy("set").orderBy(F.desc("at"))  # over one text's own shingles
    rows = placed.join(mixed, "shingle", "left_semi").withColumn("left", F.row_number().over(onward))
    rows = written(rows.select("set", "size", "rest", "near", "left", "shingle"), "mixed")
    both = F.lit(share.numerator + share.denominator)
    other = (F.col("a") < F.col("b")) & (F.col("near_a") != F.col("near_b"))
    may = other & _sizes(share) & (F.least("left_a", "left_b") * both >= _need(share))
    met = _side(rows, "a").join(_side(rows, "b"), "shingle").filter(may).select("a", "b", _need(share).alias("need")).distinct()
    own = rows.groupBy("set").agg(F.collect_list("shingle").alias("own"))
    counted = written(met, "met").join(own.withColumnsRenamed({"set": "a", "own": "own_a"}), "a").join(own.withColumnsRenamed({"set": "b", "own": "own_b"}), "b")
    return counted.filter(F.size(F.array_intersect("own_a", "own_b")) * both >= F.col("need")).select("a", "b")


def _verified(rows: DataFrame, groups: DataFrame, candidates: DataFrame, words: int, seed: int, share: Fraction) -> DataFrame:
    """Those pairs (a, b) whose Jaccard similarity is ``share`` or more, counted over all shingles of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        for batch in batches:
            sets = [shingles(t or b"", words, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["set", "all"])

    pairs = written(candidates, "candidates")
    ends = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
    wanted = written(groups.join(ends, "set", "left_semi").select(*at_place("first.doc_id", "key"), "set"), "wanted")
    texts = rows.join(wanted.hint("shuffle_hash"), PLACE).select("set", "text").mapInArrow(run, "set long, all array<long>")
    full = written(texts.groupBy("set").agg(F.any_value("all").alias("all")), "full")
    both = pairs.join(full.withColumnsRenamed({"set": "a", "all": "all_a"}), "a").join(full.withColumnsRenamed({"set": "b", "all": "all_b"}), "b")
    shared = F.size(F.array_intersect("all_a", "all_b"))
    return written(both.filter(shared * share.denominator >= (F.size("all_a") + F.size("all_b") - shared) * share.numerator).select("a", "b"), "links")


def similar_rows(docs: DataFrame, text_col: str, words: int, radius: int, seed: int, similarity: float) -> DataFrame:
    """(doc_id, key, fp, first) for each row of ``docs``, which are those of placed; first is the struct (doc_id, key) of its component's first row.

    Texts link where the Jaccard similarity of their sets of ``words``-word shingles is ``similarity`` or more; no
    such pair is missed and none below it links. Sets are told apart by 128-bit digests and their sizes, and numbered. Pairs within a group that verified links of fingerprints and of
    stars already join are never listed. First is the row of the smallest id, null ids last, then of the least key.
    """
    share = Fraction(str(similarity))
    if not 0 < share <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    rows = docs.select(*PLACE, F.col("row").getField(text_col).cast("binary").alias("text"))
    named = rows.select(F.when(~F.col("no_id"), F.col("own_id")).alias("doc_id"), F.col("own_key").alias("key"), "text")
    sets = written(_sets(named, words, seed, share), "sets")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    grouped = sets.groupBy("digest", "size").agg(F.min(order).alias("first"), F.min_by(F.struct("key", "fp", "prefix"), order).alias("one"))
    groups = written(grouped.select(F.monotonically_increasing_id().alias("set"), "digest", "size", "first", "one.*"), "groups")  # numbered once for all
    entries = _entries(groups)
    close = _close(groups, radius).unionByName(_stars(entries, share)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tight = _verified(rows, groups, close, words, seed, share)
    near = connected_components(tight).select(F.col("id").alias("set"), F.col("root").alias("near"))
    both = tight.unionByName(_verified(rows, groups, _apart(entries, near, share), words, seed, share))
    member = written(groups.select("set", "first").join(connected_components(both).withColumnRenamed("id", "set"), "set"), "members")
    joined = member.join(member.groupBy("root").agg(F.min("first").alias("least")), "root").select("set", "least")
    known = written(groups.join(joined, "set", "left").select("digest", "size", F.coalesce("least", "first").alias("first")), "components")
    return sets.select("doc_id", "key", "fp", "digest", "size").join(known, ["digest", "size"]).select("doc_id", "key", "fp", F.struct("first.doc_id", "first.key").alias("first"))
