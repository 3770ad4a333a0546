"""Near duplicates: SimHash fingerprints that meet in the middle of their Hamming balls."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import passing_tables, written
from tessera.llm.components import connected_components

BITS = 64
#: Shingles whose bits are counted at once, so that one text of any length needs bounded memory.
CHUNK = 1 << 16
#: Three runs of bits; of three differing bits at least one lies in the run with most of them.
RUNS = (range(0, 21), range(21, 43), range(43, 64))


def shingle_hashes(text: bytes, words: int, seed: int) -> Iterator[np.ndarray]:
    """The XXH64 of every shingle of ``words`` words, in parts; of the whole sequence where there are fewer words."""
    found = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks only
    size = min(words, len(found))
    n = len(found) - size + 1 if found else 0
    for at in range(0, n, CHUNK):
        yield np.array([xxhash.xxh64_intdigest(b" ".join(found[i : i + size]), seed) for i in range(at, min(n, at + CHUNK))], "<u8")


def majority(parts: Iterable[np.ndarray]) -> int:
    """The fingerprint of a text: bits that more than half of its hashes have; 0 where there is none."""
    n, ones = 0, np.zeros(BITS, np.int64)
    for hashes in parts:
        n += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: bytes, words: int, seed: int) -> int:
    return majority(shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for each row, fp as a signed long; null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t or b"", words, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _flips(bits: list[int], most: int) -> list[int]:
    """Every change of up to ``most`` of ``bits``, as a signed 64-bit mask."""
    masks = [sum(1 << b for b in chosen) for n in range(most + 1) for chosen in combinations(bits, n)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _with_partner(fps: DataFrame) -> DataFrame:
    """Those fingerprints that may have another within three bits; none with such a partner is missing.

    One of three runs of bits holds a third of the differences or more. Without that run at most two are
    left, so the balls of radius one about what is left meet: 132 variants each. Fingerprints are distinct,
    so those that share a variant differ in one run and two more bits at most, whatever the corpus holds.
    """
    pairs = []
    for run in RUNS:
        rest = [b for b in range(BITS) if b not in run]
        pairs += [(_signed(sum(1 << b for b in rest)), flip) for flip in _flips(rest, 1)]
    variants = F.explode(F.array(*(F.struct(F.lit(m).alias("m"), F.lit(x).alias("x")) for m, x in pairs)))
    keyed = fps.select("fp", variants.alias("v")).select("fp", F.col("fp").bitwiseAND(F.col("v.m")).bitwiseXOR(F.col("v.x")).alias("key"))
    here = Window.partitionBy("key")
    return (
        keyed.select("fp", F.min("fp").over(here).alias("low"), F.max("fp").over(here).alias("high"))
        .filter(F.col("low") < F.col("high"))
        .select("fp")
        .distinct()
    )


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all pairs within ``radius`` bits.

    Every fingerprint emits its ball of radius ``radius // 2`` and, of two that differ in parity, the odd one
    also the shell beyond it. Those that share a variant and are in its inner ball lie within ``radius`` of
    all others there, so each links to the least of them: as many rows as members, never all pairs. A variant
    has at most the 2,081 distinct fingerprints within two bits of it, so none is hot.
    """
    if not 1 <= radius <= 3:
        raise ValueError("radius must be 1, 2 or 3")
    near = written(_with_partner(fps), "partners")
    inner, outer = radius // 2, radius - radius // 2
    small = _flips(list(range(BITS)), inner)
    large = _flips(list(range(BITS)), outer)[len(small) :] if radius % 2 else []
    odd = near.filter(F.bit_count("fp") % 2 == 1)
    emit = lambda df, flips, core: df.select("fp", F.lit(core).alias("core"), F.explode(F.array(*map(F.lit, flips))).alias("x"))
    balls = emit(near, small, True)
    if large:
        balls = balls.unionByName(emit(odd, large, False))
    here = Window.partitionBy("key")
    hubs = balls.select("fp", "core", F.col("fp").bitwiseXOR(F.col("x")).alias("key")).select(
        "fp", F.min(F.when(F.col("core"), F.col("fp"))).over(here).alias("hub")
    )
    return (
        hubs.filter(F.col("hub") != F.col("fp"))
        .select(F.col("fp").alias("a"), F.col("hub").alias("b"))
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3, seed: int = 42, similarity: float | None = None
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest doc_id that links
    reach, the row's own included. Only distinct fingerprints are compared, so copies of a text cost one
    row. With ``similarity``, texts link where the Jaccard similarity of their shingle sets is that or more:
    links of fingerprints are verified, and those beyond the radius completed exactly (see similar.py). Null
    and empty texts have fingerprint zero and link like any other. Repeated rows stay repeated; a null id
    never becomes a component's id unless it is alone. Other columns are ignored. An empty table gives an
    empty result.
    """
    if similarity is not None:
        from tessera.llm.similar import placed, similar_rows

        return similar_rows(placed(docs, id_col, text_col), text_col, words, radius, seed, similarity).select("doc_id", spelled("fp"), F.col("first.doc_id").alias("component_id"))
    prints = written(fingerprints(docs, id_col, text_col, words, seed), "prints")
    groups = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "groups")
    roots = connected_components(links(groups.select("fp"), radius)).withColumnRenamed("id", "fp")
    member = written(groups.join(roots, "fp"), "members")
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    joined = member.join(least, "root").select("fp", "component_id")
    known = written(groups.join(joined, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "components")
    return prints.join(known, "fp").select("doc_id", spelled("fp"), "component_id")


def spelled(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0").alias("fingerprint")


def without_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns, less those that another row of their group of near duplicates stands for.

    Groups are those of near_duplicates with ``similarity``. The row with the smallest id stays, of several with
    that id the one whose text hashes least; null ids come last. Rows that repeat both id and text are told
    apart by nothing and stay together. Null and empty texts form one group. An empty table stays empty.
    """
    from tessera.llm.similar import PLACE, at_place, placed, similar_rows

    with passing_tables(docs.sparkSession):
        rows = placed(docs, id_col, text_col)
        marked = similar_rows(rows, text_col, words, radius, seed, similarity)
        surplus = marked.filter(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))))
        surplus = written(surplus.select(*at_place("doc_id", "key")).distinct(), "surplus", keep=True)
    return rows.join(surplus.hint("shuffle_hash"), PLACE, "left_anti").select("row.*")
