"""How the sources of a language differ in their words: joint tables of count levels by one-hot matrix products."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import written

#: A-Z in lower case, all other ASCII characters but a-z blank; bytes of other characters stay.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: Bytes of a text split at once, and cells that a task counts before it hands them on.
PIECE, CELLS = 1 << 22, 400_000
#: Terms whose products are taken at once: alike in frequency, so they share levels.
TERMS = 64


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces."""
    plain, at = text.translate(TERM_BYTES), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split(b" ")
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term), as far as one task has seen them."""
    seen: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in seen.items():
            n = len(counts)
            names = pa.array(list(counts), pa.binary()).cast(pa.string())
            held = [docs[lang, source][t] for t in counts]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), names, pa.array(list(counts.values()), pa.int64()), pa.array(held, pa.int64())], names=["lang", "source", "term", "n", "df"])
        seen.clear()
        docs.clear()

    cells = 0
    for batch in batches:
        for text, lang, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if (lang, source) not in seen:
                seen[lang, source], docs[lang, source] = Counter(), Counter()
            count, own = seen[lang, source], set()
            before = len(count)
            for words in terms(text):
                count.update(words)
                own.update(words)
            own.discard(b"")
            count.pop(b"", None)
            docs[lang, source].update(own)
            cells += len(count) - before
            if cells >= CELLS:
                yield from flushed()
                cells = 0
    yield from flushed()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df) of all texts: occurrences, and documents that hold the term."""
    cells = docs.select(F.col("text").cast("binary"), "lang", "source").mapInArrow(_counted, "lang string, source string, term string, n long, df long")
    return cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def price(n: Column, total: Column, kept: Column, scale: int, prior: int) -> Column:
    """1 + floor(scale * (n + prior) / (total + prior * kept)), exact."""
    wide = lambda c: c.cast("decimal(28,0)")
    top = (F.lit(scale).cast("decimal(10,0)") * wide(n + prior)).cast("decimal(38,0)")
    return F.call_function("div", top, (wide(total) + wide(F.lit(prior) * kept)).cast("decimal(38,0)")) + F.lit(1).cast("long")


def joint_prices(rows: int, left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...]) -> np.ndarray:
    """Differences of prices over ``rows`` terms, summed for each pair of a left and a right source.

    A side is (row, source, level, price) of its cells, where sources count from zero and each has one cell of row -1, whose price is that
    of level zero. Its indicator matrix has a row for each term and a column for each (source, level), level zero
    included. The product of the left one's transpose with the right one counts the terms of every two levels: the joint
    tables of all pairs of sources, side by side. They are exact, since no cell exceeds the number of terms.
    """
    sides = []
    for row, source, level, cost in (left, right):
        columns, first, column = np.unique(np.stack([source, level]), axis=1, return_index=True, return_inverse=True)
        starts = np.flatnonzero(np.diff(columns[0], prepend=-1))
        hot = np.zeros((rows, columns.shape[1]), np.float32)
        held = row >= 0
        hot[row[held], column.ravel()[held]] = 1
        hot[:, starts] = 1 - np.add.reduceat(hot, starts, axis=1)  # level zero is each source's first column, empty so far
        sides.append((hot, cost[first], starts))
    (a, a_cost, a_starts), (b, b_cost, b_starts) = sides
    priced = (a.T @ b).astype(np.int64) * np.abs(a_cost[:, None] - b_cost[None, :])
    return np.add.reduceat(np.add.reduceat(priced, a_starts, axis=0), b_starts, axis=1)


def _block_prices(block: pa.Table, sources: int) -> pa.Table:
    """Sums over the terms of one block for the pairs of two blocks of ``sources`` sources."""
    names = block["term"].combine_chunks().dictionary_encode()
    row, source, level, cost = names.indices.fill_null(-1).to_numpy(), block["sidx"].to_numpy(), block["n"].to_numpy(), block["p"].to_numpy()
    low, high = block["low"][0].as_py(), block["high"][0].as_py()
    rows = len(names.dictionary)
    frequent = np.argsort(np.argsort(-np.bincount(row[row >= 0], level[row >= 0], rows), kind="stable"))
    place = np.where(row >= 0, frequent[row] if rows else -1, -1)
    sums = np.zeros((0, 0), np.int64)
    for at in range(0, rows, TERMS):
        of = ((place >= at) & (place < at + TERMS)) | (row < 0)
        sides = []
        for part in (low, high):
            own = of & (source // sources == part)
            sides.append((np.where(row[own] < 0, -1, place[own] - at), source[own] - part * sources, level[own], cost[own]))
        more = joint_prices(min(TERMS, rows - at), *sides)
        sums = more if not sums.size else sums + more
    x, y = (z.ravel() for z in np.meshgrid(np.arange(sums.shape[0]) + low * sources, np.arange(sums.shape[1]) + high * sources, indexing="ij"))
    value = sums.ravel()
    if low != high:
        x, y, value = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([value, value])
    n = len(value)
    return pa.table({"lang": pa.array([block["lang"][0].as_py()] * n, pa.string()), "sidx": pa.array(x, pa.int32()), "other": pa.array(y, pa.int32()), "terms": pa.array(np.full(n, rows), pa.int64()), "total": pa.array(value, pa.int64())})


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = 30,
    scale: int = 1_000_000_000,
    prior: int = 5,
    top: int = 50,
    block_terms: int = 256,
    block_sources: int = 32,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from each other one, and its own words.

    Terms are runs of letters and non-ASCII characters, A-Z in lower case. A language keeps the terms that at least ``least_docs`` of its
    documents hold. A source's price of a kept term is 1 + floor(``scale`` * (count + ``prior``) / (all counts + ``prior`` * kept terms)), and that of
    the language likewise. Part ``pair`` has for each other source the sum of price differences over all kept terms; part ``term``
    the ``top`` terms of the source whose price exceeds the language's most. Ranks go by value down, then item up.

    Tasks count the terms of their whole texts; counts are then summed by key. Pairs of sources are priced by joint tables of count levels: one-hot
    matrices of about ``block_terms`` terms and ``block_sources`` sources are multiplied in tasks, priced there, and the sums of blocks are added. A hot language
    is many blocks; no task sees more than one. All arithmetic is exact.

    Null texts, languages and sources count as empty strings. Groups without terms are there; without any kept term their
    values are 0. Repeated rows count as often as they occur. Other columns are ignored. An empty table gives an empty result.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    plain = docs.select(blank(text_col).alias("text"), blank(lang_col).alias("lang"), blank(source_col).alias("source"))
    cells = written(term_counts(plain), "cells")
    kept = written(cells.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).filter(F.col("df") >= least_docs).drop("df"), "kept_terms")
    counts = written(cells.drop("df").join(kept, ["lang", "term"]), "kept_cells")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    cost = lambda n, total: F.when(F.col("kept") > 0, price(n, total, F.col("kept"), scale, prior)).otherwise(F.lit(0).cast("long"))
    numbered = groups.withColumn("sidx", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = written(
        numbered.withColumn("zero", cost(F.lit(0).cast("long"), F.col("total")))
        .withColumn("sblocks", F.floor((F.count(F.lit(1)).over(Window.partitionBy("lang")) - 1) / block_sources).cast("int") + 1)
        .withColumn("tblocks", F.ceil(F.col("kept") / block_terms).cast("int")),
        "groups",
    )
    priced = written(counts.join(groups, ["lang", "source"]).withColumns({"p": cost(F.col("n"), F.col("total")), "q": cost(F.col("lang_n"), F.col("lang_total"))}), "priced")

    own = F.floor(F.col("sidx") / block_sources).cast("int")
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("sblocks") - 1), lambda o: F.struct(F.least(own, o).alias("low"), F.greatest(own, o).alias("high")))).alias("meets")
    block = F.pmod(F.xxhash64("term"), F.col("tblocks")).cast("int").alias("block")
    levels = priced.select("lang", block, meets, "sidx", "term", "n", "p")
    zeros = groups.filter(F.col("kept") > 0).select("lang", F.explode(F.sequence(F.lit(0), F.col("tblocks") - 1)).alias("block"), "sblocks", "sidx", "zero")
    zeros = zeros.select("lang", "block", meets, "sidx", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.col("zero").alias("p"))
    dealt = levels.unionByName(zeros).select("lang", "block", "meets.low", "meets.high", "sidx", "term", "n", "p")
    sums = dealt.groupBy("lang", "block", "low", "high").applyInArrow(lambda block: _block_prices(block, block_sources), "lang string, sidx int, other int, terms long, total long")
    sums = sums.groupBy("lang", "sidx", "other").agg(F.sum("terms").alias("terms"), F.sum("total").alias("total"))

    a, b = groups.select("lang", "source", "sidx", "kept", "zero"), groups.select("lang", F.col("source").alias("item"), F.col("sidx").alias("other"), F.col("zero").alias("other_zero"))
    pairs = a.join(b, "lang").filter(F.col("sidx") != F.col("other")).join(sums, ["lang", "sidx", "other"], "left").na.fill(0, ["terms", "total"])
    value = F.col("total") + (F.col("kept") - F.col("terms")) * F.abs(F.col("zero") - F.col("other_zero"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn("rank", F.row_number().over(order))
    words = priced.filter((F.col("n") > 0) & (F.col("p") > F.col("q"))).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    words = words.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(words)
