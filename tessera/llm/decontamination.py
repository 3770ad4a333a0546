"""Benchmark items that documents hold, up to a few edits: exact pieces first, then Myers' bit-parallel distance."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held

HITS = "doc_id long, item_id long, distance int, start long, end long"


def normalised(text: str | None) -> str:
    """A-Z in lower case and each run of white space as one blank."""
    return " ".join((text or "").encode("utf-8", "replace").lower().decode().split())


def pieces(size: int, budget: int) -> list[tuple[int, int]]:
    """budget + 1 pieces of an item of ``size`` characters; ``budget`` edits leave one of them whole."""
    n = budget + 1
    return [(size * i // n, size * (i + 1) // n) for i in range(n)]


def _columns(pattern: str) -> dict[str, int]:
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        places[c] |= 1 << i
    return places


def distances(pattern: str, text: str, anchored: bool = False) -> Iterator[int]:
    """Least edit distance between ``pattern`` and what ends at each character of ``text``.

    Anchored, what ends there must begin at the text's start; else it may begin anywhere.
    """
    m, places = len(pattern), _columns(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    for c in text:
        eq = places.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up), up & xh
        score += bool(ph & high) - bool(mh & high)
        ph = (ph << 1) | anchored
        mh <<= 1
        up, down = (mh | ~(xv | ph)) & full, ph & xv & full
        yield score


def best_match(item: str, text: str, budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the first best match of ``item`` within ``text``; None beyond ``budget``."""
    found = list(distances(item, text))
    least = min(found, default=budget + 1)
    if least > budget:
        return None
    end = found.index(least) + 1
    back = list(distances(item[::-1], text[max(0, end - len(item) - budget) : end][::-1], anchored=True))
    return least, end - (back.index(least) + 1), end


class Items:
    """An automaton of all pieces of some items."""

    def __init__(self, rows: list[tuple[int | None, str]], percent: int):
        import ahocorasick

        self.items = [(i, t, len(t) * percent // 100) for i, raw in rows if (t := normalised(raw))]
        held: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for at, (_, text, budget) in enumerate(self.items):
            for a, b in pieces(len(text), budget):
                held[text[a:b]].append((at, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in held.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) of each item's best match."""
        if not self.items or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for at, offset in where:
                _, item, budget = self.items[at]
                start = last - size + 1 - offset
                lo, hi = max(0, start - budget), min(len(text), start + len(item) + budget)
                own = windows.setdefault(at, [])
                if own and lo <= own[-1][1]:  # hits of an item come in order of their ends; windows may overlap
                    own[-1] = [min(lo, own[-1][0]), max(hi, own[-1][1])]
                else:
                    own.append([lo, hi])
        out = []
        for at, own in sorted(windows.items()):
            item_id, item, budget = self.items[at]
            best = None
            for lo, hi in own:
                if (m := best_match(item, text[lo:hi], budget)) and (best is None or m[0] < best[0]):
                    best = (m[0], m[1] + lo, m[2] + lo)
                    if not m[0]:
                        break
            if best:
                out.append((item_id, *best))
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator:
    """Broadcast lists of (item_id, text), each of about ``block_chars`` characters."""
    size = benchmark.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_chars))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        yield benchmark.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").collect()])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    percent: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = 2_000_000,
) -> DataFrame:
    """(doc_id, item_id, distance, start, end) for each document that holds an item, with the item's best match.

    An item may differ by an edit for each ``100 / percent`` of its characters, rounded down. It is cut into
    one piece more than that, so one piece at least stands unchanged; every place of every piece is found in
    the whole normalised text and the text around it is verified. start and end are code points of the
    normalised text. Items are broadcast in blocks of about ``block_chars`` characters; a larger benchmark
    takes a pass over the documents for each block.

    Empty and null items and texts never match. Ties go to the first best place. Repeated rows and items
    give repeated results; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in _blocks(benchmark, item_col, item_text_col, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block=block, key=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            index = held(key, lambda: Items(block.value, percent))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            for batch in batches:
                found = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in index.search(normalised(t))]
                cols = list(zip(*found, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "item_id", "distance", "start", "end"])

        hits = rows.mapInArrow(run, HITS)
        out = hits if out is None else out.unionByName(hits)
    return out


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, percent: int = 5, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = 2_000_000
) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item as ``contaminated`` finds them.

    Null and empty texts hold none and stay; empty items are in no text. Repeated rows stay or go together.
    Columns of any names stay; an empty table stays empty.
    """
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text_col, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block=block, key=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            index = held(key, lambda: Items(block.value, percent))
            for batch in batches:
                yield batch.filter(pa.array([not index.search(normalised(t)) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
