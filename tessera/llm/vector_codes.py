"""Product codes of vectors: codebooks of integer parts, nearest entries found by slicing and intersecting bit masks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Largest component after scaling: squared errors of whole vectors then fit a long.
LARGEST = 1 << 27
#: Entries that one mask can hold, and dimensions that each name an entry for the first radius.
WORD, HANDS = 64, 3


class SlicedBook:
    """The entries of one part position, ready for exact nearest-entry search.

    Each dimension keeps its coordinates in order, and before each of them the mask of all entries so far. The entries
    whose coordinate lies in a range are the mask at its end without the mask at its start. A vector's radius is its
    distance to the best of a few entries at hand (those nearest in the dimensions where entries differ most), so the ranges of
    all dimensions, ANDed, hold every entry that is as near; those are measured exactly.
    """

    def __init__(self, entries: np.ndarray) -> None:
        if len(entries) > WORD:
            raise ValueError(f"a codebook of {len(entries)} entries does not fit masks of {WORD} bits")
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0).T.copy()
        bits = np.uint64(1) << order.T.astype(np.uint64)
        self.prefix = np.concatenate([np.zeros((len(bits), 1), np.uint64), np.bitwise_or.accumulate(bits, axis=1)], axis=1)
        self.widest = np.argsort(entries.min(axis=0) - entries.max(axis=0), kind="stable")[:HANDS].tolist()
        self.at_hand = order.T

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """For each row of ``x`` the mask of entries no farther in any dimension than the best entry at hand is as a whole."""
        square = np.full(len(x), np.iinfo(np.int64).max)
        for d in self.widest:
            near = np.minimum(np.searchsorted(self.sorted[d], x[:, d]), len(self.entries) - 1)
            square = np.minimum(square, ((x - self.entries[self.at_hand[d, near]]) ** 2).sum(axis=1))
        radius = np.floor(np.sqrt(square.astype(float))).astype(np.int64) + 1
        mask = np.full(len(x), ~np.uint64(0))
        for d, line in enumerate(self.sorted):
            low = np.searchsorted(line, x[:, d] - radius, "left")
            high = np.searchsorted(line, x[:, d] + radius, "right")
            mask &= self.prefix[d, high] & ~self.prefix[d, low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row of ``x`` (the lower of equals), and its squared distance."""
        if not len(x):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        rows, entries = np.nonzero((self.candidates(x)[:, None] >> np.arange(len(self.entries), dtype=np.uint64)) & np.uint64(1))
        far = ((x[rows] - self.entries[entries]) ** 2).sum(axis=1)
        starts = np.searchsorted(rows, np.arange(len(x)))
        least = np.minimum.reduceat(far, starts)
        hits = np.flatnonzero(far == least[rows])
        first = hits[np.searchsorted(rows[hits], np.arange(len(x)))]
        return entries[first], least


@dataclass
class Codebooks:
    """Entries by part position; ``digest`` is the SHA-256 of all components in order."""

    parts: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(c) for part in self.parts for entry in part.tolist() for c in entry).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) of entries and of squared distances."""
        width = x.shape[1] // len(self.parts)
        found = [SlicedBook(book).nearest(x[:, p * width : (p + 1) * width]) for p, book in enumerate(self.parts)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def usable(vec: Column) -> Column:
    """Neither null nor with null, NaN or infinite components."""
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))


def scaled(vec: Column, scale: int) -> Column:
    """Components times ``scale``, rounded down, as longs."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists of numbers as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _starting(kept: DataFrame, parts: int, entries: int) -> Codebooks:
    """Parts of the vectors with the smallest ids."""
    first = kept.groupBy("vec_id").agg(F.min("v").alias("v")).orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()
    book = np.array([r["v"] for r in first], np.int64)
    return Codebooks(list(book.reshape(len(book), parts, -1).swapaxes(0, 1).copy()))


def _added(total: np.ndarray, codes: np.ndarray, cells: np.ndarray) -> None:
    """Adds each row of ``cells`` to the row of ``total`` that its code names."""
    order = np.argsort(codes, kind="stable")
    runs = codes[order]
    starts = np.flatnonzero(np.diff(runs, prepend=-1))
    total[runs[starts]] += np.add.reduceat(cells[order], starts, axis=0)


def _moved(kept: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, every entry to the floor of its parts' mean."""
    width = books.parts[0].shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(b), width + 1), np.int64) for b in books.parts]
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                codes = books.assign(x)[0]
                for p, total in enumerate(totals):
                    _added(total, codes[:, p], np.column_stack([x[:, p * width : (p + 1) * width], np.ones(len(x), np.int64)]))
        for p, total in enumerate(totals):
            used = np.flatnonzero(total[:, -1])
            cells = pa.array(total[used].ravel(), pa.int64())
            keys = [np.repeat(np.full(len(used), p, np.int32), width + 1), np.repeat(used.astype(np.int32), width + 1), np.tile(np.arange(width + 1, dtype=np.int32), len(used))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, keys), cells], names=["p", "e", "d", "x"])

    rows = kept.select("v").mapInArrow(sums, "p int, e int, d int, x long").groupBy("p", "e", "d").agg(F.sum("x").alias("x")).collect()
    total = {(r["p"], r["e"], r["d"]): r["x"] for r in rows}
    moved = [book.copy() for book in books.parts]
    for (p, e, d), x in total.items():
        if d < width:
            moved[p][e, d] = x // total[p, e, width]
    return Codebooks(moved)


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for each usable row of ``vectors``.

    Components are multiplied by ``scale`` and rounded down. Every position of ``parts`` equal parts has a codebook of
    ``entries`` entries, at first the parts of the vectors with the smallest ids; each round moves every entry to the
    floor of the mean of its parts, over all rows, and leaves unused ones. Tasks send the driver sums of entries, whose number does
    not grow with the rows. All arithmetic is exact, so results don't depend on how rows are dealt out.

    Rows whose vector is null or holds a null or non-finite component are left out, and so are those of another length
    than the vector with the smallest id. A length that ``parts`` does not divide, or a component of 2^27 or more after scaling,
    is an error. Repeated ids: the least vector of an id starts a codebook, all rows count and get a code. Null ids
    come after all others. Null labels are one label. Other columns are ignored. An empty table gives an empty result.
    """
    vec = F.col(vec_col)
    kept = vectors.filter(usable(vec)).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), scaled(vec, scale).alias("v"))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("size")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    if first["size"] == 0 or first["size"] % parts:
        raise ValueError(f"vectors of {first['size']} components can't be cut into {parts} equal parts")
    too_large = F.raise_error(F.lit("a component is too large for exact squared errors"))
    kept = kept.filter(F.size("v") == first["size"]).withColumn("v", F.when(F.exists("v", lambda x: F.abs(x) >= LARGEST), too_large).otherwise(F.col("v")))
    final = _starting(kept, parts, entries)
    for _ in range(rounds):
        final = _moved(kept, final)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, far = final.assign(matrix(batch.column(2)))
                text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text), pa.array(far.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    kinds = dict(kept.dtypes)
    codes = written(kept.mapInArrow(coded, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes")
    by_label = written(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors").withColumnRenamed("label", "of_label")
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left").select("vec_id", "code", "error", "label_error", F.lit(final.digest()).alias("codebooks_sha256"))
