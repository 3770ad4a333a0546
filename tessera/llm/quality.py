"""Text quality: ridge regression on random Fourier features of document statistics, then isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, written

SYMBOLS = (b"|", b"!", b"$", b"%", b"&", b"*", b"#", b"?", b"@<>[]{}\\^~`=_+", b".", b",;:", b"\"'()-/")
UPPERS, LOWERS, DIGITS = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
HIGH = bytes(range(128, 256))
MARKED = re.compile(rb"[^A-Za-z0-9\x80-\xff](?:\s|\Z)")
#: Steps between -0.5 and 1.5 in which raw scores are gathered for calibration.
GRID = 2000


def statistics(text: bytes) -> list[float]:
    """What the classifier sees of a text: lengths, shares of kinds of characters, repetition."""
    size, words, lines = len(text), text.split(), text.split(b"\n")
    n, m = max(1, size), max(1, len(words))
    counts, rows = Counter(words), Counter(x for x in lines if x.strip())
    shares = [(size - len(text.translate(None, kind))) / n for kind in (UPPERS, LOWERS, DIGITS, HIGH, *SYMBOLS)]
    return [
        np.log1p(size),
        np.log1p(len(words)),
        sum(map(len, words)) / m,
        len(counts) / m,
        max(counts.values(), default=0) / m,
        sum(c for c in counts.values() if c > 1) / m,
        len(lines) / m,
        1 - len(rows) / max(1, sum(rows.values())),
        len(MARKED.findall(text)) / m,
        *(np.sqrt(s) for s in shares),
    ]


STATS = len(statistics(b""))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x) of every whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t or b"") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


def fourier(x: np.ndarray, model: dict) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    z = np.clip((x - model["mean"]) / model["scale"], -5, 5) @ model["omega"] + model["phase"]
    return np.hstack([np.cos(z) * np.sqrt(2 / z.shape[1]), np.ones((len(x), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(-1, STATS)


def pool_adjacent(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nondecreasing fit of y with the least weighted squared error."""
    means: list[float] = []
    mass: list[float] = []
    size: list[int] = []
    for v, w in zip(y, weight, strict=True):
        means.append(v)
        mass.append(w)
        size.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            v, w, k = means.pop(), mass.pop(), size.pop()
            means[-1] = (means[-1] * mass[-1] + v * w) / (mass[-1] + w)
            mass[-1] += w
            size[-1] += k
    return np.repeat(means, size)


def _fit(train: DataFrame, features: int, width: float, ridge: float, seed: int) -> dict | None:
    """The model of (x, y) rows; None where there are none. The driver gets sums, never rows."""
    at = [F.element_at("x", i + 1) for i in range(STATS)]
    first = train.agg(F.count("y").alias("n"), F.avg("y").alias("y"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(at)), *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(at))).first()
    if not first["n"]:
        return None
    rnd = np.random.default_rng(seed)
    model = {
        "mean": np.array([first[f"m{i}"] for i in range(STATS)]),
        "scale": np.array([first[f"s{i}"] or 1.0 for i in range(STATS)]),
        "omega": rnd.normal(0, 1 / (width * np.sqrt(STATS)), (STATS, features)),
        "phase": rnd.uniform(0, 2 * np.pi, features),
    }

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            z = fourier(_matrix(batch.column(0)), model)
            part = z.T @ np.column_stack([z, batch.column(1).to_numpy(zero_copy_only=False)])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([line.tobytes() for line in total], pa.binary())], names=["line", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for line, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[line] = total.get(line, 0.0) + np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["line", "sums"])

    # every task sums its own rows; the lines of those matrices are dealt out and summed, each where it lies
    kind = "line int, sums binary"
    lines = train.select("x", "y").mapInArrow(sums, kind).repartition("line").mapInArrow(added, kind).collect()
    total = np.array([np.frombuffer(r["sums"]) for r in sorted(lines, key=lambda r: r["line"])])
    penalty = ridge * first["n"] / features * np.eye(features + 1)
    penalty[-1, -1] = 0
    model["weights"] = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])
    raw = _raw(train, model).groupBy("step").agg(F.count("y").alias("n"), F.avg("y").alias("y")).orderBy("step").collect()
    model["steps"] = np.array([r["step"] for r in raw], float)
    model["fitted"] = pool_adjacent(np.array([r["y"] for r in raw]), np.array([r["n"] for r in raw], float))
    return model


def _steps(raw: np.ndarray) -> np.ndarray:
    return np.round((np.clip(raw, -0.5, 1.5) + 0.5) / 2 * GRID).astype(np.int32)


def _raw(train: DataFrame, model: dict) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = _steps(fourier(_matrix(batch.column(0)), model) @ model["weights"])
            yield pa.RecordBatch.from_arrays([pa.array(steps, pa.int32()), batch.column(1)], names=["step", "y"])

    return train.select("x", "y").mapInArrow(run, "step int, y double")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 3,
    held_fold: int = 1,
    features: int = 256,
    width: float = 0.7,
    ridge: float = 1e-3,
    seed: int = 42,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Learns from labelled rows outside the held-out fold only, and sees nothing but statistics of the text.
    Every labelled row counts: each task sums its part of the normal equations, whose lines are dealt out and added up,
    and the driver solves the one matrix of ``features``² numbers; raw scores are gathered on a fixed grid and made
    monotone. Null and empty texts get the score of all-zero statistics. Of several labels for an id the
    largest counts; null labels and ids count for nothing. Without any label all scores are 0.5. Repeated
    rows stay; other columns are ignored; an empty table gives an empty result.
    """
    stats = written(document_statistics(docs, id_col, text_col), "statistics")
    known = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("double")).alias("y")).filter(F.col("y").isNotNull() & F.col("doc_id").isNotNull())
    held = fold(F.col("doc_id"), folds) == held_fold
    train = written(stats.filter(~held).join(known.filter(~held), "doc_id").select("x", "y"), "train")
    model = _fit(train, features, width, ridge, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                steps = _steps(fourier(_matrix(batch.column(1)), model) @ model["weights"])
                score = np.interp(steps, model["steps"], model["fitted"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
