"""Toxicity as multiple-instance learning: sentences are scored, a noisy-or of them is the document's score."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, held, hold_nothing, passing_tables, written

#: Ends of sentences: . ! ? line ends, and the ideographic full stop.
BREAK = re.compile(rb"[.!?\n\r]+|\xe3\x80\x82")
#: Words are runs of letters; every byte of a letter beyond ASCII has its high bit set.
WORD = re.compile(rb"[a-z\x80-\xff]+")
PREFIXES = range(3, 7)
#: Bits of a feature's hash, words whose weight one worker remembers, documents whose gradient is summed at once.
HASH_BITS, CACHE, SLICE = 22, 300_000, 1024
#: Log odds of a sentence whose features say nothing, the mean of the bias's unit normal prior.
PRIOR = -6.0
#: A sentence less likely than this is no evidence: it counts as clean, so that length alone never adds up to anything.
FLOOR = 0.2
SENTENCES = "array<struct<start: int, end: int, score: double>>"


def word_features(word: bytes) -> list[int]:
    """Hashes of a word's beginnings, and of the whole word where it is no longer than those.

    Longer words count by what they begin with, so inflected and compound forms share their weight.
    """
    letters = word.decode("utf-8", "ignore")
    names = ["^" + letters[:n] for n in PREFIXES if n <= len(letters)]
    if len(letters) < PREFIXES.stop:
        names.append("=" + letters)
    return [xxhash.xxh32_intdigest(x.encode()) >> (32 - HASH_BITS) for x in names]


def sentences(text: bytes) -> Iterator[tuple[int, int, set[bytes]]]:
    """(start, end, distinct words) of each sentence that has a word; offsets in bytes."""
    low, at = text.lower(), 0
    for start, end in [(m.start(), m.end()) for m in BREAK.finditer(low)] + [(len(low), len(low))]:
        if words := WORD.findall(low, at, start):
            yield at, start, set(words)
        at = end


def _batches(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def _counted(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): documents of either label that have the feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        seen = np.zeros((2, 1 << HASH_BITS), np.int32)
        for batch in batches:
            for text, y in zip(_batches(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                words = set().union(*(w for _, _, w in sentences(text)))
                seen[y, list({f for w in words for f in word_features(w)})] += 1
        used = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(seen[1, used], pa.int64()), pa.array(seen[0, used], pa.int64())], names=["feature", "toxic", "clean"])

    partial = sample.select("text", "y").mapInArrow(run, "feature int, toxic long, clean long")
    return partial.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _selected(sample: DataFrame, positives: int, negatives: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``features`` features that speak for the toxic label best, and their z-scores: of the two shares, smoothed.

    They are ranked and never cut at a fixed z, since z grows with the number of labelled rows. Features of clean
    documents are mostly the common words of some language: they tell nothing of a sentence beside an insult,
    and would fill every sentence's list.
    """
    p, q = (F.col("toxic") + 0.5) / (positives + 1), (F.col("clean") + 0.5) / (negatives + 1)
    mean = (F.col("toxic") + F.col("clean") + 1) / (positives + negatives + 2)
    z = (p - q) / F.sqrt(mean * (1 - mean) * (1 / (positives + 1) + 1 / (negatives + 1)))
    best = _counted(sample).select("feature", z.alias("z")).filter(F.col("z") > 0).orderBy(F.desc("z"), "feature").limit(features).collect()
    best.sort(key=lambda r: r["feature"])
    return np.array([r["feature"] for r in best], np.int64), np.array([r["z"] for r in best])


def _encoded(sample: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(y, at, columns): the sentences that have a chosen feature, listed flat."""
    column = {int(f): i for i, f in enumerate(chosen)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        cache: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            rows: tuple[list, list] = ([], [])
            for text in _batches(batch.column(0)):
                at, cols, n = [], [], 0
                for _, _, words in sentences(text):
                    own: list[int] = []
                    for w in words:
                        if (f := cache.get(w)) is None:
                            if len(cache) > CACHE:
                                cache.clear()
                            f = cache[w] = tuple([column[x] for x in word_features(w) if x in column])
                        own += f
                    if own:
                        at += [n] * len(own)
                        cols += own
                        n += 1
                for kept, value in zip(rows, (at, cols), strict=True):
                    kept.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows[0], pa.list_(pa.int32())), pa.array(rows[1], pa.list_(pa.int32()))], names=["y", "at", "columns"])

    return sample.select("text", "y").mapInArrow(run, "y int, at array<int>, columns array<int>")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or_gradient(weights: np.ndarray, y: np.ndarray, doc: np.ndarray, sent: np.ndarray, cols: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log likelihood of document labels, and its gradient; the last weight is the bias of every sentence listed.

    sent[i] is the sentence of entry i and cols[i] its feature; doc[s] is the document of sentence s. Sentences
    without a feature are not listed: they are clean for certain, whatever their number.
    """
    p = _sigmoid(np.bincount(sent, weights[cols], len(doc)) + weights[-1])
    clean = np.bincount(doc, np.log1p(-p), len(y)).astype(float)  # log of no sentence being toxic
    any_toxic = np.maximum(-np.expm1(clean), 1e-9)
    loss = -np.where(y == 1, np.log(any_toxic), clean).sum()
    factor = np.where(y == 1, -np.exp(clean) / any_toxic, 1.0)
    dz = factor[doc] * p
    gradient = np.bincount(cols, dz[sent], len(weights)).astype(float)  # without entries bincount counts in integers
    gradient[-1] = dz.sum()
    return float(loss), gradient


def _loss(encoded: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """noisy_or_gradient over all of ``encoded``: each task sends one loss and one gradient."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        total = np.zeros(1 + len(weights))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sizes = part.column(1).value_lengths().to_numpy()
                ends, sent = np.cumsum(sizes), part.column(1).flatten().to_numpy()
                listed = np.zeros(len(sizes), np.int64)  # sentences with a feature, numbered from 0 within each document
                listed[sizes > 0] = sent[ends[sizes > 0] - 1] + 1
                sent = sent + np.repeat(np.cumsum(listed) - listed, sizes)
                doc, cols = np.repeat(np.arange(len(sizes)), listed), part.column(2).flatten().to_numpy()
                loss, gradient = noisy_or_gradient(weights, part.column(0).to_numpy(), doc, sent, cols)
                total += np.append(loss, gradient)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["g"])

    total = np.sum([np.frombuffer(r["g"]) for r in encoded.mapInArrow(run, "g binary").collect()], axis=0)
    return float(total[0]), total[1:]


def minimised(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int, tolerance: float, memory: int = 10) -> np.ndarray:
    """Where ``f``, which gives a value and its gradient, is least near ``x``: limited-memory quasi-Newton steps.

    A step is halved until it lowers ``f`` enough. Rounds end when the gradient is ``tolerance`` of its first
    length or no step lowers ``f`` any more; ``rounds`` of them without that are an error.
    """
    value, g = f(x)
    least = tolerance * np.linalg.norm(g)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.linalg.norm(g) <= least:
            return x
        q, used = g.copy(), []
        for s, y, r in reversed(past):
            used.append(r * (s @ q))
            q -= used[-1] * y
        q *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(g))
        for (s, y, r), a in zip(past, reversed(used), strict=True):
            q += (a - r * (y @ q)) * s
        step, slope = 1.0, g @ q
        while (new := f(x - step * q))[0] > value - 1e-4 * step * slope:
            step /= 2
            if step < 1e-6:
                return x
        s, y = -step * q, new[1] - g
        if s @ y > 1e-10 * (y @ y):
            past = [*past[1 - memory :], (s, y, 1 / (s @ y))]
        x, (value, g) = x + s, new
    raise RuntimeError(f"no minimum in {rounds} rounds")


def _fit(sample: DataFrame, features: int, rounds: int, decay: float, tolerance: float, parts: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Chosen features and their weights, bias last.

    A weight's decay grows as the square of how far its feature's z-score lies below the best one, so chance
    words stay near zero beside clear ones at any number of labels. The bias decays towards PRIOR, or the chance
    words of a small sample would explain all of its toxic documents and push the bias out of reach of others.
    """
    seen = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen.get(0) or not seen.get(1):
        return None
    chosen, z = _selected(sample, seen[1], seen[0], features)
    scale = np.append(z / z.max(initial=0), 1.0)  # in which all weights decay alike
    start = np.append(np.zeros(len(chosen)), PRIOR)
    even = np.append(np.full(len(chosen), decay), 1.0)
    encoded = written(_encoded(sample, chosen).repartition(parts), "encoded").coalesce(parts)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        value, gradient = _loss(encoded, x * scale)
        return value + (even * (x - start) ** 2).sum() / 2, gradient * scale + even * (x - start)

    return chosen, minimised(loss, start, rounds, tolerance) * scale


class Model:
    """Weights of chosen features and the bias; without any, nothing is toxic."""

    def __init__(self, fitted: tuple[np.ndarray, np.ndarray] | None):
        self.empty = fitted is None
        self.weight = {} if self.empty else dict(zip(fitted[0].tolist(), fitted[1][:-1].tolist(), strict=True))
        self.bias = -np.inf if self.empty else float(fitted[1][-1])
        self.key = uuid.uuid4().hex
        self.words: dict[bytes, float] = {}

    def _learn(self, word: bytes) -> float:
        if len(self.words) > CACHE:
            self.words.clear()
        self.words[word] = total = sum(self.weight.get(f, 0.0) for f in word_features(word))
        return total

    def score(self, text: bytes) -> tuple[float, list[dict]]:
        """The noisy-or of the sentences that reach FLOOR, and those that score a half or more."""
        known, clean, own, at, points = self.words, 0.0, [], 0, 0
        for start, end, words in sentences(text) if not self.empty else ():
            z = self.bias + sum([w if (w := known.get(x)) is not None else self._learn(x) for x in words])
            p = 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))
            if p >= FLOOR:
                clean += math.log1p(-p)
            if p >= 0.5:
                points += len(text[at:start].decode("utf-8", "ignore"))
                size = len(text[start:end].decode("utf-8", "ignore"))
                own.append({"start": points, "end": points + size, "score": p})
                at, points = end, points + size
        return -math.expm1(clean) + 0.0, own


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
    held_fold: int = 0,
    most_labelled: int = 20_000,
    features: int = 4096,
    rounds: int = 200,
    decay: float = 0.02,
    tolerance: float = 1e-3,
    parts: int = 6,
) -> Model:
    """A model of document labels outside the held-out fold.

    About ``most_labelled`` of the labelled rows, chosen by a hash of their id, are fitted; a table with fewer
    is used whole. Of several labels for an id the largest counts; null labels and ids count for nothing.
    """
    doc_id = F.col(id_col).cast("long").alias("doc_id")
    known = labels.groupBy(doc_id).agg(F.max(F.col(label_col).cast("int")).alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.filter(fold(F.col("doc_id"), folds) != held_fold)
    share = min(1.0, most_labelled / max(1, known.count()))
    with passing_tables(docs.sparkSession):
        few = written(known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 62)) < int(share * (1 << 62))), "labels")  # most_labelled rows, give or take chance
        rows = docs.select(doc_id, F.col(text_col).cast("binary").alias("text"))
        sample = written(rows.join(F.broadcast(few), "doc_id").select("text", "y"), "sample")
        return Model(_fit(sample, features, rounds, decay, tolerance, parts))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 0, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending) for each row of ``docs``; ``options`` go to fit.

    Trained from document labels alone. score is one less the product over sentences of one less their score, of those that score FLOOR or
    more: sentences of which nothing speaks for the label add nothing, so a clean text may be of any length. offending lists the sentences (code points, end exclusive) that score a half or more on their own. Every
    sentence of every whole text is scored. Texts without a word, null and empty ones too, score 0; where a
    label is missing altogether every score is 0. Repeated rows stay; other columns are ignored; an empty
    table gives an empty result.
    """
    model = fit(docs, labels, id_col, text_col, folds=folds, held_fold=held_fold, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        own = held(model.key, lambda: model)
        for batch in batches:
            found = [own.score(t) for t in _batches(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for p, _ in found], pa.float64()), pa.array([o for _, o in found], pa.list_(kind))],
                names=["doc_id", "score", "offending"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    scored = rows.mapInArrow(run, f"doc_id long, score double, offending {SENTENCES}")
    held_out = (fold(F.col("doc_id"), folds) == held_fold).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def without_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``; ``options`` go to fit.

    Null and empty texts score 0 and stay, as all rows do where no label can be learned from. Repeated rows stay
    or go together. Columns of any names stay; an empty table stays empty.
    """
    model, at = fit(docs, labels, text_col=text_col, **options), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(model.key, lambda: model)
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            yield batch.filter(pa.array([own.score(t)[0] < threshold for t in _batches(texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
