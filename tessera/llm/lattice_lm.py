"""Language-model scores: a subword lattice whose unigram scores weight every segmentation of a word."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, cached_property
from operator import mul

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, held, written

#: Words counted before a task hands its counts on, words whose log probability one worker remembers.
FLUSH, CACHE = 200_000, 800_000
#: Words whose counts every task gets, and the longest that stand for themselves; longer ones go by their digest, so at most
#: HEADS * (LONGEST + 8) bytes are broadcast.
HEADS, LONGEST = 100_000, 64
MARK = "▁"
#: Added to every piece's count.
ALPHA = 0.1


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks only


def head_key(word: bytes) -> bytes:
    """What a frequent word goes by: itself, or a digest of it that is longer than any such word."""
    return word if len(word) <= LONGEST else b"".join(xxhash.xxh3_128_digest(word, seed) for seed in range(5))


def _head_keys(counts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(head_key, batch.column(0).to_pylist()), pa.binary()), batch.column(1)], names=["key", "n"])

    return counts.select("word", "n").mapInArrow(run, "key binary, n long")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all of ``texts``; the empty word is the end of a text, of which each has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(words_of(text))
                seen[b""] += 1
                if len(seen) > FLUSH:
                    yield out()
        if seen:
            yield out()

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@cache
def pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_counts(counts: DataFrame, path: str) -> np.ndarray:
    """How often each piece of the public vocabulary stands in the training words, as the vocabulary's own segmentation has it.

    One row for each piece reaches the driver, as many as the vocabulary has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        seen = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            n = batch.column(1).to_numpy()
            ids = model.encode([w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()], num_threads=1)
            flat = np.fromiter((i for own in ids for i in own), np.int64)
            np.add.at(seen, flat, np.repeat(n, [len(own) for own in ids]))
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(seen[used], pa.int64())], names=["piece", "n"])

    rows = counts.filter(F.length("word") > 0).select("word", "n").mapInArrow(run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(pieces(path).get_piece_size(), np.int64)
    for r in rows:
        seen[r["piece"]] = r["n"]
    return seen


class Lattice:
    """Natural-log scores of pieces, and the log of the summed probability of all segmentations of a word."""

    def __init__(self, path: str, seen: np.ndarray, ends: int):
        model = pieces(path)
        size = model.get_piece_size()
        scores = np.log(seen + ALPHA) - math.log(seen.sum() + ends + ALPHA * (size + 1))
        self.end = math.log(ends + ALPHA) - math.log(seen.sum() + ends + ALPHA * (size + 1))
        self.score: dict[str, float] = {}
        self.byte = [0.0] * 256
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = float(scores[i])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.score[piece] = float(scores[i])
        self.words: dict[bytes, float] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("arcs", "words")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.words = {}

    @cached_property
    def arcs(self):
        """An automaton that names every piece in a text, by where it ends, as (length, score)."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for piece, score in self.score.items():
            found.add_word(piece, (len(piece), score))
        found.make_automaton()
        return found

    def log_probability(self, word: str) -> float:
        """Forward recursion in log space over the mark of a word's start and the word.

        A character that is no piece is spelled by the pieces of its bytes.
        """
        s, score, exp, log = MARK + word, self.score, math.exp, math.log
        at = [0.0]  # log probability of all segmentations of each beginning
        terms: list[float] = []
        last = 0
        spelled = {i: sum(self.byte[b] for b in c.encode("utf-8", "replace")) for i, c in enumerate(s) if c not in score}

        def settle(upto: int) -> None:
            """Closes the ends before ``upto``; those without any piece are spelled."""
            nonlocal last
            while last < upto:
                if last in spelled:
                    terms.append(at[last] + spelled[last])
                if len(terms) == 1:
                    at.append(terms[0])
                else:
                    top = max(terms)
                    at.append(top + log(sum([exp(t - top) for t in terms])))
                terms.clear()
                last += 1

        for end, (size, v) in self.arcs.iter(s):
            if end != last:
                settle(end)
            terms.append(at[end + 1 - size] + v)
        settle(len(s))
        return at[-1]

    def log_probabilities(self, words: Iterable[bytes]) -> list[float]:
        """Those of some words, kept for when they come again."""
        known = self.words
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(words)
        for w in new:
            known[w] = self.log_probability(w.decode("utf-8", "replace"))
        return list(map(known.__getitem__, words))


def lm_scores(
    docs: DataFrame,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held_fold: int = 2,
    heads: int = HEADS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Learns from all texts outside the held-out fold. base_score is an add-one word model. score is the log10
    probability of the text's words and its end under a unigram model of the pieces of an existing
    subword vocabulary: every word is a lattice of pieces, summed over all segmentations.

    The public file ranks its pieces but has no probabilities for them, so their scores are their shares in
    its own segmentation of all training words. Word counts live in a shuffled table. Its most frequent
    words, at most ``heads``, are broadcast, long ones by a digest; the other words of each text are joined
    to it by shuffle, so every token gets its exact count.

    Null and empty texts hold their end only. Without training rows all counts are zero. Repeated rows stay;
    other columns are ignored; an empty table gives an empty result.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    spark = docs.sparkSession
    held_out = fold(F.col("doc_id"), folds) == held_fold
    texts = _texts(docs, id_col, text_col)
    counts = written(word_counts(texts.filter(~held_out)), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), F.coalesce(F.sum(F.when(F.length("word") == 0, F.col("n"))), F.lit(0)).alias("ends")).first()
    n_train, v, ends = total["n"], total["v"], total["ends"]
    lattice = Lattice(vocabulary, piece_counts(counts, vocabulary), ends)

    words = counts.filter(F.length("word") > 0)
    kinds = words.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).collect()
    room, least = heads, None
    for r in kinds:
        if (room := room - r["k"]) < 0:
            break
        least = r["n"]
    known = {bytes(r["key"]): math.log10(r["n"] + 1) for r in _head_keys(words.filter(F.col("n") >= least)).collect()} if least else {}
    shared, key = spark.sparkContext.broadcast((known, lattice)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, model = held(key, lambda: shared.value)
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for text in batch.column(2).to_pylist():
                own = Counter(words_of(text))
                score = sum(map(mul, model.log_probabilities(own), own.values())) + model.end
                keys = list(map(head_key, own)) if max(map(len, own), default=0) > LONGEST else list(own)
                base = sum(map(mul, [common.get(k, 0.0) for k in keys], own.values()))
                rare = [w for w, k in zip(own, keys, strict=True) if k not in common]
                times = [own[w] for w in rare]
                n = own.total()
                for col, value in zip(cols, (n + 1, n - sum(times), base, score / math.log(10), rare, times), strict=True):
                    col.append(value)
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                names=["row", "doc_id", "n_tokens", "hits", "base", "score", "rare", "times"],
            )

    schema = "row long, doc_id long, n_tokens long, hits long, base double, score double, rare array<binary>, times array<long>"
    scanned = written(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(run, schema), "scanned")
    rare = scanned.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("k"))
    tail = (
        rare.join(counts, "word")
        .groupBy("row")
        .agg(F.sum("k").alias("tail_hits"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("tail_base"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return scanned.drop("rare", "times").join(tail, "row", "left").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("hits") + zero(F.col("tail_hits")) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + zero(F.col("tail_base")) + math.log10(ends + 1) - F.col("n_tokens") * math.log10(n_train + v + 1)).alias("base_score"),
        "score",
    )
