"""Token ids in patched frame-of-reference blocks, written and read as Parquet rows of whole segments."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import held, hold_nothing, shared_dir

#: Ids in a block, and ids after which a segment (one row) is closed at the next document's end.
BLOCK, SEGMENT = 1024, 1 << 17
#: Share of a block's ids that its bit width must hold; the others are stored as exceptions.
PERCENTILE = 95
#: Words that one worker keeps encoded, in two halves: the older is given up when the newer is full.
CACHE = 400_000
#: Bytes of text whose words are looked up at once, each distinct one once.
CHUNK = 2 << 20
#: Letters and, behind them, ASCII marks but apostrophes: byte-level files part them there.
LETTERS, MARKS = r"[A-Za-zÀ-ÖØ-öø-ɏ]", r"[!-&(-/:-@\[-`{-~]"
MARKED = rf"\A(?P<word>\n?{LETTERS}+)(?P<marks>{MARKS}+)\z"
HEADER = np.dtype([("low", "<u4"), ("count", "<u2"), ("width", "u1"), ("patches", "<u2")])
SEGMENTS = "shard int, first long, n_ids long, doc_ids array<long>, doc_lens array<long>, starts binary, payload binary"


def pack(ids: np.ndarray) -> tuple[bytes, bytes]:
    """Blocks of up to BLOCK ids, one after the other, and where each starts (uint32).

    A block is its header, the ids less the block's least packed at a width that holds PERCENTILE of them, then
    the places (uint16) and high bits (uint32) of those that need more.
    """
    out: list[bytes] = []
    whole = len(ids) // BLOCK * BLOCK
    for part in (ids[:whole].reshape(-1, BLOCK), ids[whole:].reshape(1, -1)):
        if not part.size:
            continue
        lows = part.min(axis=1)
        rests = part.astype(np.uint32) - lows[:, None].astype(np.uint32)
        lengths = np.frexp(rests)[1]  # of each id in bits
        at = min(part.shape[1] - 1, part.shape[1] * PERCENTILE // 100)
        for low, rest, length, width in zip(lows.tolist(), rests, lengths, np.partition(lengths, at, axis=1)[:, at].tolist(), strict=True):
            over = np.flatnonzero(length > width)
            if width in (8, 16):
                body = rest.astype(f"<u{width // 8}").tobytes()
            else:
                body = np.packbits(np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width], bitorder="little").tobytes()
            head = np.array([(low, len(rest), width, len(over))], HEADER).tobytes()
            patch = over.astype("<u2").tobytes() + (rest[over] >> np.uint32(width)).astype("<u4").tobytes() if len(over) else b""
            out.append(head + body + patch)
    starts = np.cumsum([0, *map(len, out[:-1])] if out else [])
    return b"".join(out), starts.astype("<u4").tobytes()


def gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of ``flat`` that begin at ``begins``, one after the other."""
    before = np.cumsum(sizes, dtype=np.int64) - sizes
    at = np.repeat((begins - before).astype(np.int32), sizes)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at]


def unpack(payload: bytes, starts: bytes) -> np.ndarray:
    """The ids of every block of ``payload``, as uint32."""
    out = [np.empty(0, np.uint32)]
    for at in np.frombuffer(starts, "<u4").tolist():
        low, n, width, k = np.frombuffer(payload, HEADER, 1, at)[0].tolist()
        at += HEADER.itemsize
        size = (n * width + 7) // 8
        if width in (8, 16):
            rest = np.frombuffer(payload, f"<u{width // 8}", n, at).astype(np.uint32)
        else:
            wide = np.zeros((n, 32), np.uint8)
            wide[:, :width] = np.unpackbits(np.frombuffer(payload, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
            rest = np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)
        if k:
            rest[np.frombuffer(payload, "<u2", k, at + size)] |= np.frombuffer(payload, "<u4", k, at + size + 2 * k).astype(np.uint32) << np.uint32(width)
        out.append(rest + np.uint32(low))
    return np.concatenate(out)


class Kept(NamedTuple):
    """Ids of words, one word after the other: how many each has, and whether its text goes to the library whole."""

    flat: np.ndarray
    sizes: np.ndarray
    whole: np.ndarray

    @classmethod
    def joined(cls, parts: list[Kept]) -> Kept:
        return cls(*(np.concatenate(columns) for columns in zip(*parts, strict=True)))

    def take(self, at: np.ndarray) -> Kept:
        begins = np.cumsum(self.sizes) - self.sizes
        return Kept(gathered(self.flat, begins[at], self.sizes[at]), self.sizes[at], self.whole[at])


NONE = Kept(np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, bool))


class Encoder:
    """Encodes texts with the tokenizers library; ids come as little-endian uint32 bytes.

    A byte-level BPE never joins what a single blank or line end between two words parts, so the library encodes
    each distinct word once, with the blank or line end before it, and a bounded cache keeps the ids. A word
    with marks behind it is made of the two, so it takes no place in the cache.
    Texts with any other white space, or with a special token's string, go to the library whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.begins = {" ": np.zeros(max(vocab.values()) + 1, bool), "\n": np.zeros(max(vocab.values()) + 1, bool)}
        for token, i in vocab.items():  # how byte-level files spell a blank and a line end
            self.begins[" "][i], self.begins["\n"][i] = token.startswith("Ġ"), token == "Ċ"
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.parts = getattr(self.library.pre_tokenizer, "use_regex", False) and not any(re.fullmatch(rf"\n?{LETTERS}*{MARKS}*", s) for s in self.special)
        # Places of words in what is kept of their half. Words in use move from the older half to the newer.
        self.words: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.kept = self.older_kept = NONE

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: list[str], before: str) -> Kept:
        """The ids of each of ``new`` after the character ``before``; a token that begins with it begins a word."""
        out = [NONE]
        for i in range(0, len(new), 2048):
            part = new[i : i + 2048]
            joined = before + before.join(part)
            if joined.split() != part or any(s in joined for s in self.special):
                far = [w.split() != [w] or any(s in w for s in self.special) for w in part]
                pieces = [b"" if f else self._whole(before + w) for f, w in zip(far, part, strict=True)]
                out.append(Kept(np.frombuffer(b"".join(pieces), "<u4"), np.array([len(p) // 4 for p in pieces]), np.array(far)))
                continue
            ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            sizes = np.diff(np.flatnonzero(self.begins[before][ids]), append=len(ids))
            if len(sizes) != len(part):
                raise ValueError("a word of the text does not begin with a token of its own")
            out.append(Kept(ids, sizes, np.zeros(len(part), bool)))
        return Kept.joined(out)

    def _codes(self, used: list[str]) -> tuple[Kept, np.ndarray]:
        """Ids that are kept, and which of them each of the distinct words ``used`` has.

        The newer half gets those it lacks, and becomes the older half first where it is full.
        """
        places = lambda half, words: np.fromiter(map(half.get, words, repeat(-1)), np.int64, len(words))
        kept, at = self.kept, places(self.words, used)
        gaps = np.flatnonzero(at < 0)
        if not len(gaps):
            return kept, at
        if len(self.words) + len(gaps) > CACHE // 2:
            self.older, self.older_kept, self.words, self.kept = self.words, self.kept, {}, NONE
        lacking = [used[i] for i in gaps.tolist()]
        before = places(self.older, lacking)
        lined = np.fromiter((w[:1] == "\n" for w in lacking), bool, len(lacking))
        old, blank, line = (np.flatnonzero(x) for x in (before >= 0, (before < 0) & ~lined, (before < 0) & lined))
        more = Kept.joined([
            self.older_kept.take(before[old]),
            self._learn([lacking[i] for i in blank.tolist()], " "),
            self._learn([lacking[i][1:] for i in line.tolist()], "\n"),
        ])
        order = np.concatenate([old, blank, line])
        at[gaps[order]] = len(kept.sizes) + np.arange(len(order))
        self.words.update(zip([lacking[i] for i in order.tolist()], range(len(self.kept.sizes), len(self.kept.sizes) + len(order)), strict=True))
        both = Kept.joined([kept, more])
        self.kept = both if self.kept is kept else more
        return both, at

    def _encoded(self, texts: pa.Array) -> list[bytes]:
        first, none = (pa.scalar(x, texts.type) for x in ("\n", ""))
        docs = pc.split_pattern(pc.binary_join_element_wise(first, pc.replace_substring(texts, "\n", " \n"), none), " ")  # words after a line end keep it
        words = docs.flatten().dictionary_encode()
        at, distinct = words.indices.to_numpy(), words.dictionary
        parted = pc.extract_regex(distinct if self.parts else pa.nulls(len(distinct), distinct.type), MARKED)
        bare = pc.coalesce(pc.struct_field(parted, "word"), distinct).dictionary_encode()
        marks = pc.coalesce(pc.struct_field(parted, "marks"), none).dictionary_encode()
        kept, place = self._codes(bare.dictionary.to_numpy(zero_copy_only=False).tolist())
        place = place[bare.indices.to_numpy()]  # of each distinct word's letters
        whole = kept.whole[place]  # of each distinct word: its text goes to the library whole
        pieces = [self._whole(m) for m in marks.dictionary.to_pylist()]
        behind = Kept(np.frombuffer(b"".join(pieces), "<u4"), np.array([len(p) // 4 for p in pieces], np.int64), np.zeros(len(pieces), bool))
        # the ids of each distinct word, its marks behind it, and then of each word
        pairs = np.stack([place, marks.indices.to_numpy() + len(kept.sizes)], axis=1)
        own = Kept.joined([kept, behind]).take(pairs.ravel())
        sizes = own.sizes.reshape(-1, 2).sum(axis=1)
        ids = gathered(own.flat, (np.cumsum(sizes) - sizes)[at], sizes[at]).tobytes()
        firsts = docs.offsets.to_numpy() - docs.offsets[0].as_py()
        cuts = (4 * np.append(0, np.cumsum(sizes[at]))[firsts]).tolist()
        beyond = np.add.reduceat(whole[at], firsts[:-1]) > 0
        return [self._whole(texts[i].as_py()) if far else ids[a + 4 : b] for i, (far, a, b) in enumerate(zip(beyond.tolist(), cuts[:-1], cuts[1:], strict=True))]  # less the line end put before

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text; null texts have none."""
        column = pc.fill_null((texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string()), "")
        chunk = np.cumsum(pc.binary_length(column).to_numpy()) // CHUNK
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(column)]
        return [code for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b for code in self._encoded(column.slice(a, b - a))]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of every whole text, each followed by ``end_id``, in ascending order of id.

    Rows are dealt by ranges of the id and sorted within each, so shard and row order give the order of
    ids. A row is a segment: the ids of some whole documents in patched frame-of-reference blocks, with
    an index of documents and of block starts. Null texts are empty; null ids come first; rows with equal
    ids are ordered by their text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = held(("tokens", tokenizer), lambda: Encoder(tokenizer)), np.array([end_id], "<u4").tobytes()
        shard, first = -1, 0
        ids: list = []
        raw: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal ids, raw, size, first
            flat = np.frombuffer(b"".join(raw), "<u4")
            payload, starts = pack(flat)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([len(flat)], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(x) // 4 for x in raw]], pa.list_(pa.int64())),
                    pa.array([starts], pa.binary()),
                    pa.array([payload], pa.binary()),
                ],
                names=["shard", "first", "n_ids", "doc_ids", "doc_lens", "starts", "payload"],
            )
            first += len(flat)
            ids, raw, size = [], [], 0
            return row

        for batch in batches:
            keys, shards = batch.column(0).to_pylist(), batch.column(2)
            shard = shards[0].as_py() if len(shards) else shard
            for key, code in zip(keys, coder.encode(batch.column(1)), strict=True):
                ids.append(key)
                raw.append(code + end)
                size += len(code) // 4 + 1
                if size >= SEGMENT:
                    yield close()
        if ids:
            yield close()

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("shard", F.spark_partition_id())
    dealt.mapInArrow(run, SEGMENTS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files that write_tokens made."""
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        for batch in batches:
            for row in batch.to_pylist():
                flat = unpack(row["payload"], row["starts"])
                ends = np.cumsum(row["doc_lens"], dtype=np.int64)
                begins = ends - row["doc_lens"]
                crc = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(begins + row["first"] + row["base"], pa.int64()),
                        pa.array(row["doc_lens"], pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = spark.read.schema(SEGMENTS).parquet(path)
    sizes = rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # a row for each shard, as many as a shuffle has tasks
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base"))
    return rows.join(F.broadcast(base), "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids of ``docs`` to a new folder of the shared one and reads them back, as read_tokens does.

    Empty and null texts give their end id only. Repeated rows are written again. An empty table gives an
    empty result. Columns besides id and text are ignored.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, end_id, id_col, text_col)
    return read_tokens(spark, path)
