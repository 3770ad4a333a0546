import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import awkward, empty
from tokenizers import Tokenizer

from tessera.llm.tokens import Encoder, pack, token_files, unpack

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_blocks_round_trip(n):
    rnd = np.random.default_rng(n)
    for top in (1, 2, 300, 50_000, 2**32):
        ids = rnd.integers(0, top, n, dtype=np.uint32)
        ids[rnd.random(n) < 0.02] = 2**32 - 1
        payload, starts = pack(ids)
        assert np.array_equal(unpack(payload, starts), ids)
        assert len(starts) == 4 * -(-n // 1024)


def test_encoder_is_the_library():
    library, rnd = Tokenizer.from_file(PATH), random.Random(1)
    parts = ["The", "it's", "é", "12", "!!", "漢字", "<|endoftext|>", " ", "  ", "\n", "\n\n", "\t", " ", " ", "\x1c", "\x00", "Ġ", "", "a|b", "x's"]
    texts = ["", " ", "\n", "a\nb", "a \nb", "a\n b"] + ["".join(rnd.choice(parts) + rnd.choice(["", " ", "\n"]) for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    texts += [" ".join(rnd.choice(["the", "cat's", "sat.", "É", "99", "foo-bar", "Ġx"]) for _ in range(9)) + "\nnext line" for _ in range(500)]
    coder = Encoder(PATH)
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr("tessera.llm.tokens.CACHE", 6)
    library, coder = Tokenizer.from_file(PATH), Encoder(PATH)
    for n in range(20):
        texts = [" ".join(f"w{(n + i) % 9}" for i in range(k)) + "\nq" * (n % 3) for k in range(1, 9)]
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_documents(spark):
    df = awkward(spark, [(i, f"Doc {i} " * (i % 40)) for i in range(400, 9, -1)])
    library = Tokenizer.from_file(PATH)
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want, at = [], 0
    for i, t in rows:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((tuple(r) for r in token_files(df).collect()), key=lambda r: r[1]) == want


def test_empty(spark):
    assert token_files(empty(spark)).collect() == []


def test_words_with_marks_take_no_place_in_the_cache():
    library, coder, rnd = Tokenizer.from_file(PATH), Encoder(PATH), random.Random(3)
    coder.encode(["sat, sat. sat!? sat"])
    assert set(coder.words) == {"\nsat", "sat"}
    parts = ["sat", "Übër", "naïve", "ǅ", "×", "x²", "don't", "9", ",", ".", "%%%", "_", "'", "''", "<|", "endoftext", "|>", "(", "\n", " ", "̀", "ɐ", "Ġ"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(5000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_of_kept_words_stand_in_flat_arrays(monkeypatch):
    monkeypatch.setattr("tessera.llm.tokens.CACHE", 40)
    library, coder, rnd = Tokenizer.from_file(PATH), Encoder(PATH), random.Random(5)
    words = [f"stri{chr(97 + i % 26)}ng{chr(97 + i // 26)}" for i in range(60)] + ["a b", "<|endoftext|>", "é", "x's"]
    for n in range(40):  # words stay, move from the older half, and are learned anew
        texts = [rnd.choice(" \n").join(rnd.sample(words[n % 20 : n % 20 + 44], rnd.randint(1, 9))) for _ in range(3)]
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(coder.words) == len(coder.kept.sizes) and coder.kept.sizes.sum() == len(coder.kept.flat)
        for half, kept in ((coder.words, coder.kept), (coder.older, coder.older_kept)):
            for w, at in half.items():
                if not kept.whole[at]:
                    assert kept.take(np.array([at])).flat.tolist() == library.encode(w if w[:1] == "\n" else " " + w, add_special_tokens=False).ids
