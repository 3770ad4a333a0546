import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from cases import awkward, empty

from tessera.llm.lattice_lm import ALPHA, Lattice, lm_scores, pieces, words_of

PATH = public_tokenizers.path("piece_bpe_32k.model")


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def all_segmentations(word, score, byte):
    s = "▁" + word
    if not s:
        return [0.0]

    def walk(at):
        if at == len(s):
            yield 0.0
        for j in range(at + 1, len(s) + 1):
            v = score.get(s[at:j])
            if v is None and j == at + 1:
                v = sum(byte[b] for b in s[at].encode())
            if v is not None:
                for rest in walk(j):
                    yield v + rest

    return list(walk(0))


def test_marginal_is_the_sum_over_segmentations():
    import numpy as np

    seen = np.random.default_rng(1).integers(0, 50, pieces(PATH).get_piece_size())
    lattice = Lattice(PATH, seen, 10)
    for word in ("the", "nation", "éa", "漢", "x😀y", "and.", "q"):
        every = all_segmentations(word, lattice.score, lattice.byte)
        assert math.isclose(lattice.log_probability(word), math.log(sum(map(math.exp, every))), rel_tol=1e-9)
    total = sum(map(math.exp, lattice.score.values())) + sum(map(math.exp, lattice.byte)) + math.exp(lattice.end)
    assert total <= 1 and lattice.log_probability("z" * 3000) < -3000


def expected(rows):
    train = Counter(w for i, t in rows if not held(i) for w in words_of(t.encode()))
    ends = sum(not held(i) for i, _ in rows)
    n, v = sum(train.values()) + ends, len(train) + bool(ends)
    import numpy as np

    model, seen = pieces(PATH), np.zeros(pieces(PATH).get_piece_size())
    for w, c in train.items():
        for p in model.encode(w.decode()):
            seen[p] += c
    lattice, out = Lattice(PATH, seen, ends), []
    for i, t in rows:
        words = words_of(t.encode())
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        score = (sum(lattice.log_probability(w.decode()) for w in words) + lattice.end) / math.log(10)
        out.append((i, held(i), len(words) + 1, sum(train[w] > 0 for w in words) + (ends > 0), n, base, score))
    return out


@pytest.mark.parametrize("heads", [0, 5, 1000])
def test_rows_against_plain_counts(spark, heads):
    df = awkward(spark, [(i, f"Common words here the the {i % 9} tail{i} " + "x" * (i % 90)) for i in range(20, 90)])
    got = sorted((tuple(r) for r in lm_scores(df, heads=heads).collect()), key=str)
    want = sorted(expected([(r.doc_id, r.text or "") for r in df.collect()]), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9)


def test_nothing_to_learn_from(spark):
    only = next(i for i in range(100) if held(i))
    row = lm_scores(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and row.score < 0
    assert lm_scores(empty(spark)).collect() == []
    assert ALPHA > 0
