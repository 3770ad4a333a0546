import hashlib
from math import floor, isfinite

import numpy as np
import pytest

from tessera.llm.vector_codes import SlicedBook, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, v string, code string, p int, error double"


def brute(rows, parts, entries, rounds, scale=4096):
    """Every part against every entry, in Python integers."""
    kept = [(i, [floor(scale * float(np.float32(x))) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not ordered:
        return []
    size = len(ordered[0][1])
    kept, ordered = ([r for r in rs if len(r[1]) == size] for rs in (kept, ordered))
    width = size // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    firsts = {}
    for i, v, _ in ordered:
        firsts.setdefault(i, v)
    books = [list(b) for b in zip(*[cut(v) for v in list(firsts.values())[:entries]], strict=True)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, part: min(range(len(books[p])), key=lambda e: (far(part, books[p][e]), e))
    for _ in range(rounds):
        groups = [{} for _ in range(parts)]
        for _, v, _ in kept:
            for p, part in enumerate(cut(v)):
                groups[p].setdefault(nearest(p, part), []).append(part)
        for p in range(parts):
            for e, members in groups[p].items():
                books[p][e] = tuple(sum(x) // len(members) for x in zip(*members, strict=True))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    coded, by_label = [], {}
    for i, v, c in kept:
        codes = [nearest(p, part) for p, part in enumerate(cut(v))]
        error = sum(far(part, books[p][codes[p]]) for p, part in enumerate(cut(v)))
        coded.append((i, "".join(f"{e:02x}" for e in codes), error, c))
        by_label[c] = by_label.get(c, 0) + error
    return sorted(((i, code, error, by_label[c], digest) for i, code, error, c in coded), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, c, "x", "y", 1, 0.5) for i, v, c in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vector_codes(df, **kw).collect()), key=str)


def test_whole_table_of_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)], int(rng.integers(3)) if i % 7 else None) for i in range(60)]
    rows += [(100, None, 1), (101, [1.0] * 7 + [None], 1), (102, [float("nan")] * 8, 1), (103, [float("-inf")] + [0.0] * 7, 1)]
    rows += [(1, [0.25] * 8, 2), (5, rows[5][1], 0), (5, rows[5][1], 0), (None, [0.5] * 8, None), (104, [1.0] * 4, 1), (-3, [-0.1] * 8, 0)]
    rows += [(200 + i, rows[9][1], 1) for i in range(40)]  # a group of copies
    want = brute(rows, 4, 6, 3)
    assert run(spark, rows, parts=4, entries=6, rounds=3) == want
    assert len(want) == len(rows) - 5


def test_fewer_vectors_than_entries_and_ties(spark):
    rows = [(2, [1.0, 1.0], 0), (1, [0.0, 0.0], 0), (3, [0.5, 0.5], None), (4, [1.0, 1.0], None)]
    assert run(spark, rows, parts=2, rounds=2) == brute(rows, 2, 16, 2)


def test_empty_and_refused(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1), (2, [None], 1)]) == []
    with pytest.raises(ValueError, match="equal parts"):
        run(spark, [(1, [1.0, 2.0, 3.0], 0)], parts=2)
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e30, 1.0], 0)], parts=2)


def test_masks_hold_every_entry_as_near():
    rng = np.random.default_rng(2)
    for spread in (1, 4, 1000):
        book = SlicedBook(rng.integers(-spread, spread + 1, (64, 5)))
        x = rng.integers(-spread - 1, spread + 2, (500, 5))
        far = ((x[:, None] - book.entries[None]) ** 2).sum(axis=2)
        entry, least = book.nearest(x)
        assert (entry == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()
        masks = book.candidates(x)
        held = (masks[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        assert (held[np.arange(500), far.argmin(axis=1)] == 1).all()
        if spread == 1000:
            assert held.mean() < 0.6  # and leaves others out
