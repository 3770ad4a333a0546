import random

import pytest
import xxhash
from cases import awkward, empty

from tessera.llm.components import connected_components
from tessera.llm.simhash import fingerprint, links, near_duplicates


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", "a", "A b", "a b c", "The cat sat\ton the mat\n" * 7, "É Ü ß x y"])
def test_fingerprint(text):
    assert fingerprint(text.encode(), 3, 42) == signed(plain_fingerprint(text))


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_against_all_pairs(spark, radius):
    rnd = random.Random(radius)
    fps = {rnd.getrandbits(64) for _ in range(40)} | {0}
    for _ in range(160):
        x = rnd.choice(sorted(fps))
        for _ in range(rnd.randint(1, 4)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    fps = sorted(map(signed, fps))
    got = links(spark.createDataFrame([(x,) for x in fps], "fp long"), radius)
    roots = {r.id: r.root for r in connected_components(got).collect()}
    close = [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]
    assert {x: roots.get(x, x) for x in fps} == components(fps, close)


def test_documents_against_all_pairs(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(100 + i, base + " tail" * i) for i in range(8)] + [(200, base.replace("w7 ", "x7 ")), (201, base.upper())]
    df = awkward(spark, rows)
    got = near_duplicates(df).collect()
    docs = [(r.doc_id, r.text or "") for r in df.collect()]
    prints = {(i, t): plain_fingerprint(t) for i, t in docs}
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{prints[i, t]:016x}") for i, t in docs)
    ids = sorted({i for i, _ in docs if i is not None})
    by = [(i, fp) for (i, _), fp in prints.items() if i is not None]
    want = components(ids, [(a, b) for a, x in by for b, y in by if a < b and (x ^ y).bit_count() <= 3])
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want


def test_empty(spark):
    assert near_duplicates(empty(spark)).collect() == []


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in connected_components(edges).collect()} == {0}
