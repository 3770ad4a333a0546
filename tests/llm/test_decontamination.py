import random

from cases import awkward, empty

from tessera.llm.decontamination import best_match, contaminated, distances, normalised, pieces, without_contaminated


def plain(pattern, text):
    """Least distance between the pattern and what ends at each place, by the whole table."""
    row = list(range(len(pattern) + 1))
    out = []
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        out.append(row[-1])
    return out


def edited(rnd, text, n):
    s = list(text)
    for _ in range(n):
        at = rnd.randrange(len(s))
        match rnd.randrange(3):
            case 0:
                s[at] = rnd.choice("abcdé")
            case 1:
                s.insert(at, rnd.choice("abcdé"))
            case _:
                del s[at]
    return "".join(s)


def test_distances():
    rnd = random.Random(5)
    for _ in range(400):
        p = "".join(rnd.choice("abé ") for _ in range(rnd.randint(1, 90)))
        t = "".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 60)))
        assert list(distances(p, t)) == plain(p, t)


def test_pieces_cover_the_item():
    for size in (1, 7, 20, 101):
        for budget in range(min(size, 8)):
            cut = pieces(size, budget)
            assert len(cut) == budget + 1 and cut[0][0] == 0 and cut[-1][1] == size
            assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(cut, cut[1:], strict=False))


def test_documents_against_the_whole_table(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    items = [(k, " ".join(word() for _ in range(rnd.choice([3, 8, 16])))) for k in range(25)] + [(90, None), (91, ""), (92, "x" * 4), (None, "no item number but words enough")]
    docs = []
    for d in range(50):
        parts = [word() for _ in range(rnd.randint(0, 40))]
        if d % 2:
            item = rnd.choice(items[:25])[1]
            parts.insert(rnd.randint(0, len(parts)), edited(rnd, item.upper() if d % 3 else item, rnd.randint(0, len(item) // 15)))
        docs.append((1000 + d, "\n ".join(parts)))
    df = awkward(spark, docs)
    bench = spark.createDataFrame([(k, t, None) for k, t in items], "item_id long, text string, doc_id string")
    want = set()
    for r in df.collect():
        text = normalised(r.text)
        for k, raw in items:
            item = normalised(raw)
            budget = len(item) // 20
            if item and text and min(plain(item, text), default=99) <= budget:
                found = plain(item, text)
                want.add((r.doc_id, k, min(found), found.index(min(found)) + 1))
    for block_chars in (2_000_000, 300):
        got = contaminated(df, bench, block_chars=block_chars).collect()
        assert {(r.doc_id, r.item_id, r.distance, r.end) for r in got} == want
        for r in got:
            text = next(normalised(x.text) for x in df.collect() if x.doc_id == r.doc_id)
            item = normalised(dict(items)[r.item_id])
            assert plain(item, text[r.start : r.end])[-1] <= r.distance or r.distance == 0 and text[r.start : r.end] == item
    kept = without_contaminated(df, bench)
    bad = {w[0] for w in want}
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if r.doc_id not in bad)


def test_best_match():
    assert best_match("hello there", "xx helo there yy", 2) == (1, 3, 13)
    assert best_match("hello", "nothing", 1) is None and best_match("abc", "", 0) is None


def test_empty(spark):
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert contaminated(empty(spark), bench).collect() == []
    assert contaminated(awkward(spark), bench.limit(0)).collect() == []
