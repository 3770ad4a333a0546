import re
from collections import Counter

import numpy as np
from cases import awkward, empty

from tessera.llm import divergence
from tessera.llm.divergence import joint_prices, source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least_docs, top=50):
    """Every two sources, term by term."""
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    out = []
    for lang in {r[1] for r in rows}:
        df, counts = Counter(), {}
        for t, of, s in rows:
            if of == lang:
                found = ["".join(c.lower() if c.isascii() else c for c in w) for w in TERM.findall(t)]
                counts.setdefault(s, Counter()).update(found)
                df.update(set(found))
        kept = sorted(t for t, n in df.items() if n >= least_docs)
        price = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[t] for t in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: price(c) for s, c in counts.items()}, price(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s]
            words = [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in source_divergence(df, **kw).collect())


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, "k", 0.5, "z") for i, (t, lang, s) in enumerate(rows)], "doc_id long, text string, lang string, source string, n long, term string, p double, zero string").repartition(3)


def test_every_pair_and_term(spark):
    rng = np.random.default_rng(1)
    words = ["alpha", "Beta", "GAMMA", "délta", "Délta", "x1y", "漢字", "ÿ", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150))]
    rows = []
    for i in range(160):
        text = " ".join(words[int(k)] for k in rng.zipf(1.3, 60) % len(words)) + (" 12-34_alpha.beta" if i % 3 else "")
        rows.append((text, ["en", "de", None][i % 3], f"s{int(rng.integers(8)) if i % 2 else 1}"))
    rows += [(None, "en", "silent"), ("", "fr", "only"), ("one two", "fr", None), ("zz " * 2000, "en", "s1"), rows[0], rows[0]]
    df = documents(spark, rows)
    want = brute(rows, 5)
    assert run(df, least_docs=5) == want
    assert run(df, least_docs=5, block_terms=20, block_sources=3, top=7) == brute(rows, 5, 7)


def test_awkward_rows_and_empty(spark):
    df = awkward(spark)
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    assert run(df) == brute(rows, 30)
    assert run(df, least_docs=1) == brute(rows, 1)
    assert run(empty(spark)) == []


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert [w for part in divergence.terms("Some long-text of ÉCU words".encode()) for w in part if w] == [w.encode() for w in ("some", "long", "text", "of", "Écu", "words")]


def test_joint_tables_count_every_pair_of_levels():
    rng = np.random.default_rng(2)
    level = rng.integers(0, 4, (50, 5))
    cost = {(s, n): int(rng.integers(1000)) for s in range(5) for n in range(4)}

    def side(sources):
        cells = [(r, k, level[r, s], cost[s, level[r, s]]) for k, s in enumerate(sources) for r in range(50) if level[r, s]]
        cells += [(-1, k, 0, cost[s, 0]) for k, s in enumerate(sources)]
        return tuple(np.array(x) for x in zip(*cells, strict=True))

    got = joint_prices(50, side([0, 1, 2]), side([3, 4]))
    want = [[sum(abs(cost[a, level[r, a]] - cost[b, level[r, b]]) for r in range(50)) for b in (3, 4)] for a in (0, 1, 2)]
    assert got.tolist() == want
