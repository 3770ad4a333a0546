import hashlib
import string

from cases import awkward, empty

from tessera.llm.exact_dedup import exact_duplicates

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    out = []
    for i, t in rows:
        own = groups[(t or "").translate(LOW)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted((tuple(r) for r in exact_duplicates(df, **kw).collect()), key=str)


def test_awkward_rows(spark):
    df = awkward(spark)
    assert result(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_hot_group_and_ties(spark):
    rows = [(i, "HOT text" if i % 3 else f"own {i % 50}") for i in range(600)]
    df = awkward(spark, rows)
    want = expected([(r.doc_id, r.text) for r in df.collect()])
    assert result(df) == want
    assert result(df, support=0.3) == want


def test_empty(spark):
    assert result(empty(spark)) == []
