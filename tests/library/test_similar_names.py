import difflib
import math
import random

import pytest

from tessera.operators import resolve, similar


def mangled(rnd, name, letters):
    """A near copy: a letter changed, dropped, added or moved."""
    at = rnd.randrange(len(name))
    kind = rnd.randrange(4)
    if kind == 0:
        return name[:at] + rnd.choice(letters) + name[at + 1 :]
    if kind == 1:
        return name[:at] + name[at + 1 :]
    if kind == 2:
        return name[:at] + rnd.choice(letters) + name[at:]
    return name[1:] + name[0]


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "text string")


@pytest.mark.parametrize(("letters", "longest", "threshold"), [("ab", 12, 0.86), ("abcdef ", 24, 0.86), ("aé漢😀 ", 16, 0.9), ("abcdefghij", 40, 0.75)])
def test_no_pair_at_the_ratio_is_lost(spark, letters, longest, threshold):
    rnd = random.Random(len(letters) * longest)
    names = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, longest))) for _ in range(60)}
    for n in list(names):
        names.add(mangled(rnd, mangled(rnd, n, letters) or "a", letters) or "a")
    names |= {"aaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaa", "abababababab", "babababababa"}
    names = sorted(names)
    near = {(a, b) for a in names for b in names if difflib.SequenceMatcher(None, a, b, False).ratio() >= threshold}
    got = {(r.left, r.right) for r in similar.similar_candidates(frame(spark, names), frame(spark, names[::2]), threshold).collect()}
    assert len(near) > len(names)
    assert {(a, b) for a, b in near if b in set(names[::2])} <= got
    same = {(r.left, r.right) for r in similar.similar_candidates(frame(spark, names), frame(spark, names), threshold, same=True).collect()}
    assert {(a, b) for a, b in near if a < b} <= same and all(a < b for a, b in same)


def test_codes_that_share_most_of_their_letters(spark):
    names = [f"supplier {i:09d}" for i in range(0, 900, 7)]
    near = {(a, b) for a in names for b in names if a < b and difflib.SequenceMatcher(None, a, b).ratio() >= 0.9}
    got = {(r.left, r.right) for r in similar.similar_candidates(frame(spark, names), frame(spark, names), 0.9, same=True).collect()}
    assert near <= got


def test_pairs_grow_with_the_names(spark):
    """At 1 and 16 times the names, of which every second is a near copy, met pairs and candidates grow by a power below 1.3."""
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    counts = []
    for n in (300, 4800):
        base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(12, 24))) for _ in range(n // 2)]
        names = frame(spark, sorted({*base, *(mangled(rnd, b, letters) for b in base)}))
        counts.append((similar.meetings(names, names, 0.86).filter("left < right").count(), similar.similar_candidates(names, names, 0.86, same=True).count()))
    for one, sixteen in zip(*counts, strict=True):
        assert math.log(sixteen / one, 16) < 1.3, counts
        assert one >= 140


def test_codes_meet_on_what_is_left_of_them(spark):
    """Names that differ by their digits meet only if enough characters recur in order, however many share the rest."""
    for n in (500, 4000):
        names = [f"supplier {i * 89:09d}" for i in range(n)]
        digits = [name[9:] for name in names]
        fewer = {}
        for d in digits:
            for short in {d[:i] + d[i + 1 :] for i in range(9)}:
                fewer.setdefault(short, []).append(d)
        pairs = {(a, b) for same in fewer.values() for a in same for b in same if a < b}
        met = {(r.left[9:], r.right[9:]) for r in similar.meetings(frame(spark, names), frame(spark, names), 0.9).filter("left < right").collect()}
        assert pairs <= met and len(met) <= 1.1 * len(pairs), (n, len(pairs), len(met))


def test_ratio_is_that_of_difflib(spark):
    rnd = random.Random(11)
    for letters, longest in (("ab", 14), ("abc ", 25), ("aé漢😀 ", 30), ("ab", 260)):
        for _ in range(300):
            a, b = ("".join(rnd.choice(letters) for _ in range(rnd.randint(0, longest))) for _ in range(2))
            b = rnd.choice((b, a[: len(b)] + b[:2] + a[len(b) + 1 :]))
            assert resolve.matching_ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio()


def test_empty_tables_and_texts(spark):
    none = frame(spark, [])
    assert similar.similar_candidates(none, none, 0.9).collect() == []
    assert similar.similar_candidates(frame(spark, ["", None, "a"]), frame(spark, ["", "a", "b"]), 0.9).collect() == [("a", "a")]
    assert resolve.with_ratio(similar.similar_candidates(frame(spark, ["x"]), none, 0.9)).collect() == []
