"""Pairs of similar strings without comparing all of them: shortened texts, positional grams, prefixes and bounds on counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.scratch import written

#: Ways to meet: the length of grams, and how many rare grams at once make a key.
SCHEMES = ((1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2), (4, 1))
#: The way to meet on what is left of a text when its unmatched characters are taken out, whichever they are.
SHORTENED = 0
#: Largest number of keys that a text may have for one length of the other: of grams, and of shortened texts with the most characters that may be gone.
MOST_KEYS, MOST_SHORTENED, MOST_GONE = 90, 300, 3
#: Rows of a table of grams that may be broadcast.
MOST_BROADCAST = 1_000_000
#: What a pair costs that is met in vain, in keys.
PAIR_COST = 4


def _letters(text: Column) -> Column:
    """Each character with how often it has stood before: the elements of a multiset as a set."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(chars, lambda c, i: F.concat(c, F.size(F.filter(F.slice(chars, 1, i), lambda d: d == c)).cast("string")))


def _grams(texts: DataFrame) -> DataFrame:
    """(text, m, q, grams): the grams of each length with their places, rarest first."""
    sizes = sorted({q for q, _ in SCHEMES})
    each = texts.select("text", F.length("text").alias("m"), F.explode(F.array(*map(F.lit, sizes))).alias("q")).filter("m >= q")
    each = each.select("text", "m", "q", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("m") - F.col("q") + 1), lambda i: F.substr("text", i, F.col("q")))).alias("i", "g"))
    rarity = written(each.groupBy("q", "g").agg(F.count(F.lit(1)).alias("df")), "rarity")
    # what a text makes is many times its bytes, so it may not be broadcast on a guess
    rarity = F.broadcast(rarity) if rarity.count() <= MOST_BROADCAST else rarity.hint("merge")
    return each.join(rarity, ["q", "g"]).groupBy("text", "m", "q").agg(F.array_sort(F.collect_list(F.struct("df", "g", "i"))).alias("grams"))


def _least_common(threshold: float, m: Column, n: Column) -> Column:
    """Characters that two texts of these lengths have in common, in order, if their ratio is ``threshold`` or more."""
    return F.ceil(threshold * (m + n) / 2 - 1e-9).cast("int")


def _lengths(texts: DataFrame, lengths: DataFrame, threshold: float, mine: str, other: str) -> DataFrame:
    """``texts`` with their length as ``mine``, once for each length of ``lengths`` that may reach the ratio, and the characters then in ``common``."""
    m, n = F.col(mine), F.col(other)
    low, high = F.ceil(m * threshold / (2 - threshold) - 1e-9).cast("int"), F.floor(m * (2 - threshold) / threshold + 1e-9).cast("int")
    rows = texts.withColumnRenamed("m", mine).withColumn(other, F.explode(F.sequence(low, high)))
    rows = rows.join(F.broadcast(lengths.select(F.col("m").alias(other))), other, "left_semi")
    return rows.withColumn("common", _least_common(threshold, m, n)).filter(F.col("common") <= F.least(m, n))


def _prefixes(grams: DataFrame, lengths: DataFrame, threshold: float, mine: str, other: str) -> DataFrame:
    """(text, length of each side, scheme, p): the grams that keys for others of a given length are made of."""
    m, n = F.col(mine), F.col(other)
    rows = _lengths(grams, lengths, threshold, mine, other)
    # a matching block of k characters holds k - q + 1 grams, and every block but one ends at an unmatched character
    needed = F.col("common") * (2 * F.col("q") - 1) - (F.col("q") - 1) * (m + n + 1)
    rows = rows.withColumn("needed", needed)
    made = F.array(*(F.struct(F.lit(q).alias("of"), F.lit(t).alias("together"), F.lit(10 * q + t).alias("scheme")) for q, t in SCHEMES))
    rows = rows.withColumn("way", F.explode(F.filter(made, lambda w: w["of"] == F.col("q")))).withColumns({"together": F.col("way.together"), "scheme": F.col("way.scheme")})
    prefix = m - F.col("q") + 1 - F.col("needed") + F.col("together")
    keys = F.when(F.col("together") == 1, prefix).when(F.col("together") == 2, prefix * (prefix - 1) / 2).otherwise(prefix * (prefix - 1) * (prefix - 2) / 6)
    plain = (F.col("q") == 1) & (F.col("together") == 1)
    rows = rows.filter((F.col("needed") >= F.col("together")) & (plain | (keys <= MOST_KEYS)))
    return rows.select("text", mine, other, "scheme", F.slice("grams", 1, prefix).alias("p"))


def _keys(rows: DataFrame) -> DataFrame:
    """(text, m, n, scheme, key, i): each gram of a prefix, or each two or three of them. Keys are hashes; two that fall together only meet in vain."""
    p, together = F.col("p"), F.col("scheme") % 10
    after = lambda a: F.slice(p, a + 2, F.size(p))
    spelled = lambda *gs: F.xxhash64(*(g["g"] for g in gs)).alias("key")
    one = F.transform(p, lambda x: F.struct(spelled(x), x["i"].alias("i")))
    two = F.flatten(F.transform(p, lambda x, a: F.transform(after(a), lambda y: F.struct(spelled(x, y), x["i"].alias("i")))))
    three = F.flatten(
        F.transform(p, lambda x, a: F.flatten(F.transform(after(a), lambda y, b: F.transform(F.slice(p, a + b + 3, F.size(p)), lambda z: F.struct(spelled(x, y, z), x["i"].alias("i"))))))
    )
    return rows.select("text", "m", "n", "scheme", F.inline(F.when(together == 1, one).when(together == 2, two).otherwise(three)))


def _ways_to_shorten(m: Column, gone: Column) -> Column:
    return F.when(gone == 0, F.lit(1)).when(gone == 1, m).when(gone == 2, m * (m - 1) / 2).otherwise(m * (m - 1) * (m - 2) / 6)


def _may_shorten(threshold: float) -> Column:
    """Whether texts of the lengths m and n have few enough shortened forms to meet on."""
    common = _least_common(threshold, F.col("m"), F.col("n"))
    few = lambda m: ((m - common) <= MOST_GONE) & (_ways_to_shorten(m, m - common) <= MOST_SHORTENED)
    return few(F.col("m")) & few(F.col("n"))


def _shortened(rows: DataFrame, mine: str) -> DataFrame:
    """(text, m, n, scheme, key, i): a text without any of as many characters as may be unmatched; two texts that have ``common`` characters in order share such a key."""
    gone = F.col(mine) - F.col("common")
    without = lambda s, i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1))
    fewer = lambda held: F.flatten(
        F.transform(
            held,
            lambda x: F.transform(F.filter(F.sequence(F.lit(1), F.length(x["s"])), lambda i: i >= x["at"]), lambda i: F.struct(without(x["s"], i).alias("s"), i.alias("at"))),
        )
    )
    forms = [F.array(F.struct(F.col("text").alias("s"), F.lit(1).alias("at")))]
    for _ in range(MOST_GONE):
        forms.append(fewer(forms[-1]))
    left = F.when(gone == 0, forms[0]["s"])
    for n in range(1, MOST_GONE + 1):
        left = left.when(gone == n, forms[n]["s"])
    keys = F.array_distinct(F.transform(left, lambda s: F.xxhash64(s)))
    return rows.select("text", "m", "n", F.lit(SHORTENED).alias("scheme"), F.explode(keys).alias("key"), F.lit(0).alias("i"))


def _chosen(a: DataFrame, b: DataFrame, share: float) -> DataFrame:
    """(m, n, best): the scheme of least cost for each pair of lengths, told from the keys of a share of the texts: pairs met and keys made."""
    place = ["m", "n", "scheme"]
    count = lambda df, out: df.groupBy(*place, "key").agg(F.count(F.lit(1)).alias(out))
    a, b = count(a, "a"), count(b, "b")
    keys = a.groupBy(*place).agg(F.sum("a").alias("a_keys")).join(b.groupBy(*place).agg(F.sum("b").alias("b_keys")), place)
    pairs = a.join(b, [*place, "key"]).groupBy(*place).agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("pairs"))
    cost = PAIR_COST * F.coalesce("pairs", F.lit(0.0)) / share**2 + (F.col("a_keys") + F.col("b_keys")) / share
    return keys.join(pairs, place, "left").groupBy("m", "n").agg(F.min_by("scheme", F.struct(cost, "scheme")).alias("best"))


def _meetings(left: DataFrame, right: DataFrame, threshold: float, sample: int) -> tuple[DataFrame, DataFrame]:
    """What ``meetings`` has, in two: pairs that share a shortened form, and so have enough characters in common and in order, and pairs that share grams."""
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes make many keys, so bytes don't tell the tasks
    grams = written(_grams(left.select("text").union(right.select("text")).filter("text <> ''").repartition(tasks, "text").distinct()), "grams")
    own = lambda df: grams.repartition(tasks, "text").join(df.select("text").distinct(), "text", "left_semi")
    a, b = own(left), own(right)
    length = lambda df: df.select("m").distinct()
    sides = ((a, length(b), "m", "n"), (b, length(a), "n", "m"))
    ways = [_prefixes(df, lengths, threshold, mine, other) for df, lengths, mine, other in sides]
    short = [_lengths(df.filter("q = 1").select("text", "m"), lengths, threshold, mine, other).filter(_may_shorten(threshold)) for df, lengths, mine, other in sides]
    share = min(1.0, sample / max(1, grams.filter("q = 1").count()))
    # each side by a hash of its own, or texts that stand on both would meet themselves too often
    picked = [F.pmod(F.xxhash64("text", F.lit(side)), F.lit(1 << 20)) < round(share * (1 << 20)) for side in range(2)]
    tried = [_keys(w.filter(p)).union(_shortened(s.filter(p), mine)) for w, s, p, (_, _, mine, _) in zip(ways, short, picked, sides, strict=True)]
    chosen = F.broadcast(written(_chosen(*tried, share), "chosen"))
    best = F.coalesce("best", F.when(_may_shorten(threshold), F.lit(SHORTENED)).otherwise(F.lit(11)))  # single characters, where no text of such lengths was looked at
    use = lambda df: df.join(chosen, ["m", "n"], "left")
    named = lambda df, name: df.withColumnsRenamed({"text": name, "i": f"{name}_i"})
    place = ["m", "n", "scheme", "key"]
    a, b = (named(_shortened(use(s).filter(best == SHORTENED), mine), name) for s, (_, _, mine, _), name in zip(short, sides, ("left", "right"), strict=True))
    sure = a.join(b, place).select("left", "right").distinct()
    a, b = (named(_keys(use(w).filter(best == F.col("scheme"))), name) for w, name in zip(ways, ("left", "right"), strict=True))
    apart = F.col("left_i") - F.col("right_i")
    common = _least_common(threshold, F.col("m"), F.col("n"))
    met = a.join(b, place).filter(apart.between(common - F.col("n"), F.col("m") - common))
    return sure, met.select("left", "right").distinct()


def meetings(left: DataFrame, right: DataFrame, threshold: float, sample: int = 500) -> DataFrame:
    """Pairs (left, right) of ``text`` that meet on a key; every pair whose ratio reaches ``threshold`` does.

    A ratio 2M / (m + n) leaves a fixed number of unmatched characters. Where they are few, a text's keys are what is left of it without any as many: texts
    meet that have enough characters in common and in order, and no others, however alike their beginnings are. Else, of a text's grams a known number recurs in the
    other, at places no farther apart than the unmatched ones allow. Of a text's rarest grams, just more than may be missing, some
    are therefore among the other's: one, or two or three at once if as many more are taken. Keys hold the lengths of
    both, so a gram that many texts have is split by them. What serves a pair of lengths best is told from some ``sample`` texts, chosen by
    a hash; any choice meets all pairs, so the sample decides on cost alone.
    """
    sure, met = _meetings(left, right, threshold, sample)
    return sure.union(met)


def similar_candidates(left: DataFrame, right: DataFrame, threshold: float, same: bool = False) -> DataFrame:
    """Pairs (left, right) of ``text`` that may reach a matching ratio of ``threshold``; none that does is lost.

    Texts meet as ``meetings`` has it, and those that meet on grams stay if they have enough letters in common. With ``same`` each
    unordered pair comes once, with its lower text at the left. Empty texts meet none.
    """
    sure, pairs = _meetings(left, right, threshold, 500)
    if same:
        sure, pairs = (df.filter(F.col("left") < F.col("right")) for df in (sure, pairs))
    texts = left.select("text").union(right.select("text")).distinct()
    shown = texts.withColumn("letters", _letters(F.col("text")))
    side = lambda name: shown.select(F.col("text").alias(name), F.col("letters").alias(f"{name}_letters"))
    enough = F.size(F.array_intersect("left_letters", "right_letters")) >= _least_common(threshold, F.length("left"), F.length("right"))
    return sure.union(pairs.join(side("left"), "left").join(side("right"), "right").filter(enough).select("left", "right"))
