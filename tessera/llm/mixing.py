"""Mixing documents so that expected domain totals meet their targets; DataFrame functions only."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import passing_tables, written

#: Characters whose share of a text the classifier sees.
MARKS = ("|", "!", "$", "%", "&", "*", "#", ".", ",")
MOST_DOMAINS = 64


SIZE = len(MARKS) + 1


def with_statistics(df: DataFrame, text: str) -> DataFrame:
    """``df`` with n_tokens and the features f0, f1 and so on of its column ``text``."""
    size = F.length(text)
    shares = {f"f{i + 1}": F.sqrt((size - F.length(F.replace(text, F.lit(c), F.lit("")))) / F.greatest(size, F.lit(1))) for i, c in enumerate(MARKS)}
    return df.withColumns({"n_tokens": F.regexp_count(text, F.lit("\\S+")).cast("long"), "f0": F.log1p(size.cast("double")), **shares})


class Domains:
    """Gaussian naive Bayes of text statistics. The driver holds a row of means and variances for each domain."""

    def __init__(self, rows: list, floor: float = 1e-4):
        self.names = [r["domain"] for r in rows] or ["all"]
        total = sum(r["n"] for r in rows)
        self.terms = [(math.log(r["n"] / total), [(r[f"m{i}"], (r[f"v{i}"] or 0.0) + floor) for i in range(SIZE)]) for r in rows]

    def with_posterior(self, df: DataFrame) -> DataFrame:
        """``df``, which has the features, with the array p of each domain's probability in their place.

        Logs, weights and their sum are columns of their own, so none is computed twice.
        """
        features = [f"f{i}" for i in range(SIZE)]
        if not self.terms:
            return df.withColumn("p", F.array(F.lit(1.0))).drop(*features)
        logs = {}
        for k, (prior, moments) in enumerate(self.terms):
            score = F.lit(prior)
            for name, (mean, var) in zip(features, moments, strict=True):
                score = score - F.pow(F.col(name) - mean, F.lit(2.0)) / (2 * var) - 0.5 * math.log(var)
            logs[f"l{k}"] = score
        df = df.withColumns(logs).drop(*features)
        df = df.withColumn("top", F.greatest(*logs) if len(logs) > 1 else F.col("l0"))
        weights = {f"w{k}": F.exp(F.col(f"l{k}") - F.col("top")) for k in range(len(logs))}
        df = df.withColumns(weights).drop("top", *logs)
        return df.withColumn("all", sum((F.col(w) for w in weights), F.lit(0.0))).withColumn("p", F.array(*(F.col(w) / F.col("all") for w in weights))).drop("all", *weights)


def _fit_domains(stats: DataFrame, labelled: DataFrame, id_col: str) -> Domains:
    known = labelled.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col("domain").cast("string")).alias("domain")).filter(F.col("domain").isNotNull())
    moments = [f(f"f{i}").alias(f"{name}{i}") for i in range(SIZE) for name, f in (("m", F.avg), ("v", F.var_pop))]
    rows = stats.join(known, "doc_id").groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *moments).orderBy("domain").limit(MOST_DOMAINS + 1).collect()
    if len(rows) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains")
    return Domains(rows)


def _totals(df: DataFrame, rate: Column, k: int) -> np.ndarray:
    mass = rate * F.col("n_tokens")
    row = df.agg(*(F.coalesce(F.sum(mass * F.element_at("p", i + 1)), F.lit(0.0)).alias(f"t{i}") for i in range(k))).first()
    return np.array(list(row), float)


class Mix:
    """Domains and the gradient steps that took every document's rate from 1 to its own.

    A step is (pull, move): a document moves by ``move`` against its posterior and back to ``least`` where it falls below;
    one that is at ``least`` already, and that the gradient ``pull`` would push further down, stays.
    """

    def __init__(self, domains: Domains, least: float):
        self.domains, self.least, self.steps = domains, least, []
        self.residual = 0.0  # the largest miss of a domain's total, as a share of what the domain has

    def _along(self, weights: Column) -> Column:
        return sum((F.element_at("p", i + 1) * F.element_at(weights, i + 1) for i in range(len(self.domains.names))), F.lit(0.0))

    def free(self, rate: Column, pull: Column) -> Column:
        return (rate > self.least) | (self._along(pull) < 0)

    def folded(self, steps: list[tuple[list[float], list[float]]], rate: Column) -> Column:
        """The rate after ``steps``."""
        if not steps:
            return rate
        listed = F.array(*(F.struct(F.lit(pull).alias("pull"), F.lit(move).alias("move")) for pull, move in steps))
        return F.aggregate(listed, rate, lambda r, s: F.when(self.free(r, s["pull"]), F.greatest(F.lit(self.least), r - self._along(s["move"]))).otherwise(r))

    def rated(self, df: DataFrame) -> DataFrame:
        """``df``, which has n_tokens and p, with the rate that all steps lead to."""
        return df.withColumn("rate", F.when(F.col("n_tokens") > 0, self.folded(self.steps, F.lit(1.0))).otherwise(F.lit(1.0)))


def fit_mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float] | None = None,
    budget: float | None = None,
    share: float | None = None,
    least_rate: float = 0.0,
    temperature: float = 0.9,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 100,
    tolerance: float = 1e-4,
    write_each: int = 8,
) -> Mix:
    """Least squares by projected gradient, as mixing_rates describes."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    stats = written(with_statistics(texts, "text").drop("text"), "statistics")
    mix = Mix(_fit_domains(stats, labelled, id_col), float(least_rate))
    state = written(mix.domains.with_posterior(stats.drop("doc_id")).withColumn("rate", F.lit(1.0)), "posteriors")
    k = len(mix.domains.names)
    start = _totals(state, F.col("rate"), k)
    there = start > 1e-9 * max(1.0, start.sum())
    weights = start**temperature if targets is None else np.array([float(targets.get(d, 0.0)) for d in mix.domains.names])
    weights = np.where(there, weights, 0.0)
    if not weights.sum() > 0:
        return mix
    weights = weights / weights.sum()
    if share is not None:
        budget = share * start.sum()
    total = budget if budget is not None else max(start[i] / weights[i] for i in range(k) if weights[i] > 0)
    want, scale = np.where(there, weights * total, 0.0), np.where(there, start, np.inf)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    p = [F.element_at("p", i + 1) for i in range(k)]
    state = state.filter(F.col("n_tokens") > 0)
    pending: list[tuple[list[float], list[float]]] = []
    now, far = start, lambda totals: float((np.where(there, (totals - want) / scale, 0.0) ** 2).sum())
    for _ in range(rounds):
        pull = np.where(there, (now - want) / scale, 0.0)
        mix.residual = float(np.abs(pull).max())
        if mix.residual < tolerance:
            return mix
        rate = mix.folded(pending, F.col("rate"))
        free = state.withColumn("rate", rate).filter(mix.free(F.col("rate"), F.lit(pull.tolist())))
        second = free.agg(*(F.coalesce(F.sum(F.col("n_tokens") * p[i] * p[j]), F.lit(0.0)).alias(f"g{i}_{j}") for i, j in pairs)).first()
        gram = np.zeros((k, k))
        for (i, j), g in zip(pairs, second, strict=True):
            gram[i, j] = gram[j, i] = g if there[i] and there[j] else 0.0
        move, size, before = np.linalg.pinv(gram, rcond=1e-12, hermitian=True) @ np.where(there, now - want, 0.0), 1.0, far(now)
        while size > 1e-6:  # a step is halved until it lowers the errors
            step = (pull.tolist(), (size * move).tolist())
            after = _totals(state, mix.folded([*pending, step], F.col("rate")), k)
            if far(after) < before * (1 - 1e-4 * size):
                break
            size /= 2
        else:
            return mix  # no nonnegative rates come nearer
        mix.steps.append(step)
        pending.append(step)
        now = after
        if len(pending) == write_each:
            state, pending = written(state.withColumn("rate", mix.folded(pending, F.col("rate"))), "rates"), []
    raise RuntimeError(f"totals still move after {rounds} rounds, and miss their targets by {mix.residual:.3g}")


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_tokens, posterior, rate) for each row: how often a document should be drawn.

    A classifier learned from the (id, domain) rows of ``labelled`` gives each document its posterior over
    domains. Rates are least squares by projected gradient: from 1, each step moves a document's rate against
    the gradient of the squared errors of domain totals and puts it back to ``least_rate`` (0 or more) where it falls below. A domain's total is
    the sum over documents of rate, tokens and posterior. The gradient is scaled by the inverse Gram matrix of the documents that are free to move, so
    a step that nothing stops meets all targets; else it is halved until the errors fall. A step is two distributed sums, of as
    many numbers as there are pairs of domains, and of domains; each ``write_each`` steps the rates are written to the shared folder.

    ``targets`` weighs the domains (scaled to sum 1; a domain without one gets nothing); left out, a
    domain's weight is its share of tokens to the power ``temperature``. ``budget`` is the total of tokens
    wanted, or ``share`` of those there are; left out, the least with which no domain has to shrink. A domain
    that no document belongs to can't be raised and is left aside. Steps end when no total misses its target by more than
    ``tolerance`` of what its domain has, or when none lowers the errors any more, which is where no nonnegative rates meet all
    targets; ``rounds`` of them without that are an error. residual, the same in every row, is the largest miss of a total
    as a share of what its domain has.

    Tokens are runs of what is not ASCII white space. Null and empty texts have none and keep rate 1. Of several
    domains for an id the last in order counts. Without labelled rows there is one domain. Repeated rows stay;
    other columns are ignored; an empty table gives an empty result.
    """
    with passing_tables(docs.sparkSession):
        mix = fit_mix(docs, labelled, targets, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return mix.rated(mix.domains.with_posterior(with_statistics(rows, "text").drop("text"))).select("doc_id", "n_tokens", F.col("p").alias("posterior"), "rate", F.lit(mix.residual).alias("residual"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, text_col: str = "text", seed: int = 42, **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its rate says.

    A rate's whole part is certain; its fraction is met where a hash of the row falls below it, so that totals
    are right in expectation and a rerun draws the same. Rows without a token keep rate 1, and so one copy; rows
    that repeat another in every column are drawn alike. Columns of any names stay; an empty table stays empty.
    """
    with passing_tables(docs.sparkSession):
        mix = fit_mix(docs, labelled, targets, text_col=text_col, **options)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rated = mix.rated(mix.domains.with_posterior(with_statistics(rows, "text").drop("text")))
    chance = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(1 << 40)) / float(1 << 40)
    copies = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("int")
    return rated.select("row", copies.alias("copies")).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).select("row.*")
