import numpy as np
from cases import awkward, empty
from pyspark.sql import functions as F

from tessera.llm.mixing import MARKS, fit_mix, mixed, mixing_rates

DATA = "/root/testdata/sf0.01"


def tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    return docs, labels.select("doc_id", F.concat(F.lit("q"), "quality").alias("domain"))


def plain(docs, labelled, targets, budget, least):
    x = {r.doc_id: np.array([np.log1p(len(r.text or "")), *(np.sqrt((r.text or "").count(c) / max(1, len(r.text or ""))) for c in MARKS)]) for r in docs}
    n = {r.doc_id: len((r.text or "").split()) for r in docs}
    names = sorted(set(labelled.values()))
    logs = []
    for d in names:
        own = np.array([x[i] for i, v in labelled.items() if v == d and i in x])
        mean, var = own.mean(axis=0), own.var(axis=0) + 1e-4
        logs.append({i: np.log(len(own) / len([i for i in labelled if i in x])) - (((f - mean) ** 2) / (2 * var) + np.log(var) / 2).sum() for i, f in x.items()})
    ids = sorted(x)
    s = np.array([[l[i] for l in logs] for i in ids])
    p = np.exp(s - s.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    tokens = np.array([n[i] for i in ids], float)
    want = np.array([targets[d] for d in names]) * budget
    rate, start = np.ones(len(ids)), tokens @ p
    for _ in range(20_000):
        rate = np.maximum(least, rate - 0.5 * (p @ ((rate * tokens) @ p / start - want / start)) )
    return dict(zip(ids, rate, strict=True)), p, ids


def test_rates_against_plain_descent(spark):
    docs, domains = tables(spark)
    labelled = {r.doc_id: r.domain for r in domains.collect()}
    targets, budget = {"q0": 0.3, "q1": 0.7}, 500_000.0
    want, p, ids = plain(docs.collect(), labelled, targets, budget, 0.0)
    rows = mixing_rates(docs, domains, targets, budget=budget).collect()
    got = {r.doc_id: r for r in rows}
    assert np.allclose([got[i].rate for i in ids], [want[i] for i in ids], atol=2e-3)
    assert np.allclose([got[i].posterior for i in ids], p, atol=1e-6)
    totals = sum(np.array(r.posterior) * r.rate * r.n_tokens for r in rows)
    assert np.allclose(totals, [0.3 * budget, 0.7 * budget], rtol=1e-3)
    assert min(r.rate for r in rows) >= 0
    assert all(r.residual < 1e-3 for r in rows)
    half = mixing_rates(docs, domains, targets, share=0.5).collect()
    assert np.isclose(sum(r.rate * r.n_tokens for r in half), sum(r.n_tokens for r in half) / 2, rtol=1e-3)


def test_some_rates_stop_at_zero(spark):
    docs, domains = tables(spark)
    rows = mixing_rates(docs, domains, {"q0": 0.0, "q1": 1.0}, budget=300_000.0).collect()
    assert min(r.rate for r in rows) == 0.0
    totals = sum(np.array(r.posterior) * r.rate * r.n_tokens for r in rows)
    assert totals[0] < 0.02 * totals[1]


def test_copies_meet_the_rates(spark):
    docs, domains = tables(spark)
    rates = {r.doc_id: r.rate for r in mixing_rates(docs, domains, least_rate=1.0).collect()}
    out = mixed(docs, domains, least_rate=1.0)
    assert out.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(copies) == set(rates)  # nothing is lost
    assert all(abs(copies[i] - rates[i]) < 1 for i in rates)
    assert abs(sum(copies.values()) - sum(rates.values())) < 4 * len(rates) ** 0.5


def test_awkward_rows(spark):
    df = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, domain string")
    rows = mixing_rates(df, none).collect()
    assert len(rows) == df.count() and all(abs(r.rate - 1) < 1e-9 and list(r.posterior) == [1.0] for r in rows)
    some = spark.createDataFrame([(1, "a"), (1, "b"), (6, "a"), (8, None), (None, "c")], "doc_id long, domain string")
    rows = mixing_rates(df, some).collect()
    assert len(rows) == df.count() and all(np.isfinite(r.rate) for r in rows)
    assert all(r.rate == 1.0 for r in rows if r.n_tokens == 0)
    assert mixing_rates(empty(spark), some).collect() == [] and mixed(empty(spark), some).collect() == []
    assert sorted(map(str, mixed(df, none).collect())) == sorted(map(str, df.collect()))


def test_no_python_in_the_plan(spark):
    docs, domains = tables(spark)
    plan = mixing_rates(docs, domains)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert fit_mix(docs, domains).steps
