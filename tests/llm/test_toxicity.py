import zlib
from unittest.mock import MagicMock

import numpy as np
import pytest
from cases import awkward, empty
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm.toxicity import _counted, _encoded, fit, minimised, noisy_or_gradient, sentences, toxicity

DATA = "/root/testdata/sf0.1"


def test_gradient_is_the_slope():
    rnd = np.random.default_rng(1)
    y, doc = np.array([1, 0, 1, 0]), np.array([0, 0, 1, 2, 3, 3])
    sent, cols = np.array([0, 0, 1, 2, 3, 4, 5, 5]), np.array([0, 1, 1, 2, 0, 2, 1, 1])
    w = rnd.normal(0, 0.5, 4)
    loss, gradient = noisy_or_gradient(w, y, doc, sent, cols)
    for i in range(4):
        step = np.eye(4)[i] * 1e-6
        slope = (noisy_or_gradient(w + step, y, doc, sent, cols)[0] - loss) / 1e-6
        assert abs(slope - gradient[i]) < 1e-4


def test_gradient_without_entries():
    none = np.array([], np.int64)
    loss, gradient = noisy_or_gradient(np.array([0.3, -1.0]), np.array([1, 0]), none, none, none)
    assert gradient.dtype == float and (gradient == 0).all()
    assert np.isclose(loss, -np.log(1e-9))  # a toxic document of which nothing is known


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_length_alone_is_no_toxicity(spark, sf):
    """5,000 sentences that say nothing, and clean documents glued to 100,000 characters, score as clean at every size of the labelled table."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    assert model.score(b"zzqx wwvk jjt. " * 5000)[0] == 0
    plain = {r.doc_id for r in labels.collect() if not r.toxic and r.quality}
    glued, parts = b"", []
    for r in sorted(docs.collect(), key=lambda r: zlib.crc32(b"%d" % r.doc_id)):
        if r.doc_id in plain and r.text:
            glued += r.text.encode() + b". "
        if len(glued) > 100_000:
            parts.append(model.score(glued)[0])
            glued = b""
    parts = parts[:20]
    assert parts and sum(p >= 0.5 for p in parts) <= len(parts) // 20


def test_held_out_labels_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r.doc_id: r.score for r in toxicity(docs, x).collect()} for x in (labels, turned))
    assert all(abs(one[i] - two[i]) < 1e-3 for i in one)


def test_minimum():
    a = np.diag([1.0, 30.0, 400.0])
    x = minimised(lambda x: ((x - 2) @ a @ (x - 2), 2 * a @ (x - 2)), np.zeros(3), 60, 1e-8)
    assert np.allclose(x, 2, atol=1e-6)


def test_fits_agree(spark):
    """One model from the same rows, however they are dealt to tasks."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    one, two = ({r.doc_id: r.score for r in toxicity(docs.repartition(n), labels).collect()} for n in (1, 7))
    assert all(abs(one[i] - two[i]) < 1e-3 for i in one)


def test_sentences():
    text = "One two. Trois é! \n4 5? six".encode()
    assert [(text[a:b], w) for a, b, w in sentences(text)] == [
        (b"One two", {b"one", b"two"}),
        (" Trois é".encode(), {b"trois", "é".encode()}),
        (b" six", {b"six"}),
    ]
    assert list(sentences(b"")) == [] and list(sentences(b"1 2. 3!")) == []


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: (r.toxic, r.quality) for r in labels.collect()}
    held = [(r.predicted, *truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    toxic = [p for p, t, q in held if t and q]  # the junk of low quality has lost its words
    clean = [p for p, t, _ in held if not t]
    assert sum(toxic) / len(toxic) > 0.93
    assert sum(clean) / len(clean) < 0.01
    junk = [p for p, t, q in held if t and not q]  # few of them have a toxic word left whole
    assert sum(junk) / len(junk) > 0.25
    by = {r.doc_id: r.text for r in docs.collect()}
    found = [by[r.doc_id][s.start : s.end] for r in rows for s in r.offending]
    assert found and sum("idiot" in s.lower() for s in found) > 5


def test_awkward_rows(spark):
    df = awkward(spark, [(100 + i, "you idiot. Fine text." if i % 2 else "good words here. Fine text.") for i in range(60)])
    none = spark.createDataFrame([], "doc_id long, toxic int, score double")
    assert {r.score for r in toxicity(df, none).collect()} == {0.0}
    some = spark.createDataFrame([(100 + i, i % 2, "x") for i in range(60)] + [(100, None, "x"), (None, 1, "x"), (7, 0, "x")], "doc_id long, toxic int, text string")
    rows = toxicity(df, some).collect()
    assert len(rows) == df.count()
    by = {r.doc_id: r for r in rows}
    assert by[101].predicted == 1 and by[102].predicted == 0 and by[3].score == by[4].score == 0
    assert [(s.start, s.end) for s in by[101].offending] == [(0, 9)]
    assert toxicity(empty(spark), some).collect() == []


def test_few_labels(spark):
    """Ten toxic documents are enough to learn from: no z-score reaches 8 there."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows, truth = toxicity(docs, labels).collect(), {r.doc_id: (r.toxic, r.quality) for r in labels.collect()}
    known = [(r.predicted, *truth[r.doc_id]) for r in rows if r.doc_id in truth]
    toxic, clean = [p for p, t, q in known if t and q], [p for p, t, _ in known if not t]
    assert sum(toxic) >= 0.9 * len(toxic) > 0 and sum(clean) <= 0.05 * len(clean)
    assert all(r.predicted for r in rows if r.held_out and truth.get(r.doc_id, (0, 0))[0])
    assert any(r.offending for r in rows)


@pytest.mark.parametrize("task", [_counted, lambda docs: _encoded(docs, np.array([1]))])
def test_fits_keep_no_model_of_another_operator(spark, task):
    tasks = MagicMock()
    task(tasks)
    run = tasks.select.return_value.mapInArrow.call_args.args[0]
    common.held("tokens", list)
    list(run(iter([])))
    assert not common._held
