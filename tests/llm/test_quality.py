import zlib

import numpy as np
from cases import awkward, empty

from tessera.llm.quality import STATS, pool_adjacent, quality_scores, statistics

DATA = "/root/testdata/sf0.1"


def accuracy(rows, truth):
    got = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    return sum(a == b for a, b in got) / len(got)


def test_isotonic_fit():
    y, w = np.array([0.1, 0.4, 0.3, 0.3, 0.9, 0.2]), np.array([1, 1, 1, 2, 1, 1.0])
    fit = pool_adjacent(y, w)
    assert np.allclose(fit, [0.1, 0.325, 0.325, 0.325, 0.55, 0.55])
    assert len(pool_adjacent(np.array([]), np.array([]))) == 0


def test_statistics_take_any_text():
    for text in (b"", b" ", b"\xff\xfe", "é漢😀".encode(), b"a " * 100_000):
        assert len(statistics(text)) == STATS and np.isfinite(statistics(text)).all()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert accuracy(rows, {r.doc_id: r.quality for r in labels.collect()}) > 0.98


def test_held_out_labels_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = ({r.doc_id: round(r.score, 9) for r in quality_scores(docs, x).collect()} for x in (labels, flipped))
    assert one == two


def test_awkward_rows(spark):
    df = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, score double")
    assert {r.score for r in quality_scores(df, none).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (2, None, "x"), (None, 1, "x"), (6, 0, "x"), (77, 1, "x")], "doc_id long, quality int, text string")
    rows = quality_scores(df, some).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_scores(empty(spark), some).collect() == []
