import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from cases import awkward, empty
from pyspark.sql import functions as F
from test_similar import components, plain_set
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm.decontamination import contaminated
from tessera.llm.mixing import mixing_rates
from tessera.llm.queries import quality_domains
from tessera.llm.toxicity import toxicity

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        out.write.parquet(f"{tmp_path}/{name}")
        seen.append((name, docs, spark.read.parquet(f"{tmp_path}/{name}")))
        docs = seen[-1][2]
    for name, _, out in seen[:-1]:
        assert out.columns == columns, name
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    labels, bench = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("labels", "benchmark"))

    _, before, after = seen[0]
    assert ids(after) == {r.doc_id for r in toxicity(before, labels).collect() if not r.predicted}
    _, before, after = seen[1]
    assert ids(after) == set(components({r.doc_id: plain_set(r.text) for r in before.collect()}).values())  # five words, 0.8, all pairs
    _, before, after = seen[2]
    assert ids(after) == ids(before) - ids(contaminated(before, bench))
    _, before, after = seen[3]
    rates = {r.doc_id: r.rate for r in mixing_rates(before, quality_domains(labels), least_rate=1.0).collect()}
    copies = Counter(r.doc_id for r in after.collect())
    assert set(copies) == set(rates) and all(abs(copies[i] - rates[i]) < 1 for i in rates)
    _, before, after = seen[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, at = [], 0
    for r in before.orderBy("doc_id", "text").collect():
        code = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(code), zlib.crc32(np.array(code, "<u4").tobytes())))
        at += len(code)
    assert sorted((tuple(r) for r in after.collect()), key=lambda r: r[1]) == want


def test_run(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    last = rows.orderBy(F.desc("start")).first()
    assert last.start + last.n_tokens == rows.agg(F.sum("n_tokens")).first()[0]


def test_awkward_rows_through_all_stages(spark, tmp_path):
    """Null, blank and very long texts, null and repeated ids, repeated rows and columns of clashing names."""
    docs = awkward(spark)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
    ids = {name: sorted((r.doc_id for r in df.collect()), key=str) for name, df in kept.items()}
    assert ids["toxicity"] == sorted([1, 2, 3, 4, 5, 6, 7, 7, 8, None], key=str)
    # equal but for case: the smaller id; no word at all: one group; a repeated row stays with its like
    assert ids["near_duplicates"] == ids["decontamination"] == sorted([1, 3, 6, 7, 7, 8, None], key=str)
    assert set(ids["mixing"]) == {1, 3, 6, 7, 8, None} and len(ids["token_files"]) == len(ids["mixing"]) >= 7
    assert all(kept[name].columns == awkward(spark).columns for name in ids if name != "token_files")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), DATA).collect() == [], name


def test_toxic_documents_go_with_all_their_rows(spark):
    toxic = spark.read.parquet(f"{DATA}/documents.parquet").join(spark.read.parquet(f"{DATA}/labels.parquet").filter("toxic = 1 and quality = 1"), "doc_id").select("text").first()
    base = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(900_000, toxic.text), (900_000, toxic.text), (900_001, None), (None, toxic.text), (None, "plain words")], "doc_id long, text string")
    kept = corpus_pipeline.drop_toxic(spark, base.unionByName(more), DATA)
    left = [(r.doc_id, r.text) for r in kept.filter("doc_id is null or doc_id >= 900000").collect()]
    assert sorted(left, key=str) == [(900_001, None), (None, "plain words")]
