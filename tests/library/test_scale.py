import random
import threading

import pytest
from pyspark.sql import functions as F

from tessera.operators import places, quality, serving
from tessera.sources import ordered, registries
from tessera.sources.snapshots import LATEST, STAGES, Snapshots


def test_a_reader_never_misses_the_published_tables(spark, tmp_path, monkeypatch):
    store = Snapshots(spark, f"file://{tmp_path}/snap")
    for day in ("2024-01-01", "2024-02-01"):
        for name in ("malls", "stores"):
            store.write(day, STAGES[0], name, spark.createDataFrame([(day,)], "chain string"), csv=False)
    monkeypatch.setattr(Snapshots, "is_usable", lambda self, run: True)
    store.publish("2024-01-01")
    missed, seen, done = [], set(), threading.Event()

    def reader():
        while not done.is_set():
            try:
                path = store._found(LATEST, STAGES[0], "stores")
                seen.add(path)
                if path is None or not store._names(path):
                    missed.append(path)
            except Exception as error:
                missed.append(error)

    thread = threading.Thread(target=reader)
    thread.start()
    for i in range(100):
        store.publish(f"2024-0{1 + i % 2}-01")
    done.set()
    thread.join()
    assert not missed and len(seen) == 2
    assert store.published()["run"] == "2024-02-01" and len(store._names(f"{store.root}/_published")) >= 101


def test_published_tables_do_not_change(spark, tmp_path, monkeypatch):
    store = Snapshots(spark, f"file://{tmp_path}/snap")
    table = lambda *values: spark.createDataFrame([(v,) for v in values], "chain string")
    monkeypatch.setattr(Snapshots, "is_usable", lambda self, run: True)
    assert store.read(LATEST, STAGES[0], "malls") is None
    store.write("2024-01-01", STAGES[0], "malls", table("m"))
    store.write("2024-01-01", STAGES[0], "stores", table("old"))
    store.publish("2024-01-01")
    store.write("2024-01-01", STAGES[0], "stores", table("new"))
    store.write("2024-01-01", STAGES[0], "stores", table("newer"))
    assert store.runs() == ["2024-01-01"]
    assert store.read(LATEST, STAGES[0], "stores").first()[0] == "old" and store.read("2024-01-01", STAGES[0], "stores").first()[0] == "newer"
    assert store.read("2024-01-01", STAGES[0], "malls").first()[0] == "m"  # from the first revision
    store.publish("2024-01-01")
    assert store.read(LATEST, STAGES[0], "stores").first()[0] == "newer" and store.read(LATEST, STAGES[0], "malls").first()[0] == "m"
    with pytest.raises(ValueError):
        store.write(LATEST, STAGES[0], "stores", table("x"))


def test_ordered_files(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(rnd.randrange(50), rnd.choice([None, "a", "b"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "n int, t string, i int").repartition(5)
    path = f"file://{tmp_path}/t"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one file
    try:
        ordered.write(df, path, ["-n", "t"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted(ordered.read(spark, path).collect(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(3000)) and sorted(r.i for r in got) == list(range(3000))
    assert [(r.n, r.t) for r in got] == sorted(((n, t) for n, t, _ in rows), key=lambda r: (-r[0], r[1] is not None, r[1] or ""))
    files = spark.read.parquet(ordered.manifest_path(path)).orderBy("start").collect()
    assert len(files) > 1 and sum(f.rows for f in files) == 3000
    plan = ordered.read(spark, path)._jdf.queryExecution().toString()
    assert "Sort" not in plan
    ordered.write(df.limit(0), path, ["n"])
    assert ordered.read(spark, path).collect() == []


def test_codes_stay_when_read_again(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("v"), "id").repartition(4).withColumn("noise", F.rand())
    coded = serving.dense_codes(df, ["v"], "code")  # ties all over, and a row that differs each time it is computed
    first = {r.id: (r.code, r.noise) for r in coded.collect()}
    again = {r.id: (r.code, r.noise) for r in coded.repartition(3, "noise").collect()}
    assert first == again and sorted(c for c, _ in first.values()) == list(range(2000))


def test_bits_of_many_groups(spark):
    rnd = random.Random(2)
    has = {k: rnd.sample(range(200), rnd.randrange(1, 40)) for k in "abcdef"}
    rows = [(k, g) for k, gs in has.items() for g in gs] + [("a", has["a"][0]), ("a", -1)]
    bits = serving.group_bits(spark.createDataFrame(rows, "k string, code int"), "k", "code", 200)
    got = {r.k: r.group_bits for r in bits.collect()}
    assert all(len(w) == 4 for w in got.values())
    assert {k: sorted(63 * i + b for i, w in enumerate(ws) for b in range(63) if w >> b & 1) for k, ws in got.items()} == {k: sorted(gs) for k, gs in has.items()}
    for code in (0, 62, 63, 199):
        assert {r.k for r in bits.filter(serving.has_group(F.col("group_bits"), code)).collect()} == {k for k, gs in has.items() if code in gs}


def test_sparse_rows(spark):
    edges = [(0, 3), (0, 1), (2, 0), (5, 2), (5, 1), (5, 4), (5, 4)]
    offsets, flat = serving.adjacency(spark.createDataFrame(edges, "a int, b int"), spark.range(7).withColumnRenamed("id", "a"), "a", "b")
    assert [tuple(r) for r in offsets.orderBy("a").collect()] == [(0, 0, 2), (1, 2, 0), (2, 2, 1), (3, 3, 0), (4, 3, 0), (5, 3, 3), (6, 6, 0)]
    assert [tuple(r) for r in flat.orderBy("pos").collect()] == [(0, 1), (1, 3), (2, 0), (3, 1), (4, 2), (5, 4)]


def test_containment_and_prefixes_against_all_pairs(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("ab É漢") for _ in range(rnd.randrange(0, 9))) for _ in range(150)]
    a, b = words[:80], words[60:]
    frame = lambda ws, c: spark.createDataFrame([(w,) for w in ws] + [(None,)], f"{c} string")
    got = {tuple(r) for r in places.containing(frame(a, "text"), frame(b, "text"), 3).collect()}
    assert got == {(x, y) for x in a for y in b if x and y and x in y}
    again = {tuple(r) for r in places.reappeared(frame(a, "gap_name"), frame(b, "mall_name")).collect()}
    low = str.lower
    assert again == {(x, y) for x in a for y in b if x and y and (low(x) in low(y) or low(y) in low(x))}
    for live in (b, [w for w in b if w]):
        left = [r.roster_key for r in places.unmatched_roster(frame(a, "roster_key"), frame(live, "live_key")).collect()]
        assert sorted(left, key=str) == sorted([x for x in a if not any(x.startswith(y) or y.startswith(x) for y in live)] + [None], key=str)


def test_a_million_coordinates(spark, tmp_path):
    n = 1_000_000
    rows = spark.range(n).select(F.concat(F.lit("c"), F.col("id") % 9).alias("chain"), F.concat(F.lit("m:"), "id").alias("mall_id"), (F.col("id") / n).alias("lat"), F.lit(1.5).alias("lon"), F.lit("osm").alias("source"),
                                 F.lit(None).cast("string").alias("precision"), F.lit("x").alias("matched"), F.lit("y").alias("ref"))
    path = f"file://{tmp_path}/big"
    registries.write_coordinates(rows, path)
    got = registries.coordinates(spark, path)
    assert got.count() == n and got.columns == rows.columns
    assert got.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first() == rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()
    with pytest.raises(ValueError, match="several"):
        registries.write_coordinates(rows.limit(1).union(rows.limit(1)), path)
    spark.range(3).select(F.lit(9).alias("schema"), F.lit("a:b").alias("key")).write.json(f"file://{tmp_path}/odd")
    with pytest.raises(ValueError, match="schema 9"):
        registries.coordinates(spark, f"file://{tmp_path}/odd")


def test_histories_step_by_step(spark):
    rnd = random.Random(4)
    days = [f"d{i}" for i in range(7)]
    rows = [(k, d) for k in "abcde" for d in days for _ in range(rnd.randrange(3))] + [("z", "d0"), ("y", "d6"), (None, "d2")]
    got = sorted((tuple(r) for r in quality.key_history(spark.createDataFrame(rows, "k string, d string"), "d", ["k"]).collect()), key=str)
    want = []
    for k in {k for k, _ in rows}:
        seen = before = None
        times, gone = 0, True
        for d in days:
            n = rows.count((k, d))
            if n:
                times += 1
                change = "first" if seen is None else "back" if gone else "kept"
                seen, gone = seen or d, False
                want.append((k, d, n, before, change, seen, times))
                before = n
            elif not gone:
                gone = True
                want.append((k, d, 0, before, "gone", seen, times))
    assert got == sorted(want, key=str)
