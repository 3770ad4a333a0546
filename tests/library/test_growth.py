"""What has to hold on tables larger than the tests' own: plans, shares of tasks and ids of more digits."""

from pyspark.sql import functions as F

from tessera import queries
from tessera.functions import geo, text
from tessera.operators import places, quality, resolve, serving
from tessera.plans import stages
from tessera.scratch import written
from tessera.sources import ordered


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rosters_are_not_broadcast(spark):
    roster = spark.createDataFrame([("ab",), ("b",), ("xyz",), ("",), (None,), ("abc",)], "roster_key string")
    live = spark.createDataFrame([("a",), ("bcd",), ("xz",), (None,)], "live_key string")
    open_ = places.unmatched_roster(roster, live)
    assert "BroadcastHashJoin" not in planned(open_)
    assert {r.roster_key for r in open_.collect()} == {"xyz", None}
    none = live.filter("live_key = 'none'")
    assert places.unmatched_roster(roster, none).count() == 6 and places.unmatched_roster(none.withColumnRenamed("live_key", "roster_key"), live).count() == 0


def test_short_numbers_before_a_status_are_no_phones(spark):
    cases = {
        "ANVIL BRAND#7 MC12345 - (OPENING SOON)": "Anvil Brand#7 Mc12345",
        "ANVIL 12345 - - (CLOSED)": "Anvil 12345",
        "Uniqlo 0355276359 - (Opening Soon)": "Uniqlo",
        "UNCLE JOHN'S0998-846-6030": "Uncle John's",
        "Anvil '123-4567 ": "Anvil",
        "Anvil mc12345 (02) 8123-1234": "Anvil mc12345",
    }
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    assert {r.v: r.n for r in df.select("v", text.clean_name(F.col("v")).alias("n")).collect()} == cases


def whole_values(spark, tmp_path):
    spark.range(28).selectExpr("id AS p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([("take out the drive\nthru food",), ("the drive thru B2 the drive",), ("",), (None,)], "text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_formats_of_values_of_several_words_are_counted(spark, tmp_path):
    got = {r.v: (r.n, r.store_format) for r in queries.queries()["store_format"](spark, whole_values(spark, tmp_path)).collect()}
    assert got["Burger Drive-Thru "] == (2, "drive-thru") and got["Burger Drive-Thru"] == (1, "drive-thru") and got["take out"] == (1, "takeout")
    assert got["drive thru"] == (1, "drive-thru") and got["the drive"] == (2, "standard") and got["the"] == (3, "standard") and got["the drive\nthru"] == (1, "drive-thru")
    assert sum(n for n, _ in got.values()) == 28 + 5 + 6 + 1 + 4 + 5


def test_floors_of_values_of_several_words_are_counted(spark, tmp_path):
    got = {r.v: (r.n, r.label, r.level) for r in queries.queries()["floor_levels"](spark, whole_values(spark, tmp_path)).collect()}
    assert got["FOOD COURT 2F"] == (2, "Food Court 2F", None) and got["Level 12 "] == (2, "Level 12", 12) and got["third level "] == (2, "Level 3", 3)
    assert got["thru B2"] == (1, "Basement 2", -2) and got["B2"][0] == 3 and got["the drive"] == (2, "the drive", None) and got[""] == (1, None, None) and got[" "] == (2, None, None)
    assert sum(n for n, _, _ in got.values()) == 28 + 5 + 6 + 1 + 4 + 5


def namesakes(spark, copies):
    names = ["SM City Baguio", "SM City Bagio", "Festival Mall", "Twin Plaza", "", None]
    p = [("c", f"{i}-{k}", n, ("visayas", None, "mindanao", "")[(i + k) % 4]) for i, n in enumerate(names) for k in range(copies)]
    f = [(f"n/{i}-{k}", [n or "x", "Twin Plazas"][: 1 + k % 2], 7.0 + (5 * i + 3 * k) % 13, 121.0 + k % 5) for i, n in enumerate(names) for k in range(copies)]
    return spark.createDataFrame(p, "chain string, mall_id string, mall_name string, region string"), spark.createDataFrame(f, "id string, names array<string>, lat double, lon double")


def test_name_classes_hold_every_match(spark):
    p, f = namesakes(spark, 6)
    got = places.name_classes(p, f).collect()
    pairs = [r for r in got if r.part == "pair"]
    told = {}
    for pair in pairs:
        for mine in (r for r in got if r.part == "ours" and r.ours == pair.ours):
            for other in (r for r in got if r.part == "theirs" and r.theirs == pair.theirs):
                key = mine.chain, mine.mall_id, other.id
                told[key] = max(pair.score, told.get(key, 0))
    assert told == {(r.chain, r.mall_id, r.id): r.score for r in places.name_matches(p, f).collect()} and len(told) > 200
    more = places.name_classes(*namesakes(spark, 12)).groupBy("part").count()
    assert {r.part: r["count"] for r in more.collect()} == {"pair": len(pairs), "ours": 2 * sum(r.part == "ours" for r in got), "theirs": 2 * sum(r.part == "theirs" for r in got)}


def test_namesakes_of_a_region_are_settled_once(spark):
    p, f = namesakes(spark, 8)
    best = places.best_named(p, f)
    assert sorted(map(str, best.collect())) == sorted(map(str, places.best_features(p, places.name_matches(p, f)).select(*best.columns).collect())) and best.count() >= 30


def test_pairs_of_points_are_dealt_out(spark):
    rows = [(f"{i}", "r" if i % 5 else ("s", None)[i % 2], 5.0 + i % 11 if i % 13 else None, 120.0 + i % 7) for i in range(150)]
    points = spark.createDataFrame(rows, "mall_id string, region string, lat double, lon double")
    a, b = points.filter("lat is not null").alias("a"), points.filter("lat is not null").alias("b")
    km = geo.distance_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))
    plain = a.join(b, F.expr("a.region = b.region and a.mall_id < b.mall_id")).select("a.mall_id", "b.mall_id", km)
    for most in (7, 2000):
        got = places.pair_distances(points, most=most)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect())) and got.count() > 5000
    held = places.pair_distances(points, most=7).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held < 800
    assert places.pair_distances(points.limit(0)).collect() == []


def test_ordered_ranges_grow_with_the_rows(spark, tmp_path):
    df = spark.range(5000).selectExpr("id % 97 AS a", "id AS b")
    for rows in (1000, 5000):
        ordered.write(df.limit(rows), f"{tmp_path}/t{rows}", ("a", "-b"), most=250)
        files = ordered.manifest_path(f"{tmp_path}/t{rows}")
        assert spark.read.parquet(files).agg(F.max("rows")).first()[0] < 600
        got = ordered.read(spark, f"{tmp_path}/t{rows}").orderBy("place").collect()
        assert [(r.a, -r.b) for r in got] == sorted((r.a, -r.b) for r in got) and [r.place for r in got] == list(range(rows))
        assert sorted((r.first, r.last) for r in spark.read.parquet(files).collect())[0][0].startswith('{"a":0,"b":')


def test_counted_pairs_vote_like_their_rows(spark):
    rows = [("b", "x")] * 3 + [("b", "a")] * 2 + [("b", "unknown")] * 9 + [("c", "d"), ("c", "a"), ("", "x"), (None, "x")]
    df = spark.createDataFrame(rows, "brand_canonical string, category_std string")
    counted = df.groupBy("brand_canonical", "category_std").agg(F.count(F.lit(1)).alias("n"))
    told = {(r.brand_canonical, r.vote) for r in resolve.category_votes(counted, weight="n").collect()}
    assert told == {("b", "x"), ("c", "a")} == {(r.brand_canonical, r.vote) for r in resolve.category_votes(df).collect()}


def test_report_tables_share_the_links_of_their_listings(spark, tmp_path):
    rows = [(f"b{i % 7}" if i % 11 else ("", None)[i % 2], "c" if i % 3 else "d", f"{i % 5}" if i % 13 else None, ("x", "y", None)[i % 3], f"n{i % 4}" if i % 7 else None, f"k{i % 3}") for i in range(300)]
    rows += [("alone", "c", "1", "x", "zz", "k0")] * 2 + [("unknown", "e", "9", "x", "zz", "k0")]
    spark.createDataFrame(rows, "brand_key string, chain string, mall_id string, category string, store_name_raw string, category_std string").write.parquet(f"{tmp_path}/listed")
    listed = spark.read.parquet(f"{tmp_path}/listed")
    places_ = spark.createDataFrame([(c, f"{m}", f"{c}{m}", "r") for c in "cd" for m in range(5)], "chain string, mall_id string, mall_name string, region string")
    told = stages.report_tables(places_, listed)
    plain = listed.filter("brand_key <> ''").join(places_, ["chain", "mall_id"])
    seen = {(r.brand_key, r.chain, r.mall_id) for r in plain.collect()}
    assert {(r.brand_key, r.chain, r.mall_id) for r in told["brand_presence"].collect()} == seen and told["brand_presence"].count() == len(seen)
    shown = {r.brand_key: r.n for r in listed.filter("brand_key <> ''").groupBy("brand_key").agg(F.mode("store_name_raw", True).alias("n")).collect()}
    assert {r.brand_key: (r.n_malls_total, r.display_name) for r in told["brand_summary"].collect()} == {b: (sum(k[0] == b for k in seen), shown[b]) for b in {k[0] for k in seen}}
    assert shown["b0"] is None and [(r.brand_key, r.mall_name) for r in told["unique_brands"].collect()] == [("alone", "c1")]
    per = {(r.chain, r.mall_id): (r.n_stores, r.n_brands, r.n_unique_brands) for r in told["mall_summary"].collect()}
    count = lambda at: ([r.brand_key for r in plain.collect() if (r.chain, r.mall_id) == at], int(at == ("c", "1")))
    assert per == {at: (len(count(at)[0]), len(set(count(at)[0])), count(at)[1]) for at in per} and len(per) == 10
    assert "/listed" not in planned(told["brand_presence"]) and "mode(" not in planned(told["brand_summary"]) + planned(told["unique_brands"])


def test_numbering_moves_rows_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(serving, "written", lambda df, tag: (plans.append(planned(df)), written(df, tag))[1])
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS a")
    got = serving.dense_codes(df, ["a"], "code")
    assert {(r.a, r.code) for r in got.collect()} == {(i, i) for i in range(5000)} and got.columns == ["a", "code"]
    assert len(plans) == 1 and plans[0].count("Exchange") == 1


def test_texts_are_not_what_repeated_rows_are_sorted_by_first(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, None)], "a string, b string").withColumn("twice", quality.is_repeated("a", "b"))
    assert sorted(r.twice for r in df.collect()) == [False, False, True, True]
    assert "xxhash64" in planned(df)


def test_categories_are_mapped_once_counted(spark):
    df = spark.createDataFrame([("c", "Dining")] * 3 + [("c", None)] * 2 + [("d", "Dining")], "chain string, category string")
    counted = df.groupBy("chain", "category").agg(F.count(F.lit(1)).alias("n"))
    standard = text.category(F.col("category"))
    assert sorted(map(str, quality.mapping_audit(counted, standard, weight="n").collect())) == sorted(map(str, quality.mapping_audit(df, standard).collect()))
