import difflib
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import geo
from tessera.operators import detect, explore, extraction, places, quality, resolve, serving, snapshots, tables
from tessera.plans import stages
from tessera.sources import registries
from tessera.sources.snapshots import STAGES, Snapshots

PROPS = "chain string, mall_id string, mall_name string, region string, address string, property_type string, lat double, lon double, geo_source string, geo_precision string, scraped_at string"
LIST = "chain string, mall_id string, store_name_raw string, category string, floor string, phone string, source string, scraped_at string"


@pytest.fixture(scope="module")
def small(spark):
    p = spark.createDataFrame(
        [
            ("a", "1", "Mall One", "visayas", "X, Cebu", "mall", 10.3, 123.9, "operator", "exact", "2024-01-01"),
            ("a", "2", "Mall Two", None, "Y, Makati", "mall", None, None, None, None, "2024-01-01"),
            ("b", "3", "Podium", "metro-manila", None, "residential-retail", None, None, None, None, "2024-01-01"),
        ],
        PROPS,
    )
    rows = spark.createDataFrame(
        [
            ("a", "1", "BENCH", "Fashion", "2ND FLOOR", "0917-123-4567", "x", "2024-01-01"),
            ("a", "2", "Bench", "Shops", "GF", None, "x", "2024-01-01"),
            ("b", "3", "Bench", None, "2F", None, "x", "2024-01-01"),
            ("a", "1", "BPI ATM", "Bank", None, "n/a", "x", "2024-01-01"),
        ],
        LIST,
    )
    return p, rows


def test_clean_then_report(small):
    p, raw = small
    rows = stages.enriched(raw)
    got = {(r.mall_id, r.store_name_raw): r for r in rows.collect()}
    assert got["1", "BENCH"].store_name == "Bench" and got["1", "BENCH"].floor_level == 2 and got["1", "BENCH"].phone_e164 == "+639171234567"
    assert {r.category_std for r in got.values() if r.brand_key == "bench"} == {"fashion"}
    assert got["3", "Bench"].category_source == "propagated" and got["1", "BENCH"].category_source == "operator"
    assert got["1", "BPI ATM"].store_format == "atm" and got["1", "BPI ATM"].phone is None
    assert raw.columns == LIST.replace(" string", "").split(", ")
    summary = {r.brand_key: r for r in tables.entity_summary(rows, p).collect()}
    assert (summary["bench"].n_malls_total, summary["bench"].n_malls_a, summary["bench"].n_malls_b, summary["bench"].in_all_chains) == (3, 2, 1, True)
    assert [r.brand_key for r in tables.unique_entities(rows, p).collect()] == ["bpi atm"]
    per = {r.mall_id: r for r in tables.container_summary(rows, p).collect()}
    assert (per["1"].n_stores, per["1"].n_unique_brands, per["1"].top_categories) == (2, 1, "Bank (1), Fashion (1)") and per["3"].top_categories == ""


def test_flags_in_order(spark):
    rows = spark.createDataFrame([("a", "1", "", "", "unknown", None, None, None, "09", None, "x" * 61 + " 1.5"), ("a", "1", "k", "k", "dining", "GF", "Ground", 0, None, None, "ok")] * 2,
                                 "chain string, mall_id string, brand_key string, brand_canonical string, category_std string, floor string, floor_std string, floor_level int, phone string, phone_e164 string, store_name string")
    assert {r.dq_flags for r in quality.quality_flags(rows).collect()} == {"empty_brand_key|category_unmapped|phone_unparsed|name_suspiciously_long|numeric_tail|duplicate_in_mall", "duplicate_in_mall"}


def test_snapshots(spark, small, tmp_path):
    p, rows = small
    store = Snapshots(spark, f"file://{tmp_path}/snap")
    assert store.runs() == [] and store.latest_usable() is None
    for day in ("2024-01-01", "2024-02-01"):
        store.write(day, STAGES[0], "malls", p)
        store.write(day, STAGES[0], "stores", rows if day < "2024-02" else rows.limit(0))
    assert store.latest_usable() == "2024-01-01" and store.previous("2024-02-01") == "2024-01-01"
    with pytest.raises(ValueError):
        store.publish("2024-02-01")
    with pytest.raises(ValueError):
        store.path("2024-01-01", "other")
    with pytest.raises(FileNotFoundError):
        store.need("2024-01-01", STAGES[1], "stores_clean")
    assert "brand_key" in store.listings("2024-01-01").columns
    one = stages.build(store, "2024-01-01")
    assert stages.build(store, "2024-01-01") == one and len(one) == 12
    assert store.runs() == ["2024-01-01", "2024-02-01"]
    assert store.read("latest", STAGES[2], "brand_summary").count() == 2


def test_build_leaves_its_tables_only(spark, small, tmp_path, monkeypatch):
    """What the steps of a build write on their way goes with them, and the CSV twins are zipped."""
    from tessera import scratch

    p, rows = small
    (tmp_path / "shared").mkdir()
    monkeypatch.setattr(scratch, "folder", lambda _: f"file://{tmp_path}/shared")
    store = Snapshots(spark, f"file://{tmp_path}/snap")
    store.write("2024-01-01", STAGES[0], "malls", p)
    store.write("2024-01-01", STAGES[0], "stores", rows)
    stages.build(store, "2024-01-01")
    assert [f.name for f in (tmp_path / "shared").iterdir() if f.is_dir()] == []
    twin = f"file://{tmp_path}/snap/2024-01-01/2_clean/stores_clean.csv"
    assert spark.read.option("header", True).csv(twin).count() == rows.count()
    assert {f.suffix for f in (tmp_path / "snap").rglob("part-*") if ".csv" in f.name} == {".gz"}


def test_carry_forward(spark, small):
    p, rows = small
    fresh = rows.filter("chain = 'a'").limit(1)
    malls, stores, found = stages.ingested(p.filter("chain = 'a' and mall_id = '1'"), fresh, "2024-03-01", _registry(spark), ["a"], (p, rows))
    assert {(r.chain, r.scraped_at) for r in stores.collect()} == {("a", "2024-03-01"), ("b", "2024-01-01")}
    assert {r.mall_id for r in malls.collect()} == {"1", "3"}
    assert ("gone", "2") in {(r.kind, r.key) for r in found.collect()}
    assert snapshots.carry_forward(rows, fresh, None).count() == 1
    with pytest.raises(ValueError, match="unknown chain 'zz'"):
        stages.ingested(p, rows, "2024-03-01", _registry(spark), ["a", "zz"], (p, rows))
    assert {r.mall_id for r in snapshots.unlisted(p, [p.filter("mall_id = '1'"), rows.filter("mall_id = '3'")], "mall_id").collect()} == {"2"}


def test_orphans_break_the_contract(spark, small):
    p, rows = small
    quality.check_contract(p, rows)
    with pytest.raises(ValueError, match="orphan_listings: a:9"):
        quality.check_contract(p, rows.withColumn("mall_id", F.lit("9")))
    with pytest.raises(ValueError, match="missing_column"):
        quality.check_contract(p.drop("region"), rows)
    with pytest.raises(ValueError, match="geo_source"):
        quality.check_vocabulary(p.withColumn("geo_source", F.lit("guess")))


def _registry(spark):
    return spark.createDataFrame([("a", "2", 14.5, 121.0, "osm", "exact", None, "way/1"), ("a", "1", 1.0, 1.0, "osm", "exact", None, None)],
                                 "chain string, mall_id string, lat double, lon double, source string, precision string, matched string, ref string")


def test_attach_is_idempotent(spark, small):
    p, _ = small
    stale = p.withColumns({"lat": F.coalesce("lat", F.lit(12.0)), "lon": F.coalesce("lon", F.lit(122.0)), "geo_source": F.coalesce("geo_source", F.lit("osm"))})
    once = places.attach_registry(stale, _registry(spark))
    got = {r.mall_id: (r.lat, r.geo_source) for r in once.collect()}
    assert got == {"1": (10.3, "operator"), "2": (14.5, "osm"), "3": (None, None)}
    assert sorted(places.attach_registry(once, _registry(spark)).collect()) == sorted(once.collect())
    assert [r.mall_id for r in places.unplaced(stale, _registry(spark)).collect()] == ["3"]


def test_place_matches(spark):
    p = spark.createDataFrame([("c", str(i), n, r) for i, (n, r) in enumerate([("SM City Baguio", "north-luzon"), ("Robinsons Place Manila", None), ("Gaisano Grand", "visayas"), ("Twin Plaza", None), ("Festival Mall", "mindanao")])],
                              "chain string, mall_id string, mall_name string, region string")
    f = spark.createDataFrame(
        [
            ("n/1", ["SM City Baguio Annex"], 16.4, 120.6), ("n/2", ["SM"], 16.4, 120.6), ("n/3", ["x", "Robinsons Place Manila"], 14.57, 120.98), ("n/4", ["Gaisano Grande"], 7.0, 125.0),
            ("n/5", ["Twin Plaza"], 10.0, 123.0), ("n/6", ["Twin Plaza"], 14.6, 121.0), ("n/7", ["Festival"], 14.4, 121.0), ("n/8", ["Festival Mall"], 51.5, 0.1),
        ],
        "id string, names array<string>, lat double, lon double",
    )
    best = {r.mall_id: (r.id, r.reason) for r in places.best_features(p, places.name_matches(p, f)).collect()}
    assert best == {"0": ("n/1", ""), "1": ("n/3", ""), "2": (None, "no match in the region"), "3": (None, "ambiguous"), "4": ("n/7", "")}


def test_geocoder_cascade(spark):
    p = spark.createDataFrame([("c", "1", "Mall A", "metro-manila", "Corner St, Loyola, Quezon City"), ("c", "2", "Mall B", None, None)], "chain string, mall_id string, mall_name string, region string, address string")
    asked = places.attempts(p)
    assert [r["query"] for r in asked.filter("mall_id = 1").orderBy("attempt").collect()] == [
        "Mall A, Corner St, Loyola, Quezon City, Philippines", "Mall A, Philippines", "Corner St, Loyola, Quezon City, Philippines", "Loyola, Quezon City, Philippines", "Quezon City, Philippines",
    ]
    hits = spark.createDataFrame([("Loyola, Quezon City, Philippines", 0, None, "Loyola", "14.64", "121.07", 30, "way", 5), ("Mall B, Philippines", 0, "Mall B", "Mall B, PH", "10.1", "123.1", 30, "node", 7), ("Mall A, Philippines", 0, "Other", "O", "10", "123", 30, "node", 8)],
                                 "query string, pos int, name string, display_name string, lat string, lon string, place_rank int, osm_type string, osm_id long")
    got = {r.mall_id: (r.precision, r.ref) for r in places.accepted_results(asked, hits).collect()}
    assert got == {"1": ("locality", "way/5"), "2": ("exact", "node/7")}


def test_similar_pairs_lose_nothing(spark):
    rnd = random.Random(4)
    names = {"".join(rnd.choice("abcdef ") for _ in range(rnd.randint(3, 14))).strip() or "q" for _ in range(120)}
    for n in list(names):
        at = rnd.randrange(len(n))
        names.add((n[:at] + rnd.choice("abcdef") + n[at + 1 :]).strip() or "q")
    names = sorted(names)
    df = spark.createDataFrame([(n,) for n in names], "text string")
    got = {(r.left, r.right) for r in resolve.similar_candidates(df, df, 0.86, same=True).collect()}
    true = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if difflib.SequenceMatcher(None, a, b).ratio() >= 0.86}
    assert true and true <= got and len(got) < len(names) ** 2 / 20


def test_proposals(spark):
    rows = spark.createDataFrame([(k, str(m)) for k in ("starbucks", "starbuck", "bpi", "bpi atm") for m in range(5)] + [("starbuckz", "1")], "brand_key string, mall_id string")
    got = [tuple(r) for r in resolve.propose_merges(rows).collect()]
    assert got == [("starbuck", "starbucks", 5, 5, 0.941)]
    alias = spark.createDataFrame([("starbucks", "starbuck")], "variant string, canonical string")
    assert resolve.propose_merges(rows, alias).collect() == []


def test_registries(spark, tmp_path):
    (tmp_path / "alias.json").write_text('{"aliases": {"bdo": ["bdo", "banco"], "bpi": ["bank of"]}, "_rejected": {"a": "b"}}')
    assert sorted(map(tuple, registries.aliases(spark, f"{tmp_path}/alias.json").collect())) == [("banco", "bdo"), ("bank of", "bpi")]
    (tmp_path / "twice.json").write_text('{"aliases": {"x": ["v"], "y": ["v"]}}')
    with pytest.raises(ValueError):
        registries.aliases(spark, f"{tmp_path}/twice.json")
    (tmp_path / "gaps.json").write_text('{"not_in_api": [{"name": "Mall Z", "region": "visayas", "opened": "2024-10", "property_type": "mall"}, {"name": "Later", "opened": "2030", "property_type": "mall"}]}')
    gaps = registries.coverage_gaps(spark, f"{tmp_path}/gaps.json")
    assert [r.gap_name for r in places.open_gaps(gaps, "2025-01-01").collect()] == ["Mall Z"]
    names = spark.createDataFrame([("The mall z annex",), ("Other",)], "mall_name string")
    assert [tuple(r) for r in places.reappeared(gaps, names).collect()] == [("Mall Z", "The mall z annex")]
    (tmp_path / "out.json").write_text('{"chains": [{"chain": "q", "malls_known": 3}]}')
    assert registries.excluded_operators(spark, f"{tmp_path}/out.json").first().malls_known == "3"
    registries.write_coordinates(_registry(spark), f"{tmp_path}/coords")
    assert sorted(map(str, registries.coordinates(spark, f"{tmp_path}/coords").collect())) == sorted(map(str, _registry(spark).collect()))
    (tmp_path / "old.json").write_text('{"schema": 9, "entries": {}}')
    with pytest.raises(ValueError):
        registries.coordinates(spark, f"{tmp_path}/old.json")


def test_line_assembly(spark):
    lines = [("p", "📍 Level 0"), ("h2", "Dining"), ("p", "Jollibee"), ("p", "📍 Level 2"), ("p", "BLDG"), ("p", "KFC | 📍 GF"), ("h2", "x" * 40), ("p", "Chow | 📍 Unit 1, Long Street Name, Some Town, Province"), ("p", "lonely"), ("h3", "Shops"), ("p", "📍 nothing"), ("p", "Bench 📍")]
    df = spark.createDataFrame([(1, i, t, x) for i, (t, x) in enumerate(lines)], "page_id int, pos int, tag string, text string")
    got = [(r.store_name_raw, r.category, r.floor) for r in extraction.assembled(df).orderBy("pos").collect()]
    assert got == [("Jollibee", "dining", "Level 2 BLDG"), ("KFC", "dining", "GF"), ("Bench", "shops", None)]


def test_json_sources(spark):
    landed = spark.createDataFrame([("p0", '{"data":[{"n":" A "},{"n":"B"}]}'), ("p1", "[]"), ("p2", "oops"), ("p3", '{"data":[]}')], "page string, value string")
    schema = "data array<struct<n: string>>"
    assert [(r.page, r.pos, r.n) for r in extraction.json_rows(landed, schema, "data", keep=("page",)).collect()] == [("p0", 0, " A "), ("p0", 1, "B")]
    assert {(r.key, r.kind) for r in extraction.bad_records(landed, schema, "data").collect()} == {("p1", "unparsed"), ("p2", "unparsed"), ("p3", "no_rows")}
    page = spark.createDataFrame([('<div data-page="{&quot;floors&quot;:[{&quot;name&quot;:&quot;GF&quot;,&quot;stores&quot;:[{&quot;n&quot;:&quot;A&quot;}]}]}">',)], "html string")
    doc = extraction.embedded_json(page, "data-page", "floors array<struct<name: string, stores: array<struct<n: string>>>>")
    got = extraction.unnested(doc, "doc.floors", "floors.stores").select("floors.name", "stores.n").collect()
    assert [tuple(r) for r in got] == [("GF", "A")]


def test_map_features(spark):
    df = spark.createDataFrame([("node", 1, 10.0, 123.0, None, {"name": "A", "alt_name": "B"}), ("way", 2, None, None, (11.0, 124.0), {"name:en": "C"}), ("way", 3, None, None, None, {"name": "D"}), ("node", 4, 1.0, 2.0, None, {"shop": "mall"})],
                               "type string, id long, lat double, lon double, center struct<lat: double, lon: double>, tags map<string, string>")
    assert [(r.id, r.names, r.lat) for r in extraction.map_features(df).orderBy("id").collect()] == [("node/1", ["A", "B"], 10.0), ("way/2", ["C"], 11.0)]


def test_detectors(spark):
    many = [("kfc burger", c, str(m)) for c in "ab" for m in range(4)] + [("solo", "a", "1")]
    odd = [("kfc burger extra crispy", "c", "9"), ("the kfc burger and kfc burger place", "c", "9"), ("short", "c", "8")]
    rows = spark.createDataFrame(many + odd, "brand_key string, chain string, mall_id string")
    known = detect.attested(rows)
    assert {tuple(r) for r in known.collect()} == {(c, "kfc burger") for c in "abc"}
    got = {r.mall_id: (r.median_words, r.share_begun, r.combined) for r in detect.combined_names(rows, known).collect() if r.chain == "c"}
    assert got == {"9": (5.5, 0.5, True), "8": (1.0, 0.0, False)}
    assert sorted(tuple(r) for r in detect.mentions(rows, known).collect()) == [
        ("c", "9", "kfc burger extra crispy", "kfc burger"),
        ("c", "9", "the kfc burger and kfc burger place", "kfc burger"),
    ]
    old = detect.freshness(spark.createDataFrame([("a", "2020-01-01"), ("b", "2024-01-01")], "chain string, scraped_at string"), "2024-06-01")
    assert {r.chain: r.stale for r in old.collect()} == {"a": True, "b": False}


def test_facets_need_one_property(spark):
    p = spark.createDataFrame([("a", "1", "One", "x", "mall", 5, 1.0), ("b", "2", "Two", "y", "office", 3, None), ("b", "3", "Three", "x", "mall", 9, 2.0)], "chain string, mall_id string, mall_name string, region string, property_type string, listings long, lat double")
    e = spark.createDataFrame([("k1", "Kay", None, ["dining"], 2), ("k2", "Tea", "alias", ["dining", "home"], 1)], "brand_canonical string, name string, alias string, categories array<string>, malls long")
    edges = spark.createDataFrame([("k1", "a", "1"), ("k1", "b", "2"), ("k2", "b", "3")], "brand_canonical string, chain string, mall_id string")
    x = explore.Explorer(p, e, edges)
    f = explore.Filters(chain=frozenset("b"), region=frozenset("x"))
    assert [(r.brand_canonical, r.in_scope, r.share) for r in x.entity_results(f).collect()] == [("k2", 1, 100)]
    counts = {(r.facet, r.value): r.n for r in x.facets(f).collect()}
    assert counts["chain", "a"] == 1 and counts["chain", "b"] == 1 and counts["region", "y"] == 1 and counts["category", "home"] == 1
    assert [r.mall_id for r in x.property_results(explore.Filters(focus="k1")).collect()] == ["1", "2"]
    assert [r.mall_id for r in x.property_results(explore.Filters(category=frozenset(["home"]))).collect()] == ["3"]
    assert x.entity_results(explore.Filters(query="ALIAS")).count() == 1
    nothing = x.entity_results(explore.Filters(region=frozenset("z"))).collect()
    assert nothing == [] and tuple(x.scope_stats(explore.Filters(region=frozenset("z"))).first()) == (0, 0, 0, 0)
    shown, hidden = x.map_points(explore.Filters())
    assert shown.count() == 2 and hidden.first().unplaced == 1
    by = {(r.facet, r.value): r.n for r in x.facets(explore.Filters(malls_only=True), "properties").collect()}
    assert by["chain", "b"] == 1 and by["region", "y"] == 0 and by["category", "dining"] == 2


def test_dense_codes_and_digest(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert [r.ix for r in serving.dense_codes(df, ["v"], "ix").orderBy("v").collect()] == list(range(1000))
    assert serving.digest(df) == serving.digest(df.repartition(7)) != serving.digest(df.limit(999))


def test_geography(spark):
    row = spark.range(1).select(
        geo.coordinate(F.lit("51.5"), F.lit("-0.1")).alias("london"), geo.coordinate(F.lit("14.5"), F.lit("121")).alias("ok"), geo.coordinate(F.lit(""), F.lit(None)).alias("none"),
        geo.distance_km(F.lit(14.5), F.lit(121.0), F.lit(10.3), F.lit(123.9)).alias("km"), geo.address_tails(F.lit("a, b,, c, d, e")).alias("tails"), geo.address_tails(F.lit("only")).alias("one"),
        geo.cap_precision(F.lit("exact"), F.lit("locality")).alias("cap"), geo.cap_precision(F.lit("address"), F.lit(None)).alias("nocap"), geo.region_agrees(F.lit(None), F.lit(1.0), F.lit(1.0)).alias("free"),
    ).first()
    assert row.london is None and tuple(row.ok) == (14.5, 121.0) and row.none is None and abs(row.km - 562) < 3
    assert row.tails == ["b, c, d, e", "c, d, e", "d, e"] and row.one == [] and (row.cap, row.nocap, row.free) == ("locality", "address", True)
    assert tables.groups_of(spark.createDataFrame([("b",), ("a",), (None,)], "chain string")) == ["a", "b"]


def test_stream_of_landed_listings(spark, tmp_path):
    from tessera.streaming.landing import appended, landed, windowed_counts

    rows = spark.createDataFrame([(f"2024-01-0{1 + i // 3}", "a" if i % 2 else "b") for i in range(9)], "day string, chain string").select(F.to_timestamp("day").alias("ts"), "chain")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = landed(spark, f"{tmp_path}/in", "ts timestamp, chain string")
    appended(windowed_counts(stream, "ts", ["chain"], late="0 seconds"), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert {(str(r.start)[:10], r.chain, r.n) for r in out.collect()} >= {("2024-01-01", "b", 2), ("2024-01-01", "a", 1)}
