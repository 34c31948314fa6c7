"""Operators on small hand-made rows: semantics, edges, nulls and empty tables."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pricegrain.functions import scalars as sc
from pricegrain.storage import checkpoint
from pricegrain.operators import baskets, geo, ingest, ordered, quality, sampling, text, variability
from pricegrain.operators import index as ix
from pricegrain.sources import readers

PRICE = "product_id long, store_id long, cents long, promo string, price_date date, fetched_at date, unit string"
D = date(2026, 4, 30)


def prices(spark, rows):
    return spark.createDataFrame([(p, s, c, promo, d, d, None) for p, s, c, promo, d in rows], PRICE)


@pytest.fixture
def flags_fixture(spark):
    cur = [(1, 1, 1000, None, D), (1, 2, 1020, None, D), (1, 3, 99900, None, D), (2, 1, 500, None, D), (2, 2, 510, None, D), (2, 3, 50, "PROMO", D)]
    return prices(spark, cur), prices(spark, [(1, 1, 1000, None, D), (1, 1, 550, None, D - timedelta(1))])


def test_flags(flags_fixture):
    current, history = flags_fixture
    assert {(r["product_id"], r["store_id"]) for r in quality.flag_outliers(current).collect()} == {(1, 3), (2, 3)}
    spike = quality.flag_spikes(history).collect()
    assert len(spike) == 1 and '"change_pct":81.8' in spike[0]["details"]
    deep = quality.flag_promo_depth(current).collect()
    assert [(r["product_id"], r["store_id"]) for r in deep] == [(2, 3)] and '"pct_of_regular":9.9' in deep[0]["details"]
    flags = quality.all_flags(current, history)
    assert ingest.insert_absent(flags, flags, ["product_id", "store_id", "price_date", "flag_type"]).count() == flags.count() == 4


def test_flags_on_empty(spark):
    none = prices(spark, [])
    assert quality.all_flags(none, none).count() == 0


def test_change_log(spark):
    at = [D + timedelta(i) for i in range(5)]
    log = prices(spark, [(1, 1, 1000, None, at[0]), (1, 1, 1000, None, at[1]), (1, 1, 1100, None, at[2]), (1, 1, 1100, "PROMO", at[3]), (1, 1, 1000, None, at[4])])
    got = [(r["cents"], r["promo"], r["change_type"]) for r in ingest.ingest_changes(log).orderBy("fetched_at").collect()]
    assert got == [(1000, None, "new"), (1100, None, "changed"), (1100, "PROMO", "changed"), (1000, None, "changed")]
    snapshot = log.limit(0).select("product_id", "store_id", "cents", "promo", F.col("fetched_at").alias("last_checked_at"), F.col("fetched_at").alias("last_changed_at"), "fetched_at")
    rows = log.orderBy("fetched_at").collect()
    for r in rows:
        snapshot = ingest.snapshot_after(prices(spark, [(r["product_id"], r["store_id"], r["cents"], r["promo"], r["fetched_at"])]), snapshot).withColumn("fetched_at", F.col("last_checked_at"))
        snapshot = spark.createDataFrame(snapshot.collect(), snapshot.schema)
    last = snapshot.collect()[0]
    assert (last["cents"], last["promo"], last["last_checked_at"], last["last_changed_at"]) == (1000, None, at[4], at[4])


def test_same_date_twice(spark):
    rows = spark.createDataFrame([(1, 1, 10, None, D, D, None), (1, 1, 12, None, D, D + timedelta(1), None)], PRICE)
    assert ingest.first_price_kept(rows).collect()[0]["cents"] == 10
    assert ingest.snapshot_latest(rows).collect()[0]["cents"] == 12


def test_propagate_prices_counts_null_promo_as_same(spark):
    cur = prices(spark, [(1, 1, 10, None, D), (2, 1, 20, "P", D), (3, 1, 5, None, D), (1, 2, 10, "P", D), (2, 2, 21, "P", D)])
    got = {r["product_id"]: r["change"] for r in ingest.propagate_prices(cur, spark.createDataFrame([(1, 2)], "source_id long, store_id long")).collect()}
    assert got == {1: "same", 2: "changed", 3: "new"}


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x"))).collect()[0][0]


@pytest.mark.parametrize(
    ("value", "a", "b", "c"),
    [("Kg", "kg", "kg", "kg"), ("K", "kg", "kg", "kg"), ("1kg", "1KG", "kg", "kg"), ("BUC.", "BUC.", "buc", "buc."), ("Litru", "L", "L", "l"), ("ml", "ml", "L", "ml"), ("500g", "500G", "kg", "500g"), ("4x2ml", "4X2ML", "L", "4x2ml"), ("Bucata", "pcs", "buc", "bucata"), ("16buc", "16BUC", "buc", "16buc"), ("XX", "XX", None, "xx"), ("", None, None, ""), (None, None, None, "")],
)
def test_units(spark, value, a, b, c):
    assert (one(spark, value, sc.store_unit), one(spark, value, sc.pack_unit), one(spark, value, sc.analysis_unit)) == (a, b, c)


@pytest.mark.parametrize(("value", "want"), [("21.06.2026 14:05", "2026-06-21 14:05"), ("21/06/2026", "2026-06-21"), ("2026-06-21 14:05", "2026-06-21 14:05"), ("", ""), (None, None)])
def test_dates(spark, value, want):
    got = one(spark, value, sc.iso_date)
    assert got == want and (got is None or one(spark, got, sc.iso_date) == got)


def test_text_functions(spark):
    assert one(spark, "Brânză & Țuică", sc.without_marks) == "Branza & Tuica"
    assert len({one(spark, b, sc.brand_key) for b in ("DR OETKER", "Dr. Oetker", "DR.OETKER")}) == 1
    assert one(spark, "a&#11;b&#x1F;c&#10;d&#65;", sc.clean_xml) == "abc&#10;d&#65;"
    shorts = sc.map_of({"n1": "Uno"})
    assert [one(spark, v, lambda x: sc.short_name(x, shorts)) for v in ("N1", "other shop", None)] == ["Uno", "Other Shop", ""]
    box = one(spark, "POLYGON((20 44, 22 44, 22 46, 20 46, 20 44))", sc.wkt_centre)
    assert (box["lat"], box["lon"]) == (45.0, 21.0)


def test_medians(spark):
    for values, want in (([1, 2, 10, 20], 10), ([1, 2, 3], 2), ([5], 5)):
        df = spark.createDataFrame([(v,) for v in values], "cents long")
        assert ordered.upper_medians(df, [], "cents", "m").collect()[0][0] == want


def test_outlier_filter_drops_low_minimum(spark):
    m = spark.createDataFrame([(1, "a", 100), (1, "b", 1000), (1, "c", 1100)], "product_id long, network string, cents long")
    assert {r["network"] for r in baskets.outlier_filter(m).collect()} == {"b", "c"}


def test_price_index_needs_three_networks(spark):
    rows = [(1, n, c) for n, c in (("a", 100), ("b", 110), ("c", 150))] + [(2, "a", 5), (2, "b", 6)]
    got = {r["network"]: (r["price_index"], r["products"]) for r in ix.price_index(spark.createDataFrame(rows, "product_id long, network string, cents long")).collect()}
    assert got == {"a": (100.0, 1), "b": (110.0, 1), "c": (150.0, 1)}


def test_rank_matches_window(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(20)) for i in range(200)]
    got = {r["i"]: r["rk"] for r in ix.rank_by_value(spark.createDataFrame(rows, "i long, v long"), "v", "rk").collect()}
    assert got == {i: 1 + sum(w > v for _, w in rows) for i, v in rows}


def test_trend_windows_reopen(spark):
    days = [date(2026, 1, 1) + timedelta(d) for d in (0, 6, 7, 20)]
    g = spark.createDataFrame([("n", 1, 1, d, 0.5) for d in days], "network string, type_id long, product_id long, price_date date, spread_pct double")
    got = {(r["window_start"] - days[0]).days: r["groups"] for r in variability.similarity_trend(g).collect()}
    assert got == {0: 2, 7: 1, 20: 1}


def test_islands(spark):
    rows = [(i, "s", D + timedelta(i), st, 0) for i, st in enumerate("AABA")]
    got = sorted((r["latest_id"], r["status"], r["count"]) for r in quality.run_islands(spark.createDataFrame(rows, "id long, script string, started date, status string, records long")).collect())
    assert got == [(1, "A", 2), (2, "B", 1), (3, "A", 1)]


def km(a, b):
    h = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def points(seed, n=150):
    rng = random.Random(seed)
    return [(i, 44 + rng.random() * 0.6 - 60 * (i % 7 == 0), 25 + rng.random() * 0.8, rng.randrange(20)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_pairs_and_dedup(spark, seed):
    pts = points(seed)
    df = spark.createDataFrame(pts, "id long, lat double, lon double, population long")
    assert {(r["a_id"], r["b_id"]) for r in geo.near_pairs(df, df, 5).collect()} == {(a[0], b[0]) for a in pts for b in pts if km(a, b) <= 5}
    kept = []
    for p in sorted(pts, key=lambda p: (-p[3], p[0])):
        if all(km(p, k) > 4 for k in kept):
            kept.append(p)
    assert {r["id"] for r in geo.dedup_points(df).collect()} == {p[0] for p in kept}


def plain_cover(stores, radius):
    near = {a[0]: [b[0] for b in stores if b[0] != a[0] and km(a, b) * 1000 <= radius] for a in stores}
    left, covers = set(near), {}
    while left:
        best = min(left, key=lambda i: (-sum(j in left for j in near[i]), i))
        covers[best] = {best, *near[best]}
        left -= covers[best]
    return covers


def plain_clusters(stores, radius, least, most):
    out = set()
    for anchor, members in plain_cover(stores, radius).items():
        if len(members) > most and radius // 2 >= least:
            out |= plain_clusters([s for s in stores if s[0] in members], radius // 2, least, most)
        else:
            out |= {(anchor, m, radius) for m in members}
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_clusters_match_greedy_cover(spark, seed):
    pts = points(seed)
    pts += [(10_000 + i, p[1], p[2], p[3]) for i, p in enumerate(pts[:40])]  # several stores at one place
    df = spark.createDataFrame(pts, "id long, lat double, lon double, population long")
    got = {(r["anchor_id"], r["store_id"], r["radius_m"]) for r in geo.store_clusters(df, max_per_cluster=6).collect()}
    assert got == plain_clusters(sorted(pts), 5000, 1250, 6)


def test_long_chains_are_deduplicated_to_the_end(spark):
    chain = [(i, 45.0, 25.0 + 0.03 * i, 1000 - i) for i in range(300)]
    got = {r["id"] for r in geo.dedup_points(spark.createDataFrame(chain[:40], "id long, lat double, lon double, population long")).collect()}
    assert got == set(range(0, 40, 2))


def test_ties_in_the_newest_row(spark):
    rows = [(1, 1, c, "2024-01-01", "2024-01-02", k) for k, c in ((1, 10), (3, 30), (2, 20))]
    df = spark.createDataFrame(rows, "product_id long, store_id long, cents long, price_date string, fetched_at string, id long")
    assert ingest.snapshot_latest(df, "id").first()["cents"] == 30 and ingest.prune_history(df).first()["id"] == 3
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    new = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z"), (3, "q")], "id long, name string")
    assert {tuple(r) for r in ingest.latest_wins(old, new).collect()} == {(1, "a"), (2, "y"), (3, "z")}
    assert {tuple(r) for r in ingest.insert_absent(old, new, ["id"]).collect()} == {(1, "a"), (2, "b"), (3, "z")}


def test_backfills(spark):
    df = spark.createDataFrame([(1, None, "2024-01-02", None), (2, "2023-01-01", "2024-01-02", False)], "id long, last_changed_at string, last_checked_at string, is_active boolean")
    assert [r["last_changed_at"] for r in ingest.backfill_changed(df).orderBy("id").collect()] == ["2024-01-02", "2023-01-01"]
    assert [r["is_active"] for r in ingest.backfill_active(df).orderBy("id").collect()] == [True, False]


def test_outliers_are_all_prices_outside_the_bounds(spark):
    rows = [(1, k, c) for k, c in enumerate([100, 1500, 1600])] + [(2, k, 100) for k in range(20)] + [(2, 20, 900), (3, 0, 5), (4, 0, 0)]
    df = spark.createDataFrame(rows, "product_id long, store_id long, cents long")
    assert {r["product_id"]: r["outlier_count"] for r in quality.outlier_summary(df).collect()} == {1: 2, 2: 1}
    totals = quality.outlier_totals(df).first()
    assert (totals["total_records"], totals["flagged_count"], totals["flagged_pct"]) == (25, 3, 12.0)


def test_population_is_zero_without_neighbours(spark):
    s = spark.createDataFrame([(1, 45.0, 25.0), (2, -30.0, 10.0)], "id long, lat double, lon double")
    loc = spark.createDataFrame([(1, 45.0, 25.05, 700), (2, 45.0, 25.2, 900)], "id long, lat double, lon double, population long")
    assert {r["store_id"]: r["surrounding_population"] for r in geo.surrounding_population(s, loc).collect()} == {1: 700, 2: 0}


def test_bigrams_skip_noise(spark):
    df = spark.createDataFrame([(1, "Lapte UHT 1.5% 1L"), (2, "Lapte de UHT"), (3, None)], "id long, name string")
    got = {r["token"]: r["count"] for r in text.ngrams(df, 2).collect()}
    assert got == {"lapte uht": 2}


def test_words_are_judged_once_and_texts_read_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame([("Lapte UHT 1.5% 1L, lapte uht",), ("Lapte de UHT bun 12kg",), (None,), ("",)], "text string").write.parquet(str(tmp_path / "d"))
    got = text.ngrams(spark.read.parquet(str(tmp_path / "d")), 2, text="text")
    assert [tuple(r) for r in got.collect()] == [("lapte uht", "Lapte UHT", 3), ("uht bun", "UHT bun", 1), ("uht lapte", "UHT lapte", 1)]
    shown = []
    monkeypatch.setattr(text, "checkpoint", lambda df, name: shown.append(df._jdf.queryExecution().executedPlan().toString()) or checkpoint(df, name))
    after = text.ngrams(spark.read.parquet(str(tmp_path / "d")), 2, text="text")._jdf.queryExecution().executedPlan().toString()
    assert shown[0].count("split(text") == 1 and "text#" not in after


def test_distinct_values_are_counted_without_copies(spark):
    rows = [(1, "A", "x", 1, 100), (1, "A", "x", 1, 100), (1, "A", "x", 2, None), (1, "A", "x", 3, 120), (1, "B", "x", 4, None), (1, None, "x", 5, 100), (2, None, "x", 5, 100)]
    df = spark.createDataFrame(rows, "product_id long, network string, price_date string, store_id long, cents long")
    got = variability.price_uniformity(df, 1)
    assert {(r.product_id, r.network): (r.store_count, r.distinct_prices) for r in got.collect()} == {(1, "A"): (3, 2), (1, "B"): (1, 0), (1, None): (1, 1), (2, None): (1, 1)}
    top = ix.top_products(df, spark.range(10))
    assert {r.product_id: (r.store_count, r.network_count) for r in top.collect()} == {1: (5, 2), 2: (1, 0)}
    for q in (got, top):
        assert "Expand" not in q._jdf.queryExecution().executedPlan().toString()


def test_observations_are_dealt_out_by_product(spark, monkeypatch):
    from pricegrain.plans import mapping, queries

    monkeypatch.setattr(mapping, "ROWS_A_TASK", 500)
    t = mapping.Tables(spark, "/root/testdata/sf0.001")
    assert t.tasks == -(-t.raw("lineitem").count() // 500) > 4
    plan = queries.sims(t)._jdf.queryExecution().executedPlan().toString()
    assert f", {t.tasks})" in plan and "hashpartitioning(product_id" not in plan and "hashpartitioning(store_id" not in plan


@pytest.mark.parametrize("name", ["similarity_tiers", "top_products", "price_uniformity", "top_variable", "store_tiers", "popular_products", "weekly_products"])
def test_prices_are_shuffled_once_into_tasks_of_bounded_rows(spark, monkeypatch, name):
    from pricegrain.plans import mapping, queries

    monkeypatch.setattr(mapping, "ROWS_A_TASK", 500)
    t = mapping.Tables(spark, "/root/testdata/sf0.001")
    plan = queries.PLANS[name](t)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert any("l_partkey#" in line and f", {t.tasks})" in line for line in dealt)
    assert not any("product_id#" in line for line in dealt)  # what groups or ranks prices finds them where they are
    rows = t.offers("list").groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
    assert t.tasks / 2 < rows[0] <= t.tasks and rows[1] < 4 * 500


def test_names_tell_networks(spark):
    names = ["PROFI CLUJ", "MI CENTRU", "SG NORD", "EXPRESS X", "SEGLROS", "unknown", "Mega Image 3"]
    df = spark.createDataFrame([(i, n, None) for i, n in enumerate(names)], "id long, name string, network string")
    got = {r["id"]: r["network"] for r in ingest.network_by_name(df).collect()}
    assert [got[i] for i in range(7)] == ["PROFI", "5940475870003", "5940475870003", "5940475006709", "SELGROS", None, "5940475870003"]


XML = """<Root><RetailStore><Id>1</Id><Name>Shop</Name><Addr><Addrstring>Str</Addrstring><Zipcode>1</Zipcode><Location><Lat>45</Lat><Lon>25</Lon></Location><Uat>7</Uat></Addr>
<Products><Product><Id>5</Id><Network>N2</Network><Price>3.50</Price><PriceDate>21.06.2026 14:05</PriceDate><Promo></Promo><Unit>Kg</Unit></Product>
<Product><Id>6</Id><Price>0</Price><PriceDate>21.06.2026</PriceDate></Product><Product><Price>2</Price><PriceDate>21.06.2026</PriceDate></Product></Products></RetailStore>
<RetailStore><Id>2</Id><Network>N1</Network><Products><Product><Id>5</Id><Network>N2</Network><Price>4</Price><PriceDate>2026-06-21</PriceDate><Promo>da</Promo></Product></Products></RetailStore>
<RetailStore><Id>3</Id><Name>Empty</Name></RetailStore></Root>"""


def test_xml_documents(spark, tmp_path):
    (tmp_path / "s.xml").write_text(XML)
    stores, got, conflicts = readers.parse_stores(readers.read_xml(spark, str(tmp_path), "RetailStore", readers.STORE_XML))
    assert {r["id"]: r["network_id"] for r in stores.collect()} == {1: "N2", 2: "N1", 3: None}
    assert sorted((r["product_id"], r["store_id"], r["cents"], r["price_date"], r["promo"]) for r in got.collect()) == [(5, 1, 350, "2026-06-21 14:05", None), (5, 2, 400, "2026-06-21", "da")]
    assert [r["store_id"] for r in conflicts.collect()] == [2]


BROKEN = """<?xml version="1.0"?><Root><RetailStore><Id>1</Id><Name>A&#x1C;B &amp; c</Name></RetailStore>
<RetailStore><Id>2</Id><Name>lost end
<RetailStore><Id>3</Id><Name>bad <b></Name></RetailStore><RetailStore x="1"><Id>4</Id><Name>ok&#28;&#x0;</Name><Addr><Location><Lat>abc</Lat></Location></Addr></RetailStore>
<RetailStores>no record</RetailStores></Root>"""


def test_xml_is_cleaned_and_broken_records_are_told(spark, tmp_path):
    (tmp_path / "s.xml").write_text(BROKEN)
    (tmp_path / "t.xml").write_text("<Root></Root>")
    rows, rejects = readers.read_xml_with_rejects(spark, str(tmp_path), "RetailStore", readers.STORE_XML)
    assert sorted((r["Id"], r["Name"]) for r in rows.collect()) == [(1, "AB & c"), (4, "ok")]
    told = {r["reason"]: r["record"] for r in rejects.collect()}
    assert set(told) == {"cut", "malformed", "value"}
    assert "lost end" in told["cut"] and "bad <b>" in told["malformed"] and "abc" in told["value"]


def test_catalogues_of_two_sources(spark):
    a = spark.createDataFrame([(1, "one", None), (2, "two", 1)], "id long, name string, parent_id long")
    b = spark.createDataFrame([(2, "zwei", None), (3, "drei", 1), (3, "drei", 2)], "id long, name string, parent_id long")
    got = readers.union_sources({"network": a, "oug": b})
    assert sorted(tuple(r) for r in got.select("id", "name", "source").collect()) == [(1, "one", "network"), (2, "zwei", "oug"), (3, "drei", "oug")]


def test_products_fall_back_to_the_category_asked_for(spark):
    listed = spark.createDataFrame([(1, "a", None, 7), (1, "a", None, 5), (2, "b", 3, 9), (3, None, None, None)], "id long, name string, categ_id long, asked_categ_id long")
    assert sorted(tuple(r) for r in readers.with_asked_category(listed).collect()) == [(1, "a", 5), (2, "b", 3), (3, None, None)]


def test_config_and_sinks(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"baskets":[{"id":"x","items":[{"label":"milk","qty":2,"product_ids":[1,2]},{"label":"bread","qty":1,"product_ids":[3]}]}]}')
    b = readers.baskets(spark.read.option("multiLine", True).json(str(tmp_path / "b.json")))
    assert sorted((r["item_no"], r["product_id"]) for r in b.collect()) == [(0, 1), (0, 2), (1, 3)]
    look = readers.network_lookup(spark.createDataFrame([("N1", "Uno", ["Alt"], None)], "id string, short string, aliases array<string>, b2b boolean"))
    assert {(r["key"], r["b2b"]) for r in look.collect()} == {("n1", False), ("alt", False)}
    (tmp_path / "ids.txt").write_text("# c\n3\n\n4\n4\n")
    assert sorted(r["id"] for r in readers.allow_list(spark, str(tmp_path / "ids.txt")).collect()) == [3, 4]
    (tmp_path / "p.csv").write_text("name,lat,lon,population\nA,45,25,3000\nB,x,25,3000\nC,45,25,10\n")
    assert [r["name"] for r in readers.localities(spark.read.option("header", True).csv(str(tmp_path / "p.csv"))).collect()] == ["A"]
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, name string")
    readers.write_csv(df, str(tmp_path / "out"), by="id")
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2
    readers.write_ids(df, "id", str(tmp_path / "idlist"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "idlist")).collect()) == ["1", "2"]
    readers.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert readers.properties_json(df, "id").collect()[0]["properties"] == '{"name":"x"}'


def test_second_batch_reads_the_snapshot_where_it_lies(spark):
    from pricegrain.storage import bucketed

    empty = spark.createDataFrame([], "product_id long, store_id long, cents long, promo string, price_date date, last_checked_at date, last_changed_at date")
    first = prices(spark, [(p, s, 100 + p, None, D) for p in range(30) for s in range(5)])
    stored = bucketed(ingest.merged(ingest.compare(first), empty), ingest.KEY)
    second = prices(spark, [(1, 1, 101, None, D + timedelta(1)), (2, 1, 300, "P", D + timedelta(1)), (99, 1, 5, None, D + timedelta(1))])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = ingest.compare(second, stored)
        got = {(r["product_id"], r["change_type"], r["was"]) for r in ingest.history_of(steps).collect()}
        after = ingest.merged(steps, stored)
        plan = after._jdf.queryExecution().executedPlan().toString()
        rows = {(r["product_id"], r["store_id"]): (r["cents"], r["last_checked_at"], r["last_changed_at"]) for r in after.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(2, "changed", 102), (99, "new", None)}
    assert len(rows) == 151 and rows[1, 1] == (101, D + timedelta(1), D) and rows[2, 1] == (300, D + timedelta(1), D + timedelta(1)) and rows[2, 2] == (102, D, D)
    assert plan.count("Exchange") == 1  # of the batch; the snapshot is read twice, by its buckets


def test_ci_stores_follow_the_grid(spark):
    rows = [(i, "n" if i else None, 44.0 + (i % 3) * 0.5, 21.0 + (i % 5) * 0.5, 100 * i) for i in range(40)] + [(50, "n", None, 21.0, 9), (51, "n", 44.0, 21.0, None)]
    stores = spark.createDataFrame(rows, "id long, network string, lat double, lon double, population long")
    got = {r["id"] for r in sampling.ci_stores(stores, per_net=2, mid=3).collect()}

    def key(r):
        row, col = int((r[2] - 43.6) / 0.45), int((r[3] - 20.3) / 0.45)
        return row, col if row % 2 == 0 else 1000 - col, r[4], r[0]

    middle = rows[:40][int(40 * 0.35) : int(40 * 0.65)]
    assert got == {39, 38} | {r[0] for r in sorted(middle, key=key)[:3]}


def test_store_orders(spark):
    rows = [(1, 45.0, 25.0, 5), (2, 45.0, 25.0, 9), (3, 43.7, 20.4, 1), (4, 45.0, 20.4, None), (5, 45.0, 25.0, 9)]
    stores = spark.createDataFrame(rows, "id long, lat double, lon double, population long")
    assert [r[0] for r in sampling.store_order_by_population(stores).orderBy("place").collect()] == [2, 5, 1, 3, 4]
    assert [r[0] for r in sampling.store_order_by_grid(stores).orderBy("place").collect()] == [3, 2, 5, 1, 4]  # the second row read here is odd and runs west


def apart(a, b):
    p = math.radians
    h = math.sin(p(b[0] - a[0]) / 2) ** 2 + math.cos(p(a[0])) * math.cos(p(b[0])) * math.sin(p(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def test_sentinels_are_far_apart(spark):
    rng = random.Random(4)
    stores = [(i, round(44 + rng.random() * 3, 3), round(21 + rng.random() * 5, 3)) for i in range(30)] + [(90, None, 22.0)]
    ps = [("n" if s < 25 or s == 90 else "few", s, p, 0 if s == 7 else 10, D if s != 8 else D - timedelta(30)) for s, _, _ in stores for p in range(30 - s if s < 30 else 99)]
    df = spark.createDataFrame(ps, "network string, store_id long, product_id long, cents long, fetched_at date")
    got = variability.sentinel_stores(df, spark.createDataFrame(stores, "id long, lat double, lon double"), since=D - timedelta(1)).collect()
    at = {s: (a, b) for s, a, b in stores}
    for network, members in (("n", [s for s in range(25) if s not in (7, 8)]), ("few", list(range(25, 30)))):
        rest = members[:20]
        chosen = [rest.pop(0)]
        while len(chosen) < 3:
            best = max(rest, key=lambda s: (round(min(apart(at[s], at[c]) for c in chosen), 6), -s))
            chosen.append(best)
            rest.remove(best)
        mine = sorted((r for r in got if r["network"] == network), key=lambda r: r["pick_no"])
        assert [r["store_id"] for r in mine] == chosen
        assert mine[0]["spread_km"] == pytest.approx(max(apart(at[a], at[b]) for a in chosen for b in chosen), abs=1e-5)


def test_sentinels_of_a_small_network(spark):
    one = spark.createDataFrame([("n", 1, 1, 10, D)], "network string, store_id long, product_id long, cents long, fetched_at date")
    assert [(r["store_id"], r["spread_km"]) for r in variability.sentinel_stores(one, spark.createDataFrame([(1, 44.0, 21.0)], "id long, lat double, lon double")).collect()] == [(1, 0.0)]


@pytest.mark.parametrize("leaf", [64, 2])
def test_people_around_dense_places(spark, monkeypatch, leaf):
    monkeypatch.setattr(geo, "LEAF_POINTS", leaf)
    rng = random.Random(leaf)
    spot = lambda: (round(45 + rng.gauss(0, 0.12), 3), round(25 + rng.gauss(0, 0.12), 3))
    people = [(i, *spot(), rng.randrange(100)) for i in range(400)] + [(1000 + i, 45.0, 25.0, 1) for i in range(50)] + [(2000, None, 25.0, 7)]
    stores = [(i, *spot()) for i in range(40)] + [(100, 45.0, 25.0), (101, 45.0, 25.0), (102, None, 25.0), (103, -80.0, 170.0)]
    got = {r["store_id"]: r["surrounding_population"] for r in geo.surrounding_population(spark.createDataFrame(stores, "id long, lat double, lon double"), spark.createDataFrame(people, "id long, lat double, lon double, population long")).collect()}
    assert got == {s: sum(p for _, a, b, p in people if a is not None and lat is not None and apart((lat, lon), (a, b)) <= 10) for s, lat, lon in stores}


def test_dedup_of_dense_places(spark):
    rng = random.Random(8)
    points = [(i, round(45 + rng.gauss(0, 0.06), 4), round(25 + rng.gauss(0, 0.06), 4), rng.randrange(50)) for i in range(300)] + [(1000 + i, 45.0, 25.0, 50) for i in range(300)] + [(5000, None, 1.0, 99)]
    kept = []
    for i, lat, lon, population in sorted((p for p in points if p[1] is not None), key=lambda p: (-p[3], p[0])):
        if all(apart((lat, lon), k[1:]) >= 4 for k in kept):
            kept.append((i, lat, lon))
    got = geo.dedup_points(spark.createDataFrame(points, "id long, lat double, lon double, population long"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(kept)
    assert geo.dedup_points(spark.createDataFrame([], "id long, lat double, lon double, population long")).collect() == []


def test_places_without_a_basket_take_the_national_one(spark):
    stores = spark.createDataFrame([(1, 1, "A"), (2, 1, "B"), (3, 2, "A"), (4, None, "A")], "id long, uat_id long, network string")
    scored = spark.createDataFrame([(1, "A", "x", 5.0, True), (1, "B", "x", 4.0, True), (2, "A", "x", 9.0, False)], "uat_id long, network string, basket_id string, cost_month double, comparable boolean")
    national = spark.createDataFrame([("A", "x", 6.0, True), ("B", "x", 7.0, True)], "network string, basket_id string, cost_month double, comparable boolean")
    got = {r["uat_id"]: tuple(r)[1:] for r in geo.uat_stats(stores, scored, "x", ("B",), national).collect()}
    assert got == {1: (2, 1, 4.0, 5.0, 2, "B", False), 2: (1, 1, 6.0, 7.0, 2, "A", True)}
    assert {r["uat_id"]: (r["basket_n_networks"], r["cheapest_net"]) for r in geo.uat_stats(stores, scored, "x", (), national.limit(0)).collect()}[2] == (0, None)


def test_noise_in_text_is_what_is_noise_tells(spark):
    words = [*sc.STOPWORDS, *[w.upper() for w in sc.STOPWORDS], "și", "DIN", "fără", "500g", "500G", "5kg", "12ml", "12mlx", "33cl", "7", "007", "12a", "ab", "abc", "a", "ß", "ñandú", "é1", "de-la", "mixt", "setul", "x500g", "😀😀", "😀😀😀", "5 g", "1.5", "1,5kg"]
    rng = random.Random(2)
    texts = [(i, rng.choice(["", " ", "(", "-"]) + rng.choice([" ", ", ", "/", " - ", "–"]).join(rng.choices(words, k=12)) + rng.choice(["", ".", ")"])) for i in range(60)] + [(100, ""), (101, None), (102, "de la"), (103, "...")]
    df = spark.createDataFrame(texts, "id long, t string").select("id", text.words_of(F.col("t")).alias("got"), F.filter(F.split(F.coalesce("t", F.lit("")), r"[\s/,.\-–()\[\]]+"), lambda w: (w != "") & ~sc.is_noise(w)).alias("want"))
    for r in df.collect():
        assert (r["got"] or []) == r["want"]


def test_cluster_ages_and_clusters_to_skip(spark):
    clusters = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (3, 2), (4, 4)], "anchor_id long, store_id long")
    ages = spark.createDataFrame([(1, 5), (2, 9999), (3, 7), (4, 0)], "store_id long, age_days long")
    assert {tuple(r) for r in sampling.cluster_order(clusters, ages).collect()} == {(1, 9999), (3, 9999), (4, 0)}
    skip = spark.createDataFrame([(2,), (3,), (3,)], "store_id long")
    assert {tuple(r) for r in sampling.skippable_clusters(clusters, skip).collect()} == {(1, False, 2), (3, True, 2), (4, False, 1)}


def test_texts_of_good_records_are_not_written(spark, tmp_path, monkeypatch):
    (tmp_path / "r.xml").write_text("<A><x>1</x></A><A><x>2</A>")
    kept = []
    monkeypatch.setattr(readers, "checkpoint", lambda df, name: kept.append(df) or df)
    readers.read_xml_with_rejects(spark, str(tmp_path / "r.xml"), "A", "x long")
    assert [(r.record is None, r.reason) for r in kept[0].orderBy("reason").collect()] == [(True, None), (False, "malformed")]


def test_xml_documents_are_small_and_prices_shuffled_once(spark, monkeypatch, tmp_path):
    from pricegrain.plans import mapping, xml_queries

    t = mapping.Tables(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(xml_queries, "scratch", lambda session, name: str(tmp_path / name))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where stores are many
    try:
        plan = xml_queries.records(t)._jdf.queryExecution().executedPlan().toString()
        path = xml_queries.documents(t)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(l_partkey#" in plan and "hashpartitioning(store_id#" not in plan and "hashpartitioning(l_suppkey#" not in plan
    written = sum(f.stat().st_size for f in (tmp_path / "xml").glob("part-*"))
    texts = spark.read.text(path)
    assert texts.count() == t.current().count()
    assert 4 * written < texts.agg(F.sum(F.length("value"))).first()[0]


@pytest.mark.parametrize("name", ["xml_stores", "xml_prices", "xml_rejects"])
def test_xml_queries_write_their_documents_alone(spark, monkeypatch, name):
    from pricegrain.plans import mapping, xml_queries

    monkeypatch.setattr(readers, "checkpoint", lambda df, what: pytest.fail(f"{what} were written"))
    df = getattr(xml_queries, name)(mapping.Tables(spark, "/root/testdata/sf0.01"))  # the smallest that has rejects
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1  # each record is parsed once
    assert df.count() > 0


def test_records_are_cut_where_names_stand_in_texts_too(spark, tmp_path):
    (tmp_path / "r.xml").write_text("x<As>1</As> A <A>A<As/></A><A ><A>lost<A y='&#1;'>2 A</A>A<As></As>")
    got = readers.xml_records(spark, str(tmp_path), "A").collect()
    assert sorted((r["record"], r["whole"]) for r in got) == [("<A >", False), ("<A y=''>2 A</A>", True), ("<A>A<As/></A>", True), ("<A>lost", False)]
