"""Ranks, running sums, runs and medians by ranges, against plain Python."""

import random
from collections import Counter, defaultdict
from itertools import groupby

import pytest

from pricegrain.operators import index as ix
from pricegrain.operators import ordered, quality, variability


def grouped(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    return groups


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    # one group has two thirds of all rows
    return [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.randrange(40) if rng.random() < 0.95 else None, i, rng.choice(["x", "x", "x", "y"]) if rng.random() < 0.97 else None) for i in range(900)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "g string, v int, id long, s string, range int, here int").repartition(5)


def order(r):
    return (r[1] is not None, r[1] or 0, r[2])


def test_numbered(rows, table):
    got = {r.id: r.n for r in ordered.numbered(table, ["g"], ["v", "id"], "n").collect()}
    assert got == {r[2]: i + 1 for members in grouped(rows).values() for i, r in enumerate(sorted(members, key=order))}
    whole = {r.id: r.n for r in ordered.numbered(table, [], ["v", "id"], "n").collect()}
    assert whole == {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=order))}


def test_running_sum(rows, table):
    got = {r.id: r.total for r in ordered.running_sum(table, ["g"], ["v", "id"], "id", "total").collect()}
    want = {}
    for members in grouped(rows).values():
        total = 0
        for r in sorted(members, key=order):
            total += r[2]
            want[r[2]] = total
    assert got == want


def test_islands(rows, table):
    got = {r.id: r.k for r in ordered.islands(table, ["g"], ["v", "id"], "s", "k").collect()}
    want = {}
    for members in grouped(rows).values():
        k, last = 0, None
        for r in sorted(members, key=order):
            if last is None or r[3] is None or r[3] != last:
                k += 1
            last = r[3]
            want[r[2]] = k
    assert got == want


def test_one_run_across_all_ranges(spark):
    df = spark.range(2000).selectExpr("'g' AS g", "id", "'same' AS s")
    assert {r.k for r in ordered.islands(df, ["g"], ["id"], "s", "k").collect()} == {1}


def test_upper_medians(rows, table):
    got = {r.g: (r.m, r.n) for r in ordered.upper_medians(table, ["g"], "v", "m").collect()}
    want = {}
    for g, members in grouped(rows).items():
        values = sorted(r[1] for r in members if r[1] is not None)
        want[g] = (values[len(values) // 2], len(values))
    assert got == want


def test_empty_tables(table):
    none = table.limit(0)
    assert ordered.numbered(none, ["g"], ["id"], "n").collect() == []
    assert ordered.running_sum(none, ["g"], ["id"], "id", "n").collect() == []
    assert ordered.islands(none, ["g"], ["id"], "s", "n").collect() == []
    assert ordered.upper_medians(none, ["g"], "v", "n").collect() == []


def test_run_islands(spark):
    runs = [("a", "ok", 1, 1), ("a", "ok", 2, 2), ("a", "bad", 3, 3), ("a", "ok", 3, 4), ("b", "bad", 1, 5)]
    got = quality.run_islands(spark.createDataFrame(runs, "script string, status string, started int, id long"))
    assert sorted(tuple(r) for r in got.select("script", "island", "status", "latest_id", "count").collect()) == [("a", 1, "ok", 2, 2), ("a", 2, "bad", 3, 1), ("a", 3, "ok", 4, 1), ("b", 1, "bad", 5, 1)]


def test_uniformity_percentiles_count_from_above(spark):
    u = spark.createDataFrame([("n", float(i), 1 + i % 2) for i in range(100)] + [("one", 5.0, 1)], "network string, spread_pct double, distinct_prices long")
    got = {r.network: (r.groups, r.uniform_pct, r.p50, r.p95, r.max_pct) for r in variability.uniformity_by_network(u).collect()}
    assert got == {"n": (100, 50.0, 49.0, 94.0, 99.0), "one": (1, 100.0, 5.0, 5.0, 5.0)}


def test_population_band(spark):
    stores = spark.createDataFrame([(i, "n", i // 2) for i in range(20)], "id long, network string, population long")
    assert sorted(r.id for r in ix.population_band(stores).collect()) == list(range(7, 13))


def test_medians_have_a_column_for_each_network(spark):
    latest = spark.createDataFrame([(1, "B one", 100), (1, "b-one", 300), (1, None, 5), (2, "A", 7), (2, "A", 9)], "product_id long, network string, cents long")
    got = {r.product_id: r.asDict() for r in variability.medians_by_network(latest).collect()}
    assert got == {1: {"product_id": 1, "price_a": None, "price_b_one": 1.0, "price_b_one_2": 3.0}, 2: {"product_id": 2, "price_a": 0.09, "price_b_one": None, "price_b_one_2": None}}
    with pytest.raises(ValueError):
        variability.medians_by_network(latest, 2)
    assert variability.medians_by_network(latest.limit(0)).collect() == []


def test_counts_are_what_a_median_sorts(spark):
    table = spark.createDataFrame([(1, c) for c, n in Counter([5, 5, 5, 7]).items() for _ in range(n)], "g int, v int")
    assert [(r.v, r.n) for r in ordered.value_counts(table, ["g"], "v", "n").orderBy("v").collect()] == [(v, len(list(k))) for v, k in groupby([5, 5, 5, 7])]
