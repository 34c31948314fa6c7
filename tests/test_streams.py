"""Micro-batches: snapshot, flags and history, dedup, windows that close."""

import random
from datetime import date, datetime, timedelta

import pytest

from pricegrain.operators import ingest, quality
from pricegrain.plans import stream_queries
from pricegrain.plans.mapping import Tables
from pricegrain.streaming import snapshot, streams

OBS = "product_id long, store_id long, cents long, promo string, price_date date, fetched_at timestamp"
START = datetime(2026, 4, 1, 6)


def observations(n=200, keys=6):
    rng = random.Random(3)
    at = [START + timedelta(hours=i) for i in range(n)]
    return [(rng.randrange(keys), rng.randrange(4), rng.choice([100, 110, 300]), rng.choice([None, "P"]), t.date(), t) for t in at]


def batches(spark, rows, n):
    size = -(-len(rows) // n)
    return [spark.createDataFrame(rows[k * size : (k + 1) * size], OBS) for k in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_batches_equal_the_batch_operator(spark, tmp_path):
    rows = observations()
    table = snapshot.SnapshotTable(spark, str(tmp_path / "t"), parts=3)
    for k, batch in enumerate(batches(spark, rows, 3)):
        table.merge(batch, k)
    whole = spark.createDataFrame(rows, OBS)
    assert rows_of(table.history().drop("was", "price_date")) == rows_of(ingest.ingest_changes(whole))
    newest = {}
    for p, s, cents, promo, day, at in rows:
        old = newest.get((p, s))
        moved = old is None or (old[0], old[1]) != (cents, promo)
        newest[p, s] = (cents, promo, day if moved else old[2], at, at if moved else old[4])
    assert {tuple(r)[:2]: tuple(r)[2:] for r in table.snapshot().collect()} == newest


def test_flags_grow_with_batches_and_are_told_once(spark, tmp_path):
    table = snapshot.SnapshotTable(spark, str(tmp_path / "t"), parts=3)
    rows = observations(160, 4)
    want, steps = set(), None
    for k, batch in enumerate(batches(spark, rows, 3)):
        table.merge(batch, k)
        current = table.snapshot().join(batch.select("product_id").distinct(), "product_id", "left_semi")
        want |= {tuple(r)[:4] for r in quality.flag_outliers(current).unionByName(quality.flag_promo_depth(current)).collect()}
    steps = ingest.compare(spark.createDataFrame(rows, OBS))
    want |= {tuple(r)[:4] for r in quality.flag_moves(ingest.history_of(steps)).collect()}
    got = [tuple(r)[:4] for r in table.flags().collect()]
    assert want and sorted(got, key=str) == sorted(want, key=str)


def test_batch_that_failed_or_comes_again(spark, tmp_path, monkeypatch):
    rows = observations(120)
    parts = batches(spark, rows, 2)
    table, other = (snapshot.SnapshotTable(spark, str(tmp_path / name), parts=3) for name in "ab")
    for k, batch in enumerate(parts):
        other.merge(batch, k)
    table.merge(parts[0], 0)
    before = rows_of(table.snapshot()), rows_of(table.history()), rows_of(table.flags())
    put = snapshot.SnapshotTable.put

    def broken(self, kind, *rest):
        put(self, kind, *rest)
        if kind == "flags":
            raise RuntimeError("lost")

    monkeypatch.setattr(snapshot.SnapshotTable, "put", broken)
    with pytest.raises(RuntimeError):
        table.merge(parts[1], 1)
    monkeypatch.setattr(snapshot.SnapshotTable, "put", put)
    assert before == (rows_of(table.snapshot()), rows_of(table.history()), rows_of(table.flags()))  # nothing of it is seen
    for k in (1, 1, 0):
        table.merge(parts[k], k)
    for of in ("snapshot", "history", "flags"):
        assert rows_of(getattr(table, of)()) == rows_of(getattr(other, of)())


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = snapshot.SnapshotTable(spark, str(tmp_path / "t"), parts=8, splits=2)
    table.merge(spark.createDataFrame([(p, s, 100, None, START.date(), START) for p in range(20) for s in range(4)], OBS), 0)
    table.merge(spark.createDataFrame([(3, 1, 120, None, START.date(), START + timedelta(1))], OBS), 1)
    versions = table.committed()[1]
    assert sorted(v for (kind, _), v in versions.items() if kind == "snapshot").count(1) == 1
    assert table.snapshot().count() == 80


def test_a_batch_is_dealt_out_by_product_once(spark, tmp_path):
    table = snapshot.SnapshotTable(spark, str(tmp_path / "t"), parts=3)
    table.merge(spark.createDataFrame(observations(80), OBS), 0)
    kept = table.kept(table.snapshot())
    plan = quality.flag_outliers(kept)._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "InMemoryTableScan" in plan and "Exchange" not in plan
    assert rows_of(quality.flag_outliers(kept)) == rows_of(quality.flag_outliers(table.snapshot()))
    kept.unpersist()


def test_empty_batch_and_empty_table(spark, tmp_path):
    table = snapshot.SnapshotTable(spark, str(tmp_path / "t"))
    assert table.snapshot().count() == table.history().count() == table.flags().count() == 0
    table.merge(spark.createDataFrame([], OBS), 0)
    assert table.committed() == (-1, {})
    table.merge(spark.createDataFrame(observations(5), OBS), 1)
    assert table.history().count() > 0


def test_append_absent(spark, tmp_path):
    rows = observations() + [(9, 9, 5, None, None, START), (9, 9, 4, "x", None, START)]
    sink = streams.append_absent(str(tmp_path / "h"))
    parts = batches(spark, rows, 3)
    for k in (0, 1, 1, 2, 0):
        sink(parts[k], k)
    stored = spark.read.schema(OBS).parquet(str(tmp_path / "h"))
    want = {}
    for k in range(3):
        for r in sorted((tuple(x) for x in parts[k].collect()), key=lambda r: (r[5], r[2], r[3] is not None, r[3] or "")):
            want.setdefault((r[0], r[1], r[4]), r)
    assert {(r.product_id, r.store_id, r.price_date): (r.product_id, r.store_id, r.cents, r.promo, r.price_date, r.fetched_at) for r in stored.collect()} == want
    assert stored.count() == len(want)
    plan = streams.history_on(str(tmp_path / "h"), parts[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [price_date" in plan


def test_windows_close_and_late_rows_are_dropped(spark, tmp_path):
    run = lambda rows: spark.createDataFrame(rows, OBS).write.mode("append").parquet(str(tmp_path / "in"))
    seen = []

    def go():
        df = streams.stream_window_avg(spark.readStream.schema(OBS).parquet(str(tmp_path / "in")), ["store_id"], "1 day", "1 hour")
        df.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda b, _: seen.extend(tuple(r) for r in b.collect())).trigger(availableNow=True).start().awaitTermination(120)

    first, second = datetime(2026, 4, 1), datetime(2026, 4, 2)
    obs = lambda at: (1, 1, 100, None, at.date(), at)
    run([obs(first + timedelta(hours=1)), obs(first + timedelta(hours=2)), obs(second + timedelta(hours=5))])
    go()
    assert seen == [(first, 1, 200, 2)]
    run([obs(first + timedelta(hours=3)), obs(second + timedelta(hours=1)), obs(second + timedelta(days=2))])  # the first of these comes too late
    go()
    assert seen == [(first, 1, 200, 2), (second, 1, 200, 2)]


def test_replay_of_the_model_has_late_rows(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    closed = stream_queries.stream_window_avg(t).agg({"n": "sum"}).first()[0]
    arrived = stream_queries.delayed(t)
    last = max(r[0] for r in arrived.selectExpr("max(fetched_at)").collect())
    due = arrived.filter(f"date_trunc('day', fetched_at) + interval 1 day <= timestamp'{last}' - interval 1 day").count()
    assert 0 < closed < due


def test_dates_of_a_replay(spark):
    days = [(date(2026, 1, 1) + timedelta(k), None) for k in range(8)]
    got = stream_queries.sliced(spark.createDataFrame(days, "d date, x int"), "d").orderBy("d").collect()
    assert [r.slice for r in got] == [0, 0, 1, 1, 2, 2, 3, 3]
