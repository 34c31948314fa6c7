"""Quality flags and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.functions.scalars import half_up
from pricegrain.operators.ordered import islands, upper_medians

FLAG = ["product_id", "store_id", "price_date"]


def flag_outliers(current: DataFrame, z: float = 3.0) -> DataFrame:
    """Modified z-score by median absolute deviation, both upper medians, over products with three positive prices."""
    current = current.filter("cents > 0")
    mid = upper_medians(current, ["product_id"], "cents", "med").filter("n >= 3").drop("n")
    d = current.join(mid, "product_id").withColumn("dev", F.abs(F.col("cents") - F.col("med")))
    mad = upper_medians(d, ["product_id"], "dev", "mad").filter("mad > 0").drop("n")
    score = F.lit(0.6745) * F.col("dev") / F.col("mad")
    return d.join(mad, "product_id").filter(score > z).select(*FLAG, F.lit("outlier_price").alias("flag_type"), F.to_json(F.struct((F.col("cents") / 100.0).alias("price"), (F.col("med") / 100.0).alias("median"), half_up(score).alias("z"))).alias("details"))


def flag_spikes(prices: DataFrame, pct: float = 0.5) -> DataFrame:
    """Moves of more than half between the two newest dates on one product and store."""
    newest = prices.filter("price_date is not null").select("price_date").distinct().orderBy(F.desc("price_date")).limit(2)
    days = newest.agg(F.max("price_date").alias("now_date"), F.min("price_date").alias("before_date")).filter("now_date > before_date")  # one row, or none
    both = prices.join(F.broadcast(days), F.col("price_date").isin(F.col("now_date"), F.col("before_date")))
    is_now = F.col("price_date") == F.col("now_date")
    pairs = both.groupBy("product_id", "store_id").agg(F.max(F.when(is_now, F.col("cents"))).alias("now"), F.max(F.when(~is_now, F.col("cents"))).alias("before"), F.max("now_date").alias("now_date"))
    j = pairs.filter("before > 0 and now is not null")
    change = F.abs(F.col("now") - F.col("before")).cast("double") / F.col("before")
    return j.filter(change > pct).select("product_id", "store_id", F.col("now_date").alias("price_date"), F.lit("price_spike").alias("flag_type"), F.to_json(F.struct((F.col("now") / 100.0).alias("price"), (F.col("before") / 100.0).alias("previous"), half_up(change * 100.0, 1).alias("change_pct"))).alias("details"))


def flag_promo_depth(current: DataFrame, depth: float = 0.2) -> DataFrame:
    """Promo prices below a fifth of the product's regular average."""
    regular = current.filter("promo is null").groupBy("product_id").agg(F.sum("cents").alias("s"), F.count("*").alias("n"))
    j = current.filter("promo is not null").join(regular, "product_id")
    mean = F.col("s").cast("double") / F.col("n")
    return j.filter(F.col("cents") < mean * depth).select(*FLAG, F.lit("promo_too_deep").alias("flag_type"), F.to_json(F.struct((F.col("cents") / 100.0).alias("price"), half_up(F.lit(100.0) * F.col("cents") / mean, 1).alias("pct_of_regular"))).alias("details"))


def flag_moves(history: DataFrame, pct: float = 0.5) -> DataFrame:
    """Moves of more than half from the price before it, of history rows with that price (was); one flag for each product, store and date, the largest move."""
    change = F.abs(F.col("cents") - F.col("was")).cast("double") / F.col("was")
    moved = history.filter(F.col("was") > 0).withColumn("change", change).filter(F.col("change") > pct)
    largest = moved.groupBy(*FLAG).agg(F.max(F.struct("change", "cents", "was")).alias("m"))
    return largest.select(*FLAG, F.lit("price_spike").alias("flag_type"), F.to_json(F.struct((F.col("m.cents") / 100.0).alias("price"), (F.col("m.was") / 100.0).alias("previous"), half_up(F.col("m.change") * 100.0, 1).alias("change_pct"))).alias("details"))


def all_flags(current: DataFrame, prices: DataFrame) -> DataFrame:
    return flag_outliers(current).unionByName(flag_spikes(prices)).unionByName(flag_promo_depth(current))


def flag_summary(flags: DataFrame) -> DataFrame:
    return flags.groupBy("flag_type").agg(F.count("*").alias("flags"), F.countDistinct("product_id").alias("products"), F.countDistinct("store_id").alias("stores"))


def store_freshness(current: DataFrame, stores: DataFrame, as_of, stale_days: int = 2) -> DataFrame:
    """Days since the newest check of every store, 9999 when there is none."""
    newest = current.groupBy(F.col("store_id").alias("id")).agg(F.max("fetched_at").alias("last_date"))
    days = F.coalesce(F.datediff(F.lit(as_of).cast("date"), F.col("last_date")), F.lit(9999)).cast("long")
    return stores.join(newest, "id", "left").select(F.col("id").alias("store_id"), "name", "network", F.col("last_date").cast("string").alias("last_date"), days.alias("days_stale")).withColumn("stale", F.col("days_stale") > stale_days)


def outlier_summary(current: DataFrame, z: float = 3.0) -> DataFrame:
    """product_id, outlier_count, avg_price of products with prices outside their bounds.

    Where three or more prices vary, bounds are ``z`` deviations from the mean if a price is outside them;
    else, with two or more prices, ten times the least price is the upper bound. All products count.
    """
    current = current.filter("cents > 0")
    g = current.groupBy("product_id").agg(F.count("*").alias("n"), F.sum("cents").cast("double").alias("s"), F.sum(F.col("cents") * F.col("cents")).cast("double").alias("q"), F.min("cents").alias("least"), F.max("cents").alias("most"))
    mean = F.col("s") / F.col("n")
    g = g.withColumns({"mean": mean, "far": F.lit(z) * F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean))})
    by_z = (F.col("n") >= 3) & (F.col("q") / F.col("n") - F.col("mean") * F.col("mean") > 10.0) & ((F.col("least") < F.col("mean") - F.col("far")) | (F.col("most") > F.col("mean") + F.col("far")))
    by_ratio = (F.col("n") >= 2) & (F.col("most") > F.col("least") * 10)
    bounds = g.select("product_id", "mean", F.when(by_z, F.col("mean") - F.col("far")).when(by_ratio, 0.0).alias("lo"), F.when(by_z, F.col("mean") + F.col("far")).when(by_ratio, F.col("least") * 10.0).alias("hi")).filter("lo is not null")
    outside = current.select("product_id", "cents").join(bounds, "product_id").filter((F.col("cents") < F.col("lo")) | (F.col("cents") > F.col("hi")))
    return outside.groupBy("product_id").agg(F.count("*").alias("outlier_count"), half_up(F.max("mean") / 100.0).alias("avg_price"))


def outlier_totals(current: DataFrame, z: float = 3.0) -> DataFrame:
    """total_records, flagged_count, flagged_pct over all positive prices."""
    all_ = current.filter("cents > 0").agg(F.count("*").alias("total_records"))
    flagged = outlier_summary(current, z).agg(F.coalesce(F.sum("outlier_count"), F.lit(0)).alias("flagged_count"))
    return all_.join(flagged, F.lit(True)).withColumn("flagged_pct", F.coalesce(half_up(F.try_divide(F.lit(100.0) * F.col("flagged_count"), F.col("total_records"))), F.lit(0.0)))


def price_velocity(prices: DataFrame, current: DataFrame) -> DataFrame:
    """Rows on the newest date against the snapshot: stuck, ok or bulk change."""
    days = prices.groupBy("price_date").agg(F.count("*").alias("n"))
    g = days.agg(F.max("price_date").alias("curr"), F.max_by("n", "price_date").alias("changed_count"), F.count("*").alias("k")).join(current.agg(F.count("*").alias("total_current")), F.lit(True))
    pct = half_up(F.try_divide(F.lit(100.0) * F.col("changed_count"), F.col("total_current")), 1)
    return g.select(F.col("curr").cast("string").alias("curr_date"), "changed_count", "total_current", pct.alias("changed_pct"), F.when(F.col("k") < 2, "insufficient_data").when(F.col("changed_count") == 0, "stuck").when(pct > 30, "bulk_change").otherwise("ok").alias("status"))


def audit_store_freshness(freshness: DataFrame, most_pct: float = 10) -> DataFrame:
    g = freshness.agg(F.count("*").alias("stores"), F.count_if("stale").alias("stale"))
    pct = half_up(F.try_divide(F.lit(100.0) * F.col("stale"), F.col("stores")), 1)
    return g.select(F.lit("store_freshness").alias("name"), F.coalesce(pct > most_pct, F.lit(False)).alias("red"), "stores", "stale", pct.alias("stale_pct"))


def audit_run_history(runs: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Abandoned runs of the last days without a completed run of the same script and start."""
    bad = runs.filter(F.col("status").isin("abandoned", "error") & (F.col("started") >= F.date_sub(F.lit(as_of).cast("date"), days)))
    done = runs.filter("status = 'completed'").select("script", "started").distinct()
    return bad.join(done, ["script", "started"], "left_anti").select("id", "script", F.col("started").cast("string").alias("started"), "status")


def audit_coverage_gaps(stores: DataFrame, current: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Networks with stores whose newest check is older than ``days``."""
    newest = current.groupBy(F.col("store_id").alias("id")).agg(F.max("fetched_at").alias("d"))
    g = stores.join(newest, "id", "left").groupBy("network").agg(F.count("*").alias("stores"), F.max("d").alias("newest"))
    return g.select("network", "stores", F.col("newest").cast("string").alias("newest"), (F.coalesce(F.col("newest") < F.date_sub(F.lit(as_of).cast("date"), days), F.lit(True))).alias("gap"))


def audit_flag_drift(daily: DataFrame, times: float = 3) -> DataFrame:
    """The newest day's count against the median of up to 30 days before."""
    ranked = daily.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("day"))))  # one row a day
    g = ranked.agg(F.max(F.when(F.col("rn") == 1, F.col("n"))).alias("today"), F.median(F.when(F.col("rn").between(2, 31), F.col("n"))).alias("usual"))
    return g.select(F.lit("flag_drift").alias("name"), F.coalesce(F.col("today") > F.col("usual") * times, F.lit(False)).alias("red"), "today", "usual")


def audit_overall(*parts: DataFrame) -> DataFrame:
    out = None
    for p in parts:
        one = p.select("name", "red")
        out = one if out is None else out.unionByName(one)
    return out.agg(F.max("red").alias("red")).select(F.when(F.col("red"), "RED").otherwise("GREEN").alias("overall"))


def run_health(runs: DataFrame, as_of, max_age_days: int = 2) -> DataFrame:
    """Newest completed run of every script: recent enough, with records."""
    g = runs.filter("status = 'completed'").groupBy("script").agg(F.max(F.struct("started", "id", "records")).alias("m"))
    age = F.datediff(F.lit(as_of).cast("date"), F.col("m.started")).cast("long")
    return g.select("script", F.col("m.id").alias("id"), age.alias("age_days"), F.col("m.records").alias("records")).withColumn("reason", F.when(F.col("age_days") > max_age_days, "old").when(F.col("records") <= 0, "empty").otherwise("ok"))


def run_islands(runs: DataFrame) -> DataFrame:
    """Consecutive runs of one script and status, merged with their number."""
    r = islands(runs.select("script", "status", "started", "id"), ["script"], ["started", "id"], "status", "island")
    return r.groupBy("script", "island", "status").agg(F.max_by("id", F.struct("started", "id")).alias("latest_id"), F.count("*").alias("count"))


def run_status_by_script(runs: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Runs per status in the last days, and the last success."""
    recent = F.col("started") >= F.date_sub(F.lit(as_of).cast("date"), days)
    n = lambda s: F.count_if(recent & (F.col("status") == s)).alias(s)
    g = runs.groupBy("script").agg(n("completed"), n("running"), n("abandoned"), F.max(F.when(F.col("status") == "completed", F.col("started"))).alias("ok"))
    return g.select("script", "completed", "running", "abandoned", F.col("ok").cast("string").alias("last_ok"), F.coalesce(F.datediff(F.lit(as_of).cast("date"), F.col("ok")) > days, F.lit(True)).alias("stale"))


def traffic_light(df: DataFrame, value: str, yellow: float, red: float) -> DataFrame:
    return df.withColumn("light", F.when(F.col(value) > red, "red").when(F.col(value) > yellow, "yellow").otherwise("green"))
