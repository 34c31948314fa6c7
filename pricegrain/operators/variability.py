"""Price spread, uniformity and similarity within and across networks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.functions.scalars import half_up, haversine_km, mean_cents, money, sampling_tier, spread_bucket, spread_pct
from pricegrain.operators.ordered import first_seen, running_sum, upper_medians, value_counts
from pricegrain.storage import checkpoint


def stats(df: DataFrame, *keys: str, **more: Column) -> DataFrame:
    """min, mean, max price and spread in percent of the minimum, by key, with further aggregates."""
    g = df.groupBy(*keys).agg(F.min("cents").alias("lo"), F.max("cents").alias("hi"), mean_cents().alias("avg_price"), *[c.alias(n) for n, c in more.items()])
    return g.select(*keys, *more, money(F.col("lo")).alias("min_price"), "avg_price", money(F.col("hi")).alias("max_price"), spread_pct(F.col("lo"), F.col("hi"), F.col("lo")).alias("spread_pct"))


def price_variability(ps: DataFrame, day, floor_mult: int = 10, min_stores: int = 3, min_spread: float = 5) -> DataFrame:
    """Spread within a network on one day, without prices above ten times the minimum of product and network."""
    low = F.min("cents").over(Window.partitionBy("product_id", "network"))
    kept = ps.filter((F.col("price_date") == F.lit(day)) & (F.col("cents") > 0)).withColumn("low", low).filter(F.col("cents") <= F.col("low") * floor_mult)
    return stats(kept, "network", "product_id", stores=F.countDistinct("store_id")).filter((F.col("stores") >= min_stores) & (F.col("spread_pct") > min_spread))


def cross_network_spread(ps: DataFrame, min_rows: int = 2, min_networks: int = 2, exclude: tuple = ()) -> DataFrame:
    """Cheapest and dearest network average per product."""
    n = ps.filter(~F.col("network").isin(*exclude)).groupBy("product_id", "network").agg(mean_cents().alias("m"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)
    g = n.groupBy("product_id").agg(F.min("m").alias("min_net_price"), F.max("m").alias("max_net_price"), F.count(F.lit(1)).alias("networks")).filter(F.col("networks") >= min_networks)
    return g.select("*", half_up(F.col("max_net_price") - F.col("min_net_price")).alias("spread"), half_up(F.try_divide("max_net_price", "min_net_price")).alias("ratio"))


def intra_spread_all(ps: DataFrame, min_stores: int = 2) -> DataFrame:
    return stats(ps, "network", "product_id", stores=F.countDistinct("store_id")).filter(F.col("stores") >= min_stores)


def latest_per_store(ps: DataFrame, exclude: tuple = ()) -> DataFrame:
    """Latest price per product, network, unit and store."""
    return ps.filter(~F.col("network").isin(*exclude)).groupBy("product_id", "network", "unit", "store_id").agg(F.max_by("cents", F.struct("price_date", "fetched_at")).alias("cents"))


def intra_network_stats(latest: DataFrame, min_stores: int = 2) -> DataFrame:
    """Stores, minimum, mean, maximum, deviation and its share of the mean by product, network and unit."""
    n, s, q = F.count(F.lit(1)), F.sum("cents").cast("double"), F.sum(F.col("cents") * F.col("cents")).cast("double")
    g = latest.groupBy("product_id", "network", "unit").agg(n.alias("stores"), s.alias("s"), q.alias("q"), F.min("cents").alias("lo"), F.max("cents").alias("hi")).filter(F.col("stores") >= min_stores)
    mean = F.col("s") / F.col("stores")
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("stores") - mean * mean))
    return g.select("product_id", "network", "unit", "stores", money(F.col("lo")).alias("min_price"), money(F.col("hi")).alias("max_price"), (F.floor(mean + 0.5) / 100.0).alias("avg_price"), (F.floor(std + 0.5) / 100.0).alias("std_price"), half_up(F.try_divide(std * 100.0, mean), 1).alias("cv_pct"), half_up(F.try_divide(F.col("hi").cast("double"), F.col("lo"))).alias("ratio"))


def cross_network_medians(latest: DataFrame, exclude: tuple = ()) -> DataFrame:
    """Upper median per network, then the cheapest and priciest network of each product and unit."""
    m = latest.filter(~F.col("network").isin(*exclude))
    m = upper_medians(m, ["product_id", "unit", "network"], "cents", "m")
    low, high = F.min(F.struct("m", "network")), F.max(F.struct("m", "network"))
    g = m.groupBy("product_id", "unit").agg(F.count(F.lit(1)).alias("networks"), F.array_join(F.array_sort(F.collect_set("network")), ",").alias("all_networks"), low.alias("a"), high.alias("b")).filter("networks >= 2")
    return g.select("product_id", "unit", "networks", "all_networks", F.col("a.network").alias("cheapest_network"), money(F.col("a.m")).alias("cheapest_price"), F.col("b.network").alias("priciest_network"), money(F.col("b.m")).alias("priciest_price"), half_up(F.try_divide(F.col("b.m").cast("double"), F.col("a.m"))).alias("ratio"))


#: Networks that a table can have a column for.
MOST_NETWORKS = 500


def medians_by_network(latest: DataFrame, most: int = MOST_NETWORKS) -> DataFrame:
    """One column of medians for each network that the data have, in order of name; more than ``most`` are an error.

    Networks are looked up first, among medians that are kept for both passes. A column's name is price_ and the network's, with
    _ for what is neither letter nor digit, and a number where two would be the same. A null network has no column.
    """
    m = checkpoint(upper_medians(latest, ["product_id", "network"], "cents", "m"), "medians")
    networks = sorted(r[0] for r in m.select("network").distinct().filter("network is not null").limit(most + 1).collect())
    if len(networks) > most:
        raise ValueError(f"more than {most} networks")
    names: dict[str, str] = {}
    for n in networks:
        plain = name = "price_" + re.sub(r"[\W_]+", "_", n.lower())
        k = 1
        while name in names.values():
            k += 1
            name = f"{plain}_{k}"
        names[n] = name
    p = m.groupBy("product_id").pivot("network", networks).agg(F.first("m")) if networks else m.select("product_id").distinct()
    return p.select("product_id", *[money(F.col(f"`{n}`")).alias(name) for n, name in names.items()])


def variance(ps: DataFrame, keys: list[str], count: str, least: int) -> DataFrame:
    """Spread in percent of the mean by keys with at least ``least`` different values of ``count``."""
    g = ps.groupBy(*keys).agg(F.countDistinct(count).alias("n"), F.min("cents").alias("lo"), F.max("cents").alias("hi"), (F.sum("cents").cast("double") / F.count("cents")).alias("mean")).filter(F.col("n") >= least)
    return g.select(*keys, "n", money(F.col("lo")).alias("min_price"), money(F.col("hi")).alias("max_price"), (F.floor(F.col("mean") + 0.5) / 100.0).alias("avg_price"), spread_pct(F.col("lo"), F.col("hi"), F.col("mean")).alias("spread_pct"))


def variance_bands(v: DataFrame, cuts: tuple[float, float, float]) -> DataFrame:
    """Groups, median, extremes and counts in four bands of spread."""
    a, b, c = cuts
    x = F.col("spread_pct")
    return v.agg(F.count(F.lit(1)).alias("groups"), F.median("spread_pct").alias("median_pct"), F.min("spread_pct").alias("min_pct"), F.max("spread_pct").alias("max_pct"), F.count_if(x < a).alias("band0"), F.count_if((x >= a) & (x < b)).alias("band1"), F.count_if((x >= b) & (x < c)).alias("band2"), F.count_if(x >= c).alias("band3"))


def top_variance(v: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    return v.orderBy(F.desc("spread_pct"), *keys).limit(n)


def coverage_impact(ps: DataFrame, stores: DataFrame) -> DataFrame:
    """Stores with prices, distinct (UAT, network) among them, all stores, and what one per pair would save."""
    seen = ps.select("store_id", "uat_id", "network").distinct()
    a = seen.agg(F.countDistinct("store_id").alias("stores_with_prices"), F.countDistinct("uat_id", "network").alias("pairs"))
    return a.join(stores.agg(F.count(F.lit(1)).alias("total")), F.lit(True)).select("*", half_up(F.try_divide(F.lit(100.0) * (F.col("stores_with_prices") - F.col("pairs")), F.col("stores_with_prices")), 1).alias("reduction_pct"))


def price_uniformity(ps: DataFrame, min_stores: int = 3) -> DataFrame:
    """Distinct prices and spread per product, network and date."""
    keys = ["product_id", "network", "price_date"]
    rows = first_seen(ps.select(*keys, "store_id", "cents"), keys, "cents", "new_price")
    return stats(rows, *keys, store_count=F.countDistinct("store_id"), distinct_prices=F.sum("new_price")).filter(F.col("store_count") >= min_stores)


def uniformity_by_network(u: DataFrame) -> DataFrame:
    """Share of uniform groups, and the 50th and 95th percentile and maximum of spread, counted from above."""
    u = checkpoint(u.select("network", "spread_pct", "distinct_prices"), "uniformity")
    totals = u.groupBy("network").agg(F.count(F.lit(1)).alias("groups"), half_up(F.lit(100.0) * F.count_if(F.col("distinct_prices") == 1) / F.count(F.lit(1)), 1).alias("uniform_pct"), F.max("spread_pct").alias("max_pct"))
    counts = value_counts(u, ["network"], "spread_pct", "times").withColumn("least_first", -F.col("spread_pct"))
    ranked = running_sum(counts, ["network"], ["least_first"], "times", "upto").join(totals.select("network", "groups"), "network")
    at = lambda f: F.max(F.when((F.col("upto") > F.floor(F.col("groups") * f)) & (F.col("upto") - F.col("times") <= F.floor(F.col("groups") * f)), F.col("spread_pct")))
    picked = ranked.groupBy("network").agg(at(0.5).alias("p50"), at(0.05).alias("p95"))
    return totals.join(picked, "network", "left").select("network", "groups", "uniform_pct", "p50", "p95", "max_pct")


def top_variable(u: DataFrame, first: int = 20) -> DataFrame:
    """Product and network pairs in the order they first occur among the most variable groups."""
    top = u.orderBy(F.desc("spread_pct"), "product_id", "network", "price_date").limit(first)
    return top.groupBy("product_id", "network").agg(F.max("spread_pct").alias("spread_pct"))


def similarity_groups(ps: DataFrame, since, min_stores: int = 3) -> DataFrame:
    """Spread per network, store type, product and day."""
    return stats(ps.filter(F.col("price_date") >= F.lit(since)), "network", "type_id", "product_id", "price_date", stores=F.countDistinct("store_id")).filter(F.col("stores") >= min_stores)


def shares(*keys: str):
    def of(groups: DataFrame, *more: Column) -> DataFrame:
        b = groups.withColumn("b", spread_bucket(F.col("spread_pct")))
        return b.groupBy(*keys).agg(F.count(F.lit(1)).alias("groups"), *more, *[half_up(F.lit(100.0) * F.count_if(F.col("b") == k) / F.count(F.lit(1)), 1).alias(f"pct_b{k}") for k in range(4)])

    return of


def similarity_tiers(groups: DataFrame) -> DataFrame:
    """Shares of the four spread buckets and the sampling tier per network and store type."""
    return shares("network", "type_id")(groups, F.countDistinct("product_id").alias("products")).withColumn("tier", sampling_tier(F.col("pct_b0"), F.col("pct_b3")))


def similarity_trend(groups: DataFrame, days: int = 7) -> DataFrame:
    """Shares in windows that open on the first date and reopen at the first date ``days`` or more later."""
    groups = checkpoint(groups.select("network", "type_id", "price_date", "spread_pct"), "groups")  # read for the dates and for the shares
    dates = groups.groupBy("network", "type_id").agg(F.array_sort(F.collect_set("price_date")).alias("dates"))
    opens = F.aggregate("dates", F.array().cast("array<date>"), lambda acc, d: F.when((F.size(acc) == 0) | (F.datediff(d, F.element_at(F.when(F.size(acc) > 0, acc).otherwise(F.array(d)), -1)) >= days), F.concat(acc, F.array(d))).otherwise(acc))
    g = groups.join(dates.select("network", "type_id", opens.alias("opens")), ["network", "type_id"])
    g = g.withColumn("window_start", F.array_max(F.filter("opens", lambda o: o <= F.col("price_date"))))
    return shares("network", "type_id", "window_start")(g)


def sentinel_candidates(ps: DataFrame, stores: DataFrame, n: int = 20, since=None) -> DataFrame:
    """The stores with coordinates of widest assortment of each network, by positive prices, those checked from ``since`` on if it is given."""
    ps = ps.filter("cents > 0") if since is None else ps.filter((F.col("cents") > 0) & (F.col("fetched_at") >= F.lit(since)))
    placed = stores.filter("lat is not null and lon is not null").select(F.col("id").alias("store_id"), "lat", "lon")
    cover = ps.groupBy("network", "store_id").agg(F.countDistinct("product_id").alias("products_covered")).join(placed, "store_id")
    return cover.withColumn("rn", F.row_number().over(Window.partitionBy("network").orderBy(F.desc("products_covered"), "store_id"))).filter(F.col("rn") <= n)


def sentinel_stores(ps: DataFrame, stores: DataFrame, candidates: int = 20, n: int = 3, since=None) -> DataFrame:
    """``n`` stores of each network far from each other: the one of widest assortment first, then each time that which is farthest from those picked.

    Distances count in millimetres, equal ones go by assortment, then id. An array holds the at most ``candidates`` stores of a network.
    """
    top = sentinel_candidates(ps, stores, candidates, since)
    km = lambda a, b: F.round(haversine_km(a["lat"], a["lon"], b["lat"], b["lon"]), 6)
    at = top.groupBy("network").agg(F.sort_array(F.collect_list(F.struct("rn", "store_id", "products_covered", "lat", "lon"))).alias("all"))
    at = at.withColumn("chosen", F.slice("all", 1, 1))
    for _ in range(n - 1):
        rest = F.filter("all", lambda c: ~F.exists("chosen", lambda s: s["rn"] == c["rn"]))
        far = F.array_max(F.transform(rest, lambda c: F.struct(F.array_min(F.transform("chosen", lambda s: km(c, s))).alias("km"), (-c["rn"]).alias("first"), c.alias("store"))))
        at = at.withColumn("far", far).withColumn("chosen", F.when(F.col("far").isNull(), F.col("chosen")).otherwise(F.concat("chosen", F.array(F.col("far")["store"]))))
    wide = F.array_max(F.flatten(F.transform("chosen", lambda a: F.transform("chosen", lambda b: km(a, b)))))
    each = at.withColumn("spread_km", wide).select("network", "spread_km", F.posexplode("chosen").alias("k", "c"))
    return each.select("network", F.col("c.store_id").alias("store_id"), (F.col("k") + 1).cast("long").alias("pick_no"), F.col("c.products_covered").alias("products_covered"), F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon"), "spread_km")


def sentinel_networks(tiers: DataFrame) -> DataFrame:
    """Networks and whether every store type of theirs is in tier A."""
    return tiers.groupBy("network").agg(F.bool_and(F.col("tier") == "A").alias("all_a"), F.count(F.lit(1)).alias("types"))


def modal_price_agreement(cs: DataFrame) -> DataFrame:
    """Modal price per product and network, and whether the networks of a product agree on it."""
    counted = cs.groupBy("product_id", "network", "cents").agg(F.count(F.lit(1)).alias("n"))
    modes = counted.groupBy("product_id", "network").agg(F.max_by("cents", F.struct("n", -F.col("cents"))).alias("mode"), F.sum("n").alias("stores"))
    g = modes.groupBy("product_id").agg(F.count(F.lit(1)).alias("networks"), F.min("mode").alias("lo"), F.max("mode").alias("hi"), F.min("stores").alias("least")).filter("networks >= 2")
    within = lambda t: F.col("hi") <= F.col("lo") * F.lit(1.0 + t)
    same = F.col("lo") == F.col("hi")
    return g.select("product_id", "networks", money(F.col("lo")).alias("mode_min"), money(F.col("hi")).alias("mode_max"), same.alias("identical"), within(0.01).alias("within_1"), within(0.05).alias("within_5"), (same & (F.col("networks") >= 3) & (F.col("least") >= 3)).alias("robust"))


def spread_distribution(cs: DataFrame) -> DataFrame:
    """Products by band of cross-network spread, with and without promo rows."""
    both = cs.select("product_id", "network", "cents", F.explode(F.when(F.col("promo").isNull(), F.array(F.lit("all"), F.lit("regular"))).otherwise(F.array(F.lit("all")))).alias("rows"))
    n = both.groupBy("rows", "product_id", "network").agg(F.floor(F.sum("cents").cast("double") / F.count("cents") + 0.5).alias("m"))
    g = n.groupBy("rows", "product_id").agg(F.min("m").alias("lo"), F.max("m").alias("hi"), F.count(F.lit(1)).alias("k")).filter("k >= 2")
    pct = spread_pct(F.col("lo"), F.col("hi"), F.col("lo"))
    band = F.when(pct < 1, "0-1").when(pct < 5, "1-5").when(pct < 10, "5-10").when(pct < 25, "10-25").when(pct < 50, "25-50").otherwise("50+")
    return g.groupBy("rows", band.alias("band")).agg(F.count(F.lit(1)).alias("products"))


def single_network_products(cs: DataFrame) -> DataFrame:
    """How many products each network alone carries."""
    g = cs.groupBy("product_id").agg(F.min("network").alias("network"), F.max("network").alias("other")).filter("network = other")
    return g.groupBy("network").agg(F.count("*").alias("products"))


def network_coverage_hist(cs: DataFrame) -> DataFrame:
    return cs.groupBy("product_id").agg(F.countDistinct("network").alias("networks")).groupBy("networks").agg(F.count(F.lit(1)).alias("products"))


def snapshot_age(current: DataFrame, as_of) -> DataFrame:
    """Snapshot rows by age in days, cumulated."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col("fetched_at"))
    return current.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(age <= d).alias(f"within_{d}") for d in (1, 7, 14, 30)], F.count_if(age > 30).alias("older"))
