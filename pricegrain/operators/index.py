"""Price index, movers, promotions, comparisons and simple views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.functions.scalars import half_up, mean_cents, money
from pricegrain.operators.ordered import first_seen, numbered


def clean_prices(ps: DataFrame, flags: DataFrame) -> DataFrame:
    """Prices without those that a flag names."""
    return ps.join(flags.select("product_id", "store_id", "price_date").distinct(), ["product_id", "store_id", "price_date"], "left_anti")


def price_index(ps: DataFrame, by: tuple = (), min_networks: int = 3, flags: DataFrame | None = None) -> DataFrame:
    """Network average over the cheapest network average x 100, averaged per network over products in enough networks."""
    ps = clean_prices(ps, flags) if flags is not None else ps
    m = ps.groupBy(*by, "product_id", "network").agg(F.floor(F.sum("cents").cast("double") / F.count("cents") + 0.5).alias("m"))
    w = Window.partitionBy(*by, "product_id")
    r = m.withColumns({"low": F.min("m").over(w), "k": F.count("*").over(w)}).filter((F.col("k") >= min_networks) & (F.col("low") > 0))
    ratio = F.floor(F.col("m").cast("double") / F.col("low") * 1e6 + 0.5)  # integers, so that sums do not depend on order
    return r.withColumn("ratio", ratio).groupBy(*by, "network").agg(half_up(F.sum("ratio").cast("double") / F.count("*") / 1e4).alias("price_index"), F.count("*").alias("products"))


def category_trends(ps: DataFrame, products: DataFrame) -> DataFrame:
    """Average price and products per category and date."""
    return ps.join(products.select(F.col("id").alias("product_id"), "categ_id"), "product_id").groupBy("categ_id", "price_date").agg(mean_cents().alias("avg_price"), F.countDistinct("product_id").alias("products"))


def price_movers(ps: DataFrame, last, days: int = 7, min_networks: int = 2, top: int = 50) -> DataFrame:
    """Products whose average moved most from the first to the last day of the window, up and down."""
    p = ps.filter(F.col("price_date") >= F.date_sub(F.lit(last).cast("date"), days))
    w = Window.partitionBy("product_id")
    p = p.withColumns({"first_date": F.min("price_date").over(w), "last_date": F.max("price_date").over(w)}).filter("first_date < last_date")
    mean_on = lambda d: F.floor(F.sum(F.when(F.col("price_date") == F.col(d), F.col("cents"))).cast("double") / F.count(F.when(F.col("price_date") == F.col(d), 1)) + 0.5)
    g = p.groupBy("product_id", "first_date", "last_date").agg(mean_on("first_date").alias("a"), mean_on("last_date").alias("b"), F.countDistinct("network").alias("networks")).filter((F.col("networks") >= min_networks) & (F.col("a") > 0))
    g = g.select("product_id", money(F.col("a")).alias("price_start"), money(F.col("b")).alias("price_end"), half_up(F.lit(100.0) * (F.col("b") - F.col("a")) / F.col("a")).alias("change_pct"), "first_date", "last_date")
    up = g.filter("change_pct > 0").orderBy(F.desc("change_pct"), "product_id").limit(top).withColumn("direction", F.lit("up"))
    down = g.filter("change_pct < 0").orderBy("change_pct", "product_id").limit(top).withColumn("direction", F.lit("down"))
    return up.unionByName(down)


def promo_effectiveness(ps: DataFrame, min_products: int = 5, exclude: tuple = ()) -> DataFrame:
    """How many of a network's best promo prices are below every regular price of the market."""
    p = ps.filter(~F.col("network").isin(*exclude))
    regular = p.filter("promo is null").groupBy("product_id").agg(F.min("cents").alias("floor"))
    best = p.filter("promo is not null").groupBy("product_id", "network").agg(F.min("cents").alias("best"))
    j = best.join(regular, "product_id").filter("floor > 0")
    ratio = F.floor(F.lit(1e6) * F.col("best") / F.col("floor") + 0.5)
    g = j.groupBy("network").agg(F.count("*").alias("promo_products"), F.count_if(F.col("best") < F.col("floor")).alias("genuinely_cheap"), F.sum(ratio).alias("r")).filter(F.col("promo_products") >= min_products)
    return g.select("network", "promo_products", "genuinely_cheap", half_up(F.lit(100.0) * F.col("genuinely_cheap") / F.col("promo_products"), 1).alias("pct_genuinely_cheap"), half_up(F.col("r").cast("double") / F.col("promo_products") / 1e4, 1).alias("avg_promo_vs_market_min_pct"))


def store_price_index(cs: DataFrame, exclude: tuple = (), min_stores: int = 50, top_products: int = 200, min_priced: int = 20, limit: int = 120, cheapest: int = 100, priciest: int = 20) -> DataFrame:
    """Stores by average price over the most stocked products of the snapshot, the cheapest and the priciest of the first ``limit`` marked."""
    top = cs.groupBy("product_id").agg(F.countDistinct("store_id").alias("n")).filter(F.col("n") >= min_stores).orderBy(F.desc("n"), "product_id").limit(top_products)
    priced = cs.filter((F.col("cents") > 0) & (F.col("network").isNull() | ~F.col("network").isin(*exclude)))
    g = priced.join(F.broadcast(top.select("product_id")), "product_id", "left_semi").groupBy("store_id", "network").agg(mean_cents().alias("avg_price"), F.countDistinct("product_id").alias("products_priced")).filter(F.col("products_priced") >= min_priced)
    first = g.orderBy("avg_price", "store_id").limit(limit)  # a window over no more than these
    rank = F.row_number().over(Window.orderBy("avg_price", "store_id"))
    return first.withColumns({"rank": rank, "n": F.count("*").over(Window.partitionBy())}).select("store_id", "network", "avg_price", "products_priced", (F.col("rank") <= cheapest).alias("cheapest"), (F.col("rank") > F.col("n") - priciest).alias("priciest"))


def compare_products(ps: DataFrame, day, min_networks: int = 3) -> DataFrame:
    return ps.filter(F.col("price_date") == F.lit(day)).groupBy("product_id").agg(F.countDistinct("network").alias("networks")).filter(F.col("networks") >= min_networks)


def compare_latest(ps: DataFrame, day, min_networks: int = 3) -> DataFrame:
    p = ps.filter(F.col("price_date") == F.lit(day)).join(compare_products(ps, day, min_networks), "product_id", "left_semi")
    return p.groupBy("product_id", "network").agg(mean_cents().alias("avg_price"), money(F.min("cents")).alias("min_price"), money(F.max("cents")).alias("max_price"), F.countDistinct("store_id").alias("stores"))


def compare_history(ps: DataFrame, day, min_networks: int = 3) -> DataFrame:
    return ps.join(compare_products(ps, day, min_networks), "product_id", "left_semi").groupBy("product_id", "network", "price_date").agg(mean_cents().alias("avg_price"))


def coverage_by_network(ps: DataFrame, stores: DataFrame, day) -> DataFrame:
    """Stores with prices, products and all stores per network on one day, with a band of the share."""
    total = stores.groupBy("network").agg(F.count("*").alias("total_stores"))
    g = ps.filter(F.col("price_date") == F.lit(day)).groupBy("network").agg(F.countDistinct("store_id").alias("stores_with_prices"), F.countDistinct("product_id").alias("products_covered"))
    share = half_up(F.lit(100.0) * F.col("stores_with_prices") / F.col("total_stores"), 1)
    return g.join(total, "network").withColumn("share_pct", share).withColumn("band", F.when(F.col("share_pct") >= 50, "good").when(F.col("share_pct") >= 20, "partial").otherwise("low"))


def summary_counts(**tables: DataFrame) -> DataFrame:
    """One row of rows for each table."""
    out = None
    for name in sorted(tables):
        one = tables[name].agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def methodology_stats(ps: DataFrame, stores: DataFrame, products: DataFrame, day) -> DataFrame:
    a = ps.agg(F.countDistinct("price_date").alias("dates"), F.min("price_date").cast("string").alias("earliest"), F.max("price_date").cast("string").alias("latest"))
    b = stores.agg(F.count_if(F.col("network").isNull()).alias("unmapped_stores"), F.countDistinct("uat_id").alias("uats_with_stores"))
    c = products.join(ps.filter(F.col("price_date") == F.lit(day)).select(F.col("product_id").alias("id")).distinct(), "id", "left_anti").agg(F.count("*").alias("products_not_priced"))
    return a.join(b, F.lit(True)).join(c, F.lit(True))  # three one-row tables


def top_products(ps: DataFrame, stores: DataFrame, top: int = 50) -> DataFrame:
    """Most stocked products with prices and their share of all stores."""
    rows = first_seen(ps.select("product_id", "store_id", "network", "cents"), ["product_id"], "network", "new_network")
    g = rows.groupBy("product_id").agg(F.countDistinct("store_id").alias("store_count"), F.sum("new_network").alias("network_count"), mean_cents().alias("avg_price"), money(F.min("cents")).alias("min_price"), money(F.max("cents")).alias("max_price"))
    all_ = stores.agg(F.count("*").alias("all"))
    return g.join(all_, F.lit(True)).withColumn("coverage_pct", half_up(F.lit(100.0) * F.col("store_count") / F.col("all"), 1)).drop("all").orderBy(F.desc("store_count"), "product_id").limit(top)


def top_per_category(ps: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    """Products of rank 1 to n by stores in their category, ties kept."""
    g = ps.groupBy("product_id").agg(F.countDistinct("store_id").alias("store_count")).join(products.select(F.col("id").alias("product_id"), "categ_id"), "product_id")
    first = g.withColumn("salt", F.pmod("product_id", F.lit(16))).withColumn("rk", F.rank().over(Window.partitionBy("categ_id", "salt").orderBy(F.desc("store_count")))).filter(F.col("rk") <= n)
    return first.withColumn("rank", F.rank().over(Window.partitionBy("categ_id").orderBy(F.desc("store_count"))).cast("long")).filter(F.col("rank") <= n).select("categ_id", "product_id", "store_count", "rank")


def network_order(trends: DataFrame) -> DataFrame:
    """Networks by mean index over dates."""
    return trends.groupBy("network").agg(half_up(F.sum(F.floor(F.col("price_index") * 100.0 + 0.5)).cast("double") / F.count("*") / 100.0).alias("mean_index"))


def headline(index: DataFrame) -> DataFrame:
    """Cheapest and priciest network and the spread between them."""
    g = index.agg(F.min(F.struct("price_index", "network")).alias("a"), F.max(F.struct("price_index", "network")).alias("b"))
    return g.select(F.col("a.network").alias("cheapest"), F.col("b.network").alias("priciest"), half_up(F.try_divide(F.lit(100.0) * (F.col("b.price_index") - F.col("a.price_index")), F.col("a.price_index")), 1).alias("spread_pct"))


def rank_by_value(df: DataFrame, value: str, name: str) -> DataFrame:
    """RANK over a whole table without a window over all its rows: counts per value, then their running sum.

    The running sum is over distinct values only.
    """
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    ranks = counts.select(value, (F.sum("_n").over(Window.orderBy(F.desc(value))) - F.col("_n") + 1).alias(name))
    return df.join(ranks, value)


def product_popularity(ps: DataFrame) -> DataFrame:
    """Mean of the ranks by stores and by rows."""
    g = ps.groupBy("product_id").agg(F.countDistinct("store_id").alias("store_count"), F.count("*").alias("record_count"))
    g = rank_by_value(rank_by_value(g, "store_count", "r1"), "record_count", "r2")
    return g.select("product_id", "store_count", "record_count", ((F.col("r1") + F.col("r2")) / 2.0).alias("blended_rank"))


def private_label(ps: DataFrame) -> DataFrame:
    """Products of exactly one network."""
    return ps.groupBy("product_id").agg(F.countDistinct("network").alias("k"), F.min("network").alias("network"), F.countDistinct("store_id").alias("stores")).filter("k = 1").select("product_id", "network", "stores")


def stores_per_network(stores: DataFrame) -> DataFrame:
    return stores.groupBy(F.coalesce("network", F.lit("Unknown")).alias("network")).agg(F.count("*").alias("stores"))


def price_freshness(ps: DataFrame) -> DataFrame:
    return ps.groupBy("price_date").agg(F.count("*").alias("records"), F.countDistinct("store_id").alias("stores"), F.countDistinct("product_id").alias("products"))


def products_no_prices(products: DataFrame, ps: DataFrame) -> DataFrame:
    return products.join(ps.select(F.col("product_id").alias("id")).distinct(), "id", "left_anti").select("id", "name", "categ_id")


def store_coverage(ps: DataFrame, stores: DataFrame) -> DataFrame:
    a = ps.agg(F.countDistinct("store_id").alias("with_prices"))
    return a.join(stores.agg(F.count("*").alias("total")), F.lit(True))


def stores_fetched_on(ps: DataFrame, day) -> DataFrame:
    return ps.filter(F.col("fetched_at") == F.lit(day)).groupBy("store_id").agg(F.count("*").alias("records"))


def population_band(stores: DataFrame, low: float = 0.35, high: float = 0.65) -> DataFrame:
    """Stores of middling population, by rank, ties by id."""
    ranked = numbered(stores.select("id", "network", "population"), [], ["population", "id"], "rn")
    total = stores.agg(F.count(F.lit(1)).alias("n"))  # one row
    return ranked.join(F.broadcast(total), (F.col("rn") > F.col("n") * low) & (F.col("rn") <= F.col("n") * high)).select("id", "network", "population")


def count_by(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def popular_products(ps: DataFrame, stores: DataFrame, top: int = 100) -> DataFrame:
    """Products by stores, with networks, mean price and share of all stores."""
    return top_products(ps, stores, top).select("product_id", "store_count", "network_count", "avg_price", "coverage_pct")


def top_level_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Name of each product's parent category where it has one below the root, else of its own."""
    own = categories.select(F.col("id").alias("categ_id"), F.col("name").alias("own_name"), "parent_id")
    up = categories.filter("parent_id is not null").select(F.col("id").alias("parent_id"), F.col("name").alias("parent_name"))
    return products.join(own, "categ_id", "left").join(up, "parent_id", "left").select("id", F.coalesce("parent_name", "own_name").alias("top_category"))


def short_names(stores: DataFrame, lookup: DataFrame) -> DataFrame:
    """Stores with the short name and wholesale mark of their network, found by id or alias in any case."""
    keyed = stores.withColumn("key", F.lower("network"))
    return keyed.join(lookup.select("key", "short", "b2b"), "key", "left").select("id", F.coalesce("short", F.initcap("network"), F.lit("")).alias("short"), F.coalesce("b2b", F.lit(False)).alias("b2b"))
