"""Network minima, baskets, a price-change series, anomalies and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.functions.scalars import half_up, money



def network_min(ps: DataFrame, day=None, keys: tuple = (), exclude: tuple = ()) -> DataFrame:
    """Lowest positive price per product and network, and per further keys."""
    p = ps.filter((F.col("cents") > 0) & F.col("network").isNotNull() & ~F.col("network").isin(*exclude))
    p = p.filter(F.col("price_date") == F.lit(day)) if day is not None else p
    return p.groupBy(*keys, "product_id", "network").agg(F.min("cents").alias("cents"))


def outlier_filter(minima: DataFrame, keys: tuple = (), low: float = 0.30, high: float = 3.0, min_before: int = 0, min_after: int = 0) -> DataFrame:
    """Minima between 0.30 and 3 times the product's median of minima, in enough networks before and after."""
    by = [*keys, "product_id"]
    mid = minima.groupBy(*by).agg(F.median("cents").alias("mid"), F.count("*").alias("k")).filter(F.col("k") >= min_before)
    kept = minima.join(mid, by).filter((F.col("mid") <= 0) | F.col("cents").between(F.col("mid") * low, F.col("mid") * high))
    if min_after:
        kept = kept.withColumn("left", F.count("*").over(Window.partitionBy(*by))).filter(F.col("left") >= min_after)
    return kept.select(*minima.columns)


def anomalies(kept: DataFrame, min_ratio: float = 1.5, min_networks: int = 2, keep: int | None = 300) -> DataFrame:
    """Products with the widest gap between networks: dearest over cheapest, and what that saves."""
    low, high = F.min(F.struct("cents", "network")), F.max(F.struct("cents", "network"))
    pairs = F.array_sort(F.collect_list(F.struct("cents", "network")))  # one entry per network
    g = kept.groupBy("product_id").agg(F.count("*").alias("networks"), low.alias("a"), high.alias("b"), F.array_join(F.transform(pairs, lambda p: F.concat(p["network"], F.lit("="), p["cents"].cast("string"))), ";").alias("by_network")).filter(F.col("networks") >= min_networks)
    ratio = half_up(F.col("b.cents").cast("double") / F.col("a.cents"))
    g = g.select("product_id", "networks", F.col("a.network").alias("cheapest_network"), money(F.col("a.cents")).alias("cheapest_price"), F.col("b.network").alias("priciest_network"), money(F.col("b.cents")).alias("priciest_price"), ratio.alias("ratio"), money(F.col("b.cents") - F.col("a.cents")).alias("save_lei"), F.floor(F.lit(100.0) * (F.col("b.cents") - F.col("a.cents")) / F.col("b.cents") + 0.5).cast("long").alias("save_pct"), "by_network").filter(F.col("ratio") >= min_ratio)
    return g.orderBy(F.desc("ratio"), "product_id").limit(keep) if keep else g


def modal_unit_brand(ps: DataFrame, day) -> DataFrame:
    """Most common unit and brand of each product on one day."""
    p = ps.filter(F.col("price_date") == F.lit(day))
    mode = lambda c: p.groupBy("product_id", c).agg(F.count("*").alias("n")).groupBy("product_id").agg(F.max_by(c, F.struct("n", c)).alias(c))
    return mode("unit").join(mode("brand"), "product_id")


def filter_anomalies(found: DataFrame, min_ratio: float = 0, network: str | None = None) -> DataFrame:
    f = found.filter(F.col("ratio") >= min_ratio)
    return f.filter(F.col("cheapest_network") == network) if network else f


def anomaly_summary(found: DataFrame, top: int = 10) -> DataFrame:
    a = found.agg(F.count("*").alias("n"), F.max("ratio").alias("top_ratio"))
    s = found.orderBy(F.desc("ratio"), "product_id").limit(top).agg((F.sum(F.floor(F.col("save_lei") * 100.0 + 0.5)) / 100.0).alias("top_saving"))
    return a.join(s, F.lit(True))


def score_items(baskets: DataFrame, net_min: DataFrame, keys: tuple = ()) -> DataFrame:
    """Cheapest substitute for every item of a basket in each network (and place)."""
    j = baskets.join(net_min, "product_id")
    return j.groupBy("basket_id", *keys, "network", "item_no", "label", "qty").agg(F.min(F.struct("cents", "product_id")).alias("m")).select("basket_id", *keys, "network", "item_no", "label", "qty", F.col("m.product_id").alias("product_id"), F.col("m.cents").alias("cents"))


def score_basket(items: DataFrame, baskets: DataFrame, keys: tuple = (), coverage: float = 0.5) -> DataFrame:
    """Weekly and monthly cost, items found, and whether enough are found to compare."""
    total = baskets.groupBy("basket_id").agg(F.countDistinct("item_no").alias("items_total"))
    g = items.groupBy("basket_id", *keys, "network").agg(F.sum(F.col("qty") * F.col("cents")).alias("week"), F.count("*").alias("items_found")).join(F.broadcast(total), "basket_id")
    return g.select("basket_id", *keys, "network", money(F.col("week")).alias("cost_week"), (F.floor(F.col("week") * 52.0 / 12.0 + 0.5) / 100.0).alias("cost_month"), "items_found", "items_total", (F.col("items_found") >= F.col("items_total") * coverage).alias("comparable"))


def basket_index(scored: DataFrame, per_uat: DataFrame) -> DataFrame:
    """Cheapest and priciest comparable month, the cheapest network, and places covered."""
    g = scored.filter("comparable").groupBy("basket_id").agg(F.min(F.struct("cost_month", "network")).alias("a"), F.max("cost_month").alias("priciest_month"))
    return g.join(per_uat.groupBy("basket_id").agg(F.countDistinct("uat_id").alias("uats_covered")), "basket_id").select("basket_id", F.col("a.cost_month").alias("cheapest_month"), "priciest_month", F.col("a.network").alias("cheapest_network"), "uats_covered")


def basket_rank(scored: DataFrame) -> DataFrame:
    """Rank by month and the difference to the cheapest, by month and year."""
    w = Window.partitionBy("basket_id")
    s = scored.filter("comparable")
    delta = half_up(F.col("cost_month") - F.min("cost_month").over(w))
    return s.select("basket_id", "network", "cost_month", F.rank().over(w.orderBy("cost_month")).cast("long").alias("rank"), delta.alias("delta_month")).withColumn("delta_year", half_up(F.col("delta_month") * 12.0))


def cpi_series(baskets: DataFrame, ps: DataFrame, coverage: float = 0.5) -> DataFrame:
    """Cost of each basket, bought wherever cheapest, on every date."""
    items = cpi_items(baskets, ps)
    total = baskets.groupBy("basket_id").agg(F.countDistinct("item_no").alias("items_total"))
    g = items.groupBy("basket_id", "price_date").agg(F.sum(F.col("qty") * F.col("cents")).alias("week"), F.count("*").alias("items_found")).join(F.broadcast(total), "basket_id")
    g = g.select("basket_id", "price_date", money(F.col("week")).alias("cost_week"), (F.floor(F.col("week") * 52.0 / 12.0 + 0.5) / 100.0).alias("cost_month"), "items_found", (F.col("items_found") >= F.col("items_total") * coverage).alias("comparable"))
    base = F.first(F.when(F.col("comparable"), F.col("cost_month")), ignorenulls=True).over(Window.partitionBy("basket_id").orderBy("price_date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return g.withColumn("index", half_up(F.try_divide(F.lit(100.0) * F.col("cost_month"), base), 1))


def cpi_items(baskets: DataFrame, ps: DataFrame) -> DataFrame:
    low = outlier_filter(network_min(ps, keys=("price_date",)), ("price_date",)).groupBy("price_date", "product_id").agg(F.min("cents").alias("cents"))
    return baskets.join(low, "product_id").groupBy("basket_id", "item_no", "label", "qty", "price_date").agg(F.min("cents").alias("cents"))


def cpi_item_changes(baskets: DataFrame, ps: DataFrame) -> DataFrame:
    """Price of each item on its first and last date, with the direction of the change."""
    g = cpi_items(baskets, ps).groupBy("basket_id", "label").agg(F.min_by("cents", "price_date").alias("a"), F.max_by("cents", "price_date").alias("b"))
    pct = half_up(F.try_divide(F.lit(100.0) * (F.col("b") - F.col("a")), F.col("a")))
    return g.select("basket_id", "label", money(F.col("a")).alias("price_first"), money(F.col("b")).alias("price_last"), pct.alias("change_pct")).withColumn("direction", F.when(F.col("change_pct") > 0.5, "up").when(F.col("change_pct") < -0.5, "down").otherwise("flat"))


def category_spread(kept: DataFrame, products: DataFrame, max_per_cat: int = 200) -> DataFrame:
    """Widest spreads of each category."""
    a = anomalies(kept, min_ratio=0, keep=None).join(products.select(F.col("id").alias("product_id"), "categ_id"), "product_id")
    salted = a.withColumn("salt", F.pmod("product_id", F.lit(16)))
    order = (F.desc("ratio"), F.asc("product_id"))
    top = lambda df, *k: df.withColumn("rn", F.row_number().over(Window.partitionBy(*k).orderBy(*order))).filter(F.col("rn") <= max_per_cat)
    return top(top(salted, "categ_id", "salt"), "categ_id").select("categ_id", "product_id", "networks", "cheapest_network", "ratio", "save_lei", F.col("rn").cast("long").alias("rn"))


def category_leaderboard(kept: DataFrame, products: DataFrame) -> DataFrame:
    """How often each network is the cheapest in a category."""
    a = anomalies(kept, min_ratio=0, keep=None).join(products.select(F.col("id").alias("product_id"), "categ_id"), "product_id")
    return a.groupBy("categ_id", "cheapest_network").agg(F.count("*").alias("cheapest_count"))


def category_index(kept: DataFrame, products: DataFrame) -> DataFrame:
    a = anomalies(kept, min_ratio=0, keep=None)
    p = products.select(F.col("id").alias("product_id"), "categ_id").join(a, "product_id", "left")
    return p.groupBy("categ_id").agg(F.count("*").alias("products_total"), F.count("ratio").alias("products_with_spread"), F.max("ratio").alias("top_ratio"), (F.coalesce(F.sum(F.floor(F.col("save_lei") * 100.0 + 0.5)), F.lit(0)) / 100.0).alias("total_save_lei"))


def category_sizes(categories: DataFrame, products: DataFrame) -> DataFrame:
    return categories.join(products.select(F.col("categ_id").alias("id"), F.col("id").alias("p")), "id", "left").groupBy("id", "name").agg(F.count("p").alias("products"))


def stories(kept: DataFrame, products: DataFrame) -> DataFrame:
    """What stands out: the widest gap, the network most often cheapest, the category of largest saving, gaps of three and more."""
    a = anomalies(kept, min_ratio=0, keep=None)
    top = a.agg(F.max_by("product_id", F.struct("ratio", -F.col("product_id"))).cast("string").alias("value")).select(F.lit("top_gap").alias("story"), "value")
    net = a.groupBy("cheapest_network").agg(F.count("*").alias("n")).agg(F.max_by("cheapest_network", F.struct("n", "cheapest_network")).alias("value")).select(F.lit("cheapest_most_often").alias("story"), "value")
    cat = category_index(kept, products).agg(F.max_by("categ_id", F.struct("total_save_lei", "categ_id")).cast("string").alias("value")).select(F.lit("largest_saving").alias("story"), "value")
    three = a.agg(F.count_if(F.col("ratio") >= 3).cast("string").alias("value")).select(F.lit("ratio_3_and_more").alias("story"), "value")
    return top.unionByName(net).unionByName(cat).unionByName(three)


def filter_category_items(items: DataFrame, names: DataFrame, text: str = "", min_networks: int = 2, top: int = 50) -> DataFrame:
    """Items of the category explorer whose name holds a text, in enough networks, widest ratio first."""
    named = items.join(names.select(F.col("id").alias("product_id"), "name"), "product_id").filter(F.col("networks") >= min_networks)
    return named.filter(F.lower("name").contains(text.lower())).orderBy(F.desc("ratio"), "product_id").limit(top).select("categ_id", "product_id", "name", "networks", "ratio")
