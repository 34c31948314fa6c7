"""Which stores and products are representative, stale, unchanged or uncovered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.functions.scalars import snake_key
from pricegrain.operators.index import population_band, product_popularity, top_per_category
from pricegrain.operators.ordered import numbered


def placed(stores: DataFrame) -> DataFrame:
    """Stores with coordinates and a known population around them."""
    return stores.filter("lat is not null and lon is not null and population is not null")


def ci_stores(stores: DataFrame, per_net: int = 10, band: tuple[float, float] = (0.35, 0.65), mid: int = 50) -> DataFrame:
    """The most populous stores of each network, and of those of middling population the first along the grid's rows, which turn at each end.

    ``stores`` has id, network, lat, lon and population, the people around the store; stores without one of the last three are left out, for
    the networks' lists also those without a network. Ties go by id.
    """
    known = placed(stores)
    top = known.filter("network is not null").withColumn("rn", F.row_number().over(Window.partitionBy("network").orderBy(F.desc("population"), "id"))).filter(F.col("rn") <= per_net).select("id")
    middle = population_band(known, *band).select("id").join(known.select("id", "population", snake_key(F.col("lat"), F.col("lon")).alias("k")), "id")
    return top.union(middle.orderBy("k.row", "k.col", "population", "id").limit(mid).select("id")).distinct()


def store_order_by_population(stores: DataFrame) -> DataFrame:
    """store_id, place: most people around first, unknown counts as none, ties by id."""
    ranked = stores.select(F.col("id").alias("store_id"), (-F.coalesce("population", F.lit(0))).alias("fewer"))
    return numbered(ranked, [], ["fewer", "store_id"], "place").select("store_id", "place")


def store_order_by_grid(stores: DataFrame) -> DataFrame:
    """store_id, place: along the rows of the grid, which turn at each end, most people first within a cell, ties by id; stores without coordinates come first."""
    k = snake_key(F.col("lat"), F.col("lon"))
    ranked = stores.select(F.col("id").alias("store_id"), k["row"].alias("row"), k["col"].alias("col"), (-F.coalesce("population", F.lit(0))).alias("fewer"))
    return numbered(ranked, [], ["row", "col", "fewer", "store_id"], "place").select("store_id", "place")


def ci_products(ps: DataFrame, products: DataFrame, overall: int = 50, per_cat: int = 20) -> DataFrame:
    """The most popular products and those of each category."""
    top = product_popularity(ps).orderBy("blended_rank", "product_id").limit(overall).select("product_id")
    return top.union(top_per_category(ps, products, per_cat).select("product_id")).distinct()


def default_basket(ps: DataFrame, n: int = 30) -> DataFrame:
    return ps.groupBy("product_id").agg(F.countDistinct("store_id").alias("stores")).orderBy(F.desc("stores"), "product_id").limit(n)


def store_order(stores: DataFrame, current: DataFrame, as_of) -> DataFrame:
    """Stores by age of their newest check, 9999 days when never."""
    newest = current.groupBy(F.col("store_id").alias("id")).agg(F.max("fetched_at").alias("d"))
    return stores.join(newest, "id", "left").select(F.col("id").alias("store_id"), F.coalesce(F.datediff(F.lit(as_of).cast("date"), F.col("d")), F.lit(9999)).cast("long").alias("age_days"))


def product_order(products: DataFrame, current: DataFrame) -> DataFrame:
    """Products with their newest check, never seen ones first."""
    newest = current.groupBy(F.col("product_id").alias("id")).agg(F.max("fetched_at").alias("d"))
    return products.select("id").join(newest, "id", "left").select(F.col("id").alias("product_id"), F.col("d").cast("string").alias("newest"), F.col("d").isNull().alias("never"))


def ghost_products(products: DataFrame, ps: DataFrame) -> DataFrame:
    return products.select(F.col("id").alias("product_id")).join(ps.select("product_id"), "product_id", "left_anti")


def products_for_stores(ps: DataFrame, stores: DataFrame, allowed: DataFrame) -> DataFrame:
    """Products that a set of stores has, of those allowed."""
    return ps.join(stores.select(F.col("id").alias("store_id")), "store_id", "left_semi").select("product_id").distinct().join(allowed, "product_id", "left_semi")


def canary_networks(changes: DataFrame, stores: DataFrame, least: int = 3) -> DataFrame:
    """Networks of which enough stores were observed and no price changed."""
    g = changes.join(stores.select(F.col("id").alias("store_id"), "network"), "store_id").groupBy("network").agg(F.countDistinct("store_id").alias("stores"), F.count_if(F.col("change_type") == "changed").alias("changed"))
    return g.select("network", "stores", "changed", ((F.col("stores") >= least) & (F.col("changed") == 0)).alias("unchanged"))


def weekly_products(changes: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Products with a price that has not moved for ``days``; ``changes`` has product_id and last_changed_at."""
    return changes.filter(F.col("last_changed_at") < F.date_sub(F.lit(as_of).cast("date"), days)).select("product_id").distinct()


def cluster_order(clusters: DataFrame, ages: DataFrame) -> DataFrame:
    """anchor_id, age_days: the age of each cluster's stalest member; ``ages`` has store_id and age_days."""
    return clusters.join(ages, "store_id").groupBy("anchor_id").agg(F.max("age_days").alias("age_days"))


def non_sentinels(stores: DataFrame, sentinels: DataFrame) -> DataFrame:
    return stores.join(sentinels.select("network").distinct(), "network", "left_semi").join(sentinels.select(F.col("store_id").alias("id")), "id", "left_anti").select(F.col("id").alias("store_id"), "network")


def skippable_clusters(clusters: DataFrame, skip: DataFrame) -> DataFrame:
    """Anchors whose every member is in the given set."""
    marked = clusters.join(skip.select("store_id", F.lit(True).alias("s")).distinct(), "store_id", "left")
    return marked.groupBy("anchor_id").agg(F.bool_and(F.coalesce("s", F.lit(False))).alias("skippable"), F.count("*").alias("members"))
