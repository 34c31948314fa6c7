"""Brands, n-grams and products in odd categories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.functions.scalars import BETWEEN_WORDS, brand_key, half_up, is_noise_word, without_marks
from pricegrain.storage import checkpoint


def canonical(counted: DataFrame, keys: list[str], raw: str) -> DataFrame:
    """Rows in all, the most frequent spelling (the last in order on ties), all spellings with counts, and categories."""
    listed = F.array_join(F.array_sort(F.collect_list(F.concat(raw, F.lit(" ("), F.col("n").cast("string"), F.lit(")")))), "; ")
    cats = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cats")))), ", ")
    return counted.groupBy(*keys).agg(F.max_by(raw, F.struct("n", raw)).alias("canonical"), F.sum("n").alias("total"), F.count("*").alias("variant_count"), listed.alias("variants"), cats.alias("categories"))


def brands(prices: DataFrame, tops: DataFrame, top: int = 150) -> DataFrame:
    """Brands by key, with their usual spelling, variants and top-level categories; ``tops`` has id and top_category."""
    p = prices.filter(F.col("brand").isNotNull()).groupBy("brand", "product_id").agg(F.count("*").alias("m")).join(tops, F.col("id") == F.col("product_id"), "left")
    p = p.groupBy("brand").agg(F.sum("m").alias("n"), F.collect_set("top_category").alias("cats")).withColumn("key", brand_key(F.col("brand"))).filter("key <> ''")
    return canonical(p, ["key"], "brand").orderBy(F.desc("total"), "key").limit(top)


def words_of(text: Column) -> Column:
    """Words of a text that say something, in order; null for null. A text is cut once, its words are judged one at a time."""
    return F.filter(F.split(text, f"[{BETWEEN_WORDS}]+"), lambda w: ~is_noise_word(w))


def grams_of(words: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring words, joined by spaces; none where there are fewer words."""
    runs = F.greatest(F.size(words) - n + 1, F.lit(0))
    return reduce(lambda grams, k: F.zip_with(grams, F.slice(words, k + 1, runs), lambda a, b: F.concat(a, F.lit(" "), b)), range(1, n), F.slice(words, 1, runs))


def ngrams(names: DataFrame, n: int, top: int = 150, text: str = "name", category: str | None = None) -> DataFrame:
    """Most frequent words, or pairs of neighbouring words that say something, with their usual spelling and categories.

    Neighbours are told after the noise is gone. Spellings are counted before they are shuffled, and only those of the most
    frequent tokens are compared.
    """
    w = names.select(words_of(F.col(text)).alias("words"), *([F.col(category).alias("cat")] if category else []))  # no filter on words: it would judge them once more
    raw = w.select(F.explode(grams_of(F.col("words"), n)).alias("raw"), *(["cat"] if category else []))
    counts = checkpoint(raw.groupBy("raw").agg(F.count("*").alias("n"), *([F.collect_set("cat").alias("cats")] if category else [])), "grams")  # both passes below read it
    counted = counts.withColumns({"token": F.lower(without_marks(F.col("raw"))), **({} if category else {"cats": F.array()})})
    first = counted.groupBy("token").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "token").limit(top).select("token")
    found = canonical(counted.join(F.broadcast(first), "token"), ["token"], "raw")
    return found.select("token", "canonical", F.col("total").alias("count"), *(["categories"] if category else [])).orderBy(F.desc("count"), "token").limit(top)


def category_anomalies(products: DataFrame, brand: str = "p_brand", threshold: float = 0.8, min_products: int = 5) -> DataFrame:
    """Products outside the category in which at least 80 % of their brand's products are."""
    by = products.groupBy(brand, "categ_id").agg(F.count("*").alias("n"))
    w = Window.partitionBy(brand)
    top = by.withColumns({"all": F.sum("n").over(w), "rn": F.row_number().over(w.orderBy(F.desc("n"), "categ_id"))}).filter((F.col("rn") == 1) & (F.col("all") >= min_products) & (F.col("n") >= F.col("all") * threshold))
    top = top.select(brand, F.col("categ_id").alias("dominant_categ"), half_up(F.lit(100.0) * F.col("n") / F.col("all"), 1).alias("dominant_share_pct"))
    return products.join(top, brand).filter("categ_id <> dominant_categ").select(F.col("id").alias("product_id"), F.col(brand).alias("brand"), "categ_id", "dominant_categ", "dominant_share_pct")
