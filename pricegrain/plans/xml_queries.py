"""The model's newest prices as XML documents, written and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrain.plans.mapping import Tables
from pricegrain.sources import readers
from pricegrain.storage import scratch


def element(tag: str, value: Column) -> Column:
    """An element, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"<{tag}>"), value.cast("string"), F.lit(f"</{tag}>")), F.lit(""))


def records(t: Tables) -> DataFrame:
    """value: a record for each store and product, with references that XML does not allow, and broken ones for stores of unknown state."""
    s = t.stores
    above = F.col("type_id") > 0  # others are told by their product alone
    head = F.concat(
        F.lit("<RetailStore>"), element("Id", F.col("id")), element("Name", F.concat("name", F.lit("&#x1C;"))), element("Network", F.when(above, F.col("network"))),
        element("Addr", F.concat(F.lit("<Location>"), element("Lat", F.col("lat")), element("Lon", F.col("lon")), F.lit("</Location>"), element("Uat", F.col("uat_id")))),
        F.lit("<Products><Product>"),
    )
    # what a store says is written out once for each store; the stores go to the prices, so that these are not shuffled again
    told = s.select(F.col("id").alias("store_id"), head.alias("head"), element("Network", F.when(~above, F.col("network"))).alias("below"), F.when(F.col("is_active").isNull(), F.lit("")).otherwise(F.lit("</Product>")).alias("ends"))
    rows = t.of_stores(t.current(), told)
    product = F.concat(element("Id", F.col("product_id")), F.col("below"), element("Price", F.col("cents") / 100.0), element("PriceDate", F.date_format("price_date", "dd.MM.yyyy HH:mm")), element("Promo", F.col("promo")), element("Brand", F.col("brand")), element("Unit", F.col("unit")))
    return rows.select(F.concat("head", product, "ends", F.lit("</Products></RetailStore>")).alias("value"))


def documents(t: Tables) -> str:
    """A folder of documents of ``records``: a compressed file for each task, which one task reads."""
    path = scratch(t.spark, "xml")
    records(t).write.option("compression", "gzip").text(path)
    return path


def read(t: Tables) -> DataFrame:
    return readers.read_xml(t.spark, documents(t), "RetailStore", readers.STORE_XML)


def xml_prices(t: Tables) -> DataFrame:
    return readers.parse_stores(read(t))[1].select("product_id", "store_id", "cents", F.substring("price_date", 1, 10).alias("price_date"), "promo", "brand", "unit")


def xml_stores(t: Tables) -> DataFrame:
    return readers.parse_stores(read(t))[0].select("id", "name", "uat_id", "network_id").distinct()


def xml_rejects(t: Tables) -> DataFrame:
    at = F.regexp_extract("record", "<Id>([0-9]+)</Id>", 1).cast("long")
    rejects = readers.read_xml_rejects(t.spark, documents(t), "RetailStore", readers.STORE_XML)
    return rejects.groupBy(at.alias("store_id"), "reason").agg(F.count(F.lit(1)).alias("records"))


def categories_by_source(t: Tables) -> DataFrame:
    """All categories, and those from the letter P on as a second source spells them."""
    second = t.categories.filter("name >= 'P'").withColumn("name", F.lower("name"))
    return readers.union_sources({"network": t.categories, "oug": second})


def products_by_category(t: Tables) -> DataFrame:
    """Products as each category lists them, some without naming it."""
    listed = t.products.select("id", "name", F.when(F.col("size") > 25, F.col("categ_id")).alias("categ_id"), F.col("categ_id").alias("asked_categ_id"))
    return readers.with_asked_category(listed)


PRICES_SQL = "SELECT product_id, store_id, cents, price_date::VARCHAR AS price_date, promo, brand, unit FROM current_p JOIN stores ON stores.id = store_id WHERE is_active IS NOT NULL AND cents > 0"
STORES_SQL = "SELECT DISTINCT stores.id, name, uat_id, network AS network_id FROM current_p JOIN stores ON stores.id = store_id WHERE is_active IS NOT NULL"
REJECTS_SQL = "SELECT store_id, 'malformed' AS reason, count(*) AS records FROM current_p JOIN stores ON stores.id = store_id WHERE is_active IS NULL GROUP BY store_id"
CATEGORIES_SQL = "SELECT id, CASE WHEN name >= 'P' THEN lower(name) ELSE name END AS name, parent_id, CASE WHEN name >= 'P' THEN 'oug' ELSE 'network' END AS source FROM categories"
PRODUCTS_SQL = "SELECT id, name, categ_id FROM products"
