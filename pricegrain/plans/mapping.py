"""The price model as a projection of the driver's tables, for Spark and, as CTEs, for DuckDB.

products from part, stores from supplier, networks from region, prices from lineitem (two kinds of price:
``unit`` and ``list``), fuel from events, runs from orders, localities from customer. All prices are
integer cents, so sums do not depend on order.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricegrain.session import attach

#: The network that plays the wholesale role.
B2B = "MIDDLE EAST"
#: Rows of lineitem that a task gets at most on average, and most stores that are sent to all tasks.
ROWS_A_TASK, MOST_SENT = 250_000, 1_000_000
BASKETS = [("staples", k, 1 + k % 3) for k in range(6)] + [("treats", k, 2) for k in range(6, 10)]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = attach(spark), sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def types(self) -> DataFrame:
        """The distinct product types with their position, and how many there are; a handful of rows."""
        return self.raw("part").select("p_type").distinct().withColumns({"pos": F.row_number().over(Window.orderBy("p_type")), "types": F.count(F.lit(1)).over(Window.partitionBy())})

    @cached_property
    def categories(self) -> DataFrame:
        top = self.types.select((F.col("pos") + 1).cast("long").alias("id"), F.col("p_type").alias("name"), F.lit(1).cast("long").alias("parent_id"))
        return top.unionByName(self.spark.range(1).select(F.lit(1).cast("long").alias("id"), F.lit("ROOT").alias("name"), F.lit(None).cast("long").alias("parent_id")))

    @cached_property
    def products(self) -> DataFrame:
        brand_no = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
        part = self.raw("part").join(self.types, "p_type")
        pos = F.when(F.col("p_partkey") % 10 == 0, F.col("pos")).otherwise(brand_no % F.col("types") + 1)
        return part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), (pos + 1).cast("long").alias("categ_id"), F.col("p_brand").alias("p_brand"), F.col("p_size").cast("long").alias("size"))

    @cached_property
    def networks(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name"))

    @cached_property
    def stores(self) -> DataFrame:
        k = F.col("s_suppkey")
        s = self.raw("supplier").join(F.broadcast(self.raw("nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(self.raw("region")), F.col("n_regionkey") == F.col("r_regionkey"))
        return s.select(
            k.alias("id"), F.col("s_name").alias("name"), F.col("r_regionkey").cast("long").alias("network_id"), F.col("r_name").alias("network"),
            (k % 8).alias("uat_id"), (k % 3).alias("type_id"), F.floor(F.col("s_acctbal")).cast("long").alias("population"),
            F.when(F.col("s_acctbal") < -500, F.lit(False)).when(F.col("s_acctbal") >= 0, F.lit(True)).alias("is_active"),
            (F.lit(43.6) + (k % 20) * F.lit(0.23) + (F.floor(k / 20) % 7) * F.lit(0.012)).alias("lat"), (F.lit(20.3) + (((k % 20) * 7) % 20) * F.lit(0.46) + (F.floor(k / 20) % 5) * F.lit(0.015)).alias("lon"),
        )

    @cached_property
    def tasks(self) -> int:
        """Tasks that observations are dealt out to: as many as shuffles have, or more where these would get too many rows. Counts are in the files' footers."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-self.raw("lineitem").count() // ROWS_A_TASK))

    def of_stores(self, prices: DataFrame, columns: DataFrame) -> DataFrame:
        """Prices with columns of their store; the stores go to the prices, so that these stay dealt out by product, up to MOST_SENT of them."""
        if self.raw("supplier").count() <= MOST_SENT:
            return prices.join(F.broadcast(columns), "store_id")
        return prices.repartition(self.tasks, "store_id").join(columns, "store_id").repartition(self.tasks, "product_id")

    def offers(self, kind: str = "unit") -> DataFrame:
        """Every observation, also those of one product, store and date, dealt out by product: what groups them by product, or product and more, needs no other shuffle."""
        part = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", F.regexp_extract("p_brand", r"(\d+)", 1).alias("number"))
        li = self.raw("lineitem").repartition(self.tasks, "l_partkey").join(part, "l_partkey")
        price = F.col("l_extendedprice") / F.col("l_quantity") if kind == "unit" else F.col("p_retailprice") * (F.lit(1.0) - F.col("l_discount"))
        spelt = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("Brand#"), "number")).when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("BRAND #"), "number")).otherwise(F.concat(F.lit("Brand-"), "number"))
        unit = F.when(F.col("l_returnflag") == "A", "Kg").when(F.col("l_returnflag") == "N", "BUC").otherwise("Litru")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id"), F.floor(price * 100.0 + 0.5).alias("cents"),
            F.to_date(F.trunc(F.to_date("l_shipdate"), "year")).alias("price_date"), F.to_date("l_shipdate").alias("fetched_at"), F.when(F.col("l_discount") >= 0.09, "PROMO").alias("promo"), unit.alias("unit"), spelt.alias("brand"),
        )

    def prices(self, kind: str = "unit") -> DataFrame:
        """One row per product, store and year: the newest observation."""
        names = ["product_id", "store_id", "cents", "price_date", "fetched_at", "promo", "unit", "brand"]
        newest = Window.partitionBy("product_id", "store_id", "price_date").orderBy(F.desc("fetched_at"), F.desc("id"))
        return self.offers(kind).withColumn("place", F.row_number().over(newest)).filter("place = 1").select(*names)

    def current(self, kind: str = "unit") -> DataFrame:
        from pricegrain.operators.ingest import snapshot_latest

        return snapshot_latest(self.prices(kind))

    @cached_property
    def gas_prices(self) -> DataFrame:
        return self.raw("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("fuel"), F.col("user_id").alias("station_id"), F.floor(F.col("value") * 100.0 + 0.5).alias("cents"), F.col("ts").alias("at"), F.to_date("ts").alias("price_date"), (F.col("user_id") % 7).alias("network_id"))

    @cached_property
    def runs(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running").otherwise("abandoned")
        return self.raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("script"), F.to_date("o_orderdate").alias("started"), status.alias("status"), F.floor("o_totalprice").cast("long").alias("records"))

    @cached_property
    def localities(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(k.alias("id"), (F.lit(43.6) + (k % 20) * F.lit(0.23) + (F.floor(k / 20) % 7) * F.lit(0.012)).alias("lat"), (F.lit(20.3) + (((k % 20) * 7) % 20) * F.lit(0.46) + (F.floor(k / 20) % 5) * F.lit(0.015)).alias("lon"), F.floor("c_acctbal").cast("long").alias("population"))

    @cached_property
    def baskets(self) -> DataFrame:
        """basket_id, item_no, label, product_id, qty: an item stands for all products of one remainder."""
        items = self.spark.createDataFrame([(b, k, f"item {k}", q) for b, k, q in BASKETS], "basket_id string, item_no long, label string, qty long")
        return self.raw("part").select(F.col("p_partkey").alias("product_id"), (F.col("p_partkey") % 40).alias("item_no")).join(F.broadcast(items), "item_no")

    @cached_property
    def as_of(self):
        """The newest day on which anything was observed."""
        return self.raw("lineitem").agg(F.max(F.to_date("l_shipdate"))).first()[0]

    @cached_property
    def latest_date(self):
        return self.as_of and self.as_of.replace(month=1, day=1)


_ITEMS = ", ".join(f"('{b}', {k}::BIGINT, 'item {k}', {q}::BIGINT)" for b, k, q in BASKETS)
_PLACE = "(43.6::DOUBLE + ({k} % 20) * 0.23::DOUBLE + (({k} // 20) % 7) * 0.012::DOUBLE) AS lat, (20.3::DOUBLE + ((({k} % 20) * 7) % 20) * 0.46::DOUBLE + (({k} // 20) % 5) * 0.015::DOUBLE) AS lon"
#: The same model for DuckDB; ``{kind}`` is the kind of price.
CTES = f"""
types AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS pos FROM (SELECT DISTINCT p_type FROM part)),
categories AS (SELECT pos + 1 AS id, p_type AS name, 1::BIGINT AS parent_id FROM types UNION ALL SELECT 1, 'ROOT', NULL),
products AS (SELECT p_partkey AS id, p_name AS name, t.pos + 1 AS categ_id, p_brand, p_size::BIGINT AS size FROM part p JOIN types t
  ON CASE WHEN p_partkey % 10 = 0 THEN p.p_type = t.p_type ELSE t.pos = regexp_extract(p_brand, '(\\d+)', 1)::INT % (SELECT count(*) FROM types) + 1 END),
networks AS (SELECT r_regionkey::BIGINT AS id, r_name AS name FROM region),
stores AS (SELECT s_suppkey AS id, s_name AS name, r_regionkey::BIGINT AS network_id, r_name AS network, s_suppkey % 8 AS uat_id, s_suppkey % 3 AS type_id, floor(s_acctbal)::BIGINT AS population, CASE WHEN s_acctbal < -500 THEN false WHEN s_acctbal >= 0 THEN true END AS is_active, {_PLACE.format(k='s_suppkey')}
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
prices AS (SELECT l_partkey AS product_id, l_suppkey AS store_id, CASE WHEN '{{kind}}' = 'unit' THEN floor(l_extendedprice / l_quantity * 1e2 + 5e-1)::BIGINT ELSE floor(p_retailprice * (1e0 - l_discount) * 1e2 + 5e-1)::BIGINT END AS cents,
  date_trunc('year', l_shipdate)::DATE AS price_date, l_shipdate::DATE AS fetched_at, CASE WHEN l_discount >= 0.09::DOUBLE THEN 'PROMO' END AS promo,
  CASE l_returnflag WHEN 'A' THEN 'Kg' WHEN 'N' THEN 'BUC' ELSE 'Litru' END AS unit,
  CASE l_linenumber % 3 WHEN 0 THEN 'Brand#' WHEN 1 THEN 'BRAND #' ELSE 'Brand-' END || regexp_extract(p_brand, '(\\d+)', 1) AS brand
  FROM lineitem JOIN part ON l_partkey = p_partkey
  QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey, date_trunc('year', l_shipdate) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1),
current_p AS (SELECT * FROM prices QUALIFY row_number() OVER (PARTITION BY product_id, store_id ORDER BY price_date DESC, fetched_at DESC) = 1),
offers AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS product_id, l_suppkey AS store_id, floor(l_extendedprice / l_quantity * 1e2 + 5e-1)::BIGINT AS cents, date_trunc('year', l_shipdate)::DATE AS price_date, l_shipdate::DATE AS fetched_at FROM lineitem),
gas_prices AS (SELECT event_id AS id, event_type AS fuel, user_id AS station_id, floor(value * 1e2 + 5e-1)::BIGINT AS cents, ts AS at, ts::DATE AS price_date, user_id % 7 AS network_id FROM events),
runs AS (SELECT o_orderkey AS id, o_orderpriority AS script, o_orderdate::DATE AS started, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'abandoned' END AS status, floor(o_totalprice)::BIGINT AS records FROM orders),
localities AS (SELECT c_custkey AS id, {_PLACE.format(k='c_custkey')}, floor(c_acctbal)::BIGINT AS population FROM customer),
items(basket_id, item_no, label, qty) AS (VALUES {_ITEMS}),
baskets AS (SELECT p_partkey AS product_id, item_no, basket_id, label, qty FROM part JOIN items ON p_partkey % 40 = item_no),
ps AS (SELECT p.*, s.network, s.network_id, s.uat_id, s.type_id FROM prices p JOIN stores s ON s.id = store_id),
cs AS (SELECT p.*, s.network, s.network_id, s.uat_id, s.type_id FROM current_p p JOIN stores s ON s.id = store_id),
latest AS (SELECT max(price_date) AS d FROM prices),
history AS (SELECT * FROM (SELECT *, row_number() OVER w AS rn, lag(cents) OVER w AS pc, lag(promo) OVER w AS pp FROM prices WINDOW w AS (PARTITION BY product_id, store_id ORDER BY fetched_at, cents)) WHERE rn = 1 OR cents IS DISTINCT FROM pc OR promo IS DISTINCT FROM pp),
moved AS (SELECT product_id, store_id, max(fetched_at) AS last_changed_at FROM history GROUP BY ALL)
"""


def sql(body: str, kind: str = "unit", more: str = "") -> str:
    """A DuckDB query over the model; ``more`` adds CTEs."""
    return "WITH " + CTES.replace("{kind}", kind) + (", " + more if more else "") + " " + body
