"""Readers of price documents and configuration, and writers of results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrain.functions.scalars import clean_xml, iso_date, wkt_centre
from pricegrain.storage import checkpoint

STORE_XML = "Id long, Name string, Network string, Addr struct<Addrstring:string, Zipcode:string, Location:struct<Lat:double, Lon:double>, Uat:long>, LogoUrl string, Type struct<Id:long, Name:string>, Products struct<Product:array<struct<Id:long, Network:string, Price:string, PriceDate:string, Promo:string, Brand:string, Unit:string, CategId:string, CategName:string>>>"
STATION_XML = "Id string, Name string, Network string, Addr string, Lat double, Lon double, UpdateDate string, Prices struct<Price:array<struct<Id:long, Value:string>>>"


def xml_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """record, whole: the text of each element ``tag``, cleaned of references to control characters; whole is false for one whose end is missing.

    Files are cut where an element ends, so that a large file is read by many tasks and no text is held but a record's. Elements of
    this name do not nest and are not written as one empty tag.
    """
    cut = spark.read.option("lineSep", f"</{tag}>").text(path)
    first = F.instr("value", f"<{tag}")
    again = F.position(F.lit(tag), F.col("value"), first + 2)
    # no expression is searched for where the name stands in one opening at most, which is the rule
    parts = F.when((first == 0) | (again == 0), F.array(F.substr("value", first))).otherwise(F.reverse(F.split("value", rf"(?=<{tag}[\s>])")))
    # what stands before the first opening is no record; all but the last that follow, here the first, have lost their end
    opened = cut.select(F.posexplode(parts).alias("k", "piece")).filter(F.col("piece").rlike(rf"^<{tag}[\s>]"))
    whole = F.col("k") == 0
    return opened.select(clean_xml(F.when(whole, F.concat("piece", F.lit(f"</{tag}>"))).otherwise(F.col("piece"))).alias("record"), whole.alias("whole"))


def parsed_xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """record, whole, row, reason: each record of one tag parsed, with what is wrong with it; the text only where something is. Nothing is written."""
    struct = T._parse_datatype_string(schema)
    corrupt = "corrupt"
    while corrupt.lower() in {n.lower() for n in struct.names}:
        corrupt = "_" + corrupt
    with_mark = T.StructType([*struct.fields, T.StructField(corrupt, T.StringType())])
    records = xml_records(spark, path, tag)
    row = F.from_xml(F.when(F.col("whole"), F.col("record")), with_mark, {"rowTag": tag, "columnNameOfCorruptRecord": corrupt, "mode": "PERMISSIVE"})
    # made by a generator, so that conditions on the row are no conditions on its text, which would parse it once more for each use
    parsed = records.select("record", "whole", F.explode(F.array(row)).alias("row"))
    bad = F.col(f"row.{corrupt}").isNotNull()
    empty = F.lit(True)
    for n in struct.names:
        empty = empty & F.col("row").getField(n).isNull()
    reason = F.when(~F.col("whole"), "cut").when(bad & empty, "malformed").when(bad, "value")
    return parsed.withColumn("reason", reason).withColumn("record", F.when(F.col("reason").isNotNull(), F.col("record")))


def rows_of(parsed: DataFrame, schema: str) -> DataFrame:
    """The rows of parsed records."""
    names = T._parse_datatype_string(schema).names
    return parsed.filter("whole and (reason is null or reason = 'value')").select(*[F.col("row").getField(n).alias(n) for n in names])


def rejects_of(parsed: DataFrame) -> DataFrame:
    """record, reason of those parsed records that something is wrong with."""
    return parsed.filter("reason is not null").select("record", "reason")


def read_xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Rows of one tag, with an explicit schema: inference would read a single child as a struct. Broken records are left out; see ``read_xml_with_rejects``.

    Nothing is written, so each use of the rows parses the files.
    """
    return rows_of(parsed_xml(spark, path, tag, schema), schema)


def read_xml_rejects(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """The rejects of ``read_xml_with_rejects`` alone; nothing is written."""
    return rejects_of(parsed_xml(spark, path, tag, schema))


def read_xml_with_rejects(spark: SparkSession, path: str, tag: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of one tag, and the records that cannot be read: record, reason.

    A record is ``cut`` when its end is missing and ``malformed`` when no parser takes it; neither gives a row. One with a value
    that does not fit its type gives a row with a null there, and is told as ``value``.
    """
    told = checkpoint(parsed_xml(spark, path, tag, schema), "records")  # parsed once for both; of the texts only those of rejects are written
    return rows_of(told, schema), rejects_of(told)


def parse_stores(xml: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stores, prices, and stores whose own network differs from their products'.

    A price needs a product id, a date and a value above zero; a store stays without any.
    """
    p = xml.withColumn("items", F.coalesce("Products.Product", F.array()))
    below = F.get(F.filter("items", lambda i: i["Network"].isNotNull()), F.lit(0))["Network"]
    p = p.withColumns({"below": below, "network_id": F.coalesce("Network", below)})
    stores = p.select(F.col("Id").alias("id"), F.col("Name").alias("name"), F.col("Addr.Addrstring").alias("addr"), F.col("Addr.Location.Lat").alias("lat"), F.col("Addr.Location.Lon").alias("lon"), F.col("Addr.Uat").alias("uat_id"), "network_id", F.col("Addr.Zipcode").alias("zipcode"), F.col("LogoUrl").alias("logo_url"), F.col("Type.Id").alias("type_id"), F.col("Type.Name").alias("type_name"))
    e = p.select(F.col("Id").alias("store_id"), F.explode("items").alias("i")).withColumn("value", F.col("i.Price").try_cast("double"))
    prices = e.filter(F.col("i.Id").isNotNull() & (F.coalesce("i.PriceDate", F.lit("")) != "") & (F.col("value") > 0)).select(F.col("i.Id").alias("product_id"), "store_id", F.floor(F.col("value") * 100.0 + 0.5).alias("cents"), iso_date(F.col("i.PriceDate")).alias("price_date"), F.nullif(F.trim("i.Promo"), F.lit("")).alias("promo"), F.col("i.Brand").alias("brand"), F.col("i.Unit").alias("unit"), F.col("i.CategId").alias("retail_categ_id"), F.col("i.CategName").alias("retail_categ_name"))
    conflicts = p.filter(F.col("Network") != F.col("below")).select(F.col("Id").alias("store_id"), F.col("Network").alias("own"), "below")
    return stores, prices, conflicts


def parse_gas(xml: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stations and their prices, dated by the station's update."""
    stations = xml.select(F.col("Id").alias("id"), F.col("Name").alias("name"), F.col("Addr").alias("addr"), F.col("Lat").alias("lat"), F.col("Lon").alias("lon"), F.col("Network").alias("network_id"), iso_date(F.col("UpdateDate")).alias("update_date"))
    e = xml.select(F.col("Id").alias("station_id"), iso_date(F.col("UpdateDate")).alias("price_date"), F.explode("Prices.Price").alias("p")).withColumn("value", F.col("p.Value").try_cast("double"))
    return stations, e.filter((F.col("value") > 0) & F.col("p.Id").isNotNull()).select(F.col("p.Id").alias("product_id"), "station_id", F.floor(F.col("value") * 100.0 + 0.5).alias("cents"), "price_date")


def parse_dims(xml: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Networks, categories, products or fuels: columns under their model names."""
    return xml.select(*[F.col(a).alias(b) for a, b in columns.items()])


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows of several catalogues of one kind, each with the name of its source; of one id that of the source that comes last stays, and of its rows that of greatest values."""
    parts = [df.select("*", F.lit(name).alias("source"), F.lit(k).alias("source_no")) for k, (name, df) in enumerate(sources.items())]
    rows = reduce(DataFrame.unionByName, parts)
    order = [c for c in sorted(rows.columns) if c not in ("id", "source", "source_no")]
    last = rows.groupBy("id").agg(F.max(F.struct("source_no", *order, "source")).alias("row"))
    return last.select(*[F.col(c) if c == "id" else F.col("row").getField(c).alias(c) for c in rows.columns if c != "source_no"])


def with_asked_category(products: DataFrame, asked: str = "asked_categ_id") -> DataFrame:
    """Products in the category they name, or in the one they were asked for by where they name none; of one id the least category asked for that holds it."""
    known = products.withColumn("categ_id", F.coalesce("categ_id", asked))
    rest = [c for c in sorted(products.columns) if c not in ("id", asked)]
    first = known.groupBy("id").agg(F.min(F.struct(asked, *rest)).alias("row"))
    return first.select(*[F.col(c) if c == "id" else F.col("row").getField(c).alias(c) for c in products.columns if c != asked])


def parse_uats(xml: DataFrame) -> DataFrame:
    """Administrative units with the centre of their polygon's box."""
    c = wkt_centre(F.col("Wkt"))
    return xml.select(F.col("Id").alias("id"), F.col("Name").alias("name"), F.col("Wkt").alias("wkt"), c["lat"].alias("center_lat"), c["lon"].alias("center_lon"))


def localities(csv: DataFrame, min_population: int = 2500) -> DataFrame:
    """Localities with usable coordinates and enough people."""
    d = csv.select("name", F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon"), F.col("population").try_cast("long").alias("population"))
    return d.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col("population") >= min_population))


def baskets(json: DataFrame) -> DataFrame:
    """basket_id, item_no, label, product_id, qty from nested configuration."""
    b = json.select(F.explode("baskets").alias("b")).select(F.col("b.id").alias("basket_id"), F.posexplode("b.items").alias("item_no", "i"))
    return b.select("basket_id", F.col("item_no").cast("long").alias("item_no"), F.col("i.label").alias("label"), F.explode("i.product_ids").alias("product_id"), F.col("i.qty").alias("qty"))


def network_lookup(config: DataFrame) -> DataFrame:
    """key, network_id, short, b2b for every id and alias; ``config`` has id, short, aliases, b2b."""
    return config.select(F.explode(F.array_distinct(F.concat(F.array(F.lower("id")), F.transform("aliases", F.lower)))).alias("key"), F.col("id").alias("network_id"), "short", F.coalesce("b2b", F.lit(False)).alias("b2b"))


def allow_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids, one a line; blank lines and # lines are skipped."""
    return spark.read.text(path).select(F.trim("value").try_cast("long").alias("id")).filter("id is not null").distinct()


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite").option("header", True)
    (w.partitionBy(by) if by else w).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_ids(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def properties_json(df: DataFrame, key: str) -> DataFrame:
    """GeoJSON properties: the key and one JSON object of all other columns."""
    return df.select(key, F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("properties"))


def export_all(results: dict[str, DataFrame], path: str) -> None:
    """One CSV folder for each named result."""
    for name, df in results.items():
        write_csv(df, f"{path}/{name}")


def write_product_csvs(latest: DataFrame, history: DataFrame, path: str) -> None:
    """Latest and history rows of every product, in one folder a product."""
    write_csv(latest, f"{path}/latest", by="product_id")
    write_csv(history, f"{path}/history", by="product_id")
