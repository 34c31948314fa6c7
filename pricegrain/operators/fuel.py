"""Fuel prices by network, day and station."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.functions.scalars import half_up, mean_cents, money



def fuel_prices(gas: DataFrame) -> DataFrame:
    return gas.groupBy("network_id", "fuel").agg(mean_cents().alias("avg_price"), money(F.min("cents")).alias("min_price"), money(F.max("cents")).alias("max_price"), F.countDistinct("station_id").alias("stations"))


def fuel_trends(gas: DataFrame) -> DataFrame:
    return gas.groupBy("price_date", "network_id", "fuel").agg(mean_cents().alias("avg_price"))


def fuel_station_latest(gas: DataFrame) -> DataFrame:
    """Latest price of each fuel at a station as one list, with the newest date."""
    last = gas.groupBy("station_id", "fuel").agg(F.max_by("cents", F.struct("at", "id")).alias("cents"), F.max("price_date").alias("d"))
    listed = F.array_join(F.array_sort(F.collect_list(F.concat("fuel", F.lit("="), F.col("cents").cast("string")))), ";")
    return last.groupBy("station_id").agg(listed.alias("prices"), F.max("d").cast("string").alias("newest"))


def fuel_cheapest(gas: DataFrame) -> DataFrame:
    return fuel_prices(gas).groupBy("fuel").agg(F.min(F.struct("avg_price", "network_id")).alias("m")).select("fuel", F.col("m.network_id").alias("network_id"), F.col("m.avg_price").alias("avg_price"))


def fuel_spread(gas: DataFrame) -> DataFrame:
    g = fuel_prices(gas).groupBy("fuel").agg(F.count("*").alias("networks"), F.min("avg_price").alias("cheapest"), F.max("avg_price").alias("dearest"))
    return g.withColumn("spread_pct", half_up(F.try_divide(F.lit(100.0) * (F.col("dearest") - F.col("cheapest")), F.col("cheapest"))))


def fuel_ranking(gas: DataFrame) -> DataFrame:
    w = Window.partitionBy("fuel")
    p = fuel_prices(gas)  # one row per network and fuel
    return p.select("fuel", "network_id", "avg_price", F.rank().over(w.orderBy("avg_price")).cast("long").alias("rank"), half_up(F.max("avg_price").over(w) - F.min("avg_price").over(w)).alias("range"))
