"""All queries of the price model, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricegrain.plans.mapping import Tables
from pricegrain.plans.queries import PLANS, SQL


def _bound(plan: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plan(Tables(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _bound(plan) for name, plan in PLANS.items()}
ORACLE_SQL: dict[str, str] = dict(SQL)
