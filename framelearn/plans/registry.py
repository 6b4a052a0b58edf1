"""Queries by name, each with the SQL that gives the same rows, where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rnd(c: Column, places: int = 6) -> Column:
    """Round so that the order of summing does not show; the same arithmetic as ``sql_rnd``."""
    k = float(10**places)
    return F.rint(c * k) / k + 0.0


def sql_rnd(expr: str, places: int = 6) -> str:
    k = f"1e{places}"
    return f"(round_even(({expr})::DOUBLE*{k}::DOUBLE,0)/{k}::DOUBLE + 0.0::DOUBLE)"
