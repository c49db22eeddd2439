"""Names of the queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Further forms of the queries: registered as well, but not among the ten.
VARIANTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
VARIANT_ORACLES: dict[str, str] = {}

# crc32 in SQL: the usual reversed polynomial over the characters of an ASCII text.
CRC_SQL = """xor(4294967295, list_reduce(list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda r, b:
    list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(r, b)), CAST(4294967295 AS BIGINT)))"""


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def variant(name: str, sql: str | None = None):
    def register(function):
        VARIANTS[name] = function
        if sql is not None:
            VARIANT_ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
