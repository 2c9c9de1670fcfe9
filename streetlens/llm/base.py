"""Registry of the queries of this subpackage and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WORDS_SQL = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its key, with its SQL if it has one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc32_sql(text: str) -> str:
    """SQL of the unsigned CRC-32 of an ASCII text, bit by bit with the usual polynomial."""
    bits = "list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bits}), 4294967295)"
