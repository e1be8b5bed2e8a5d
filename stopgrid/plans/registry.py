"""Named queries over the given tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def six_digits(x: Column) -> Column:
    """Rounded to six digits with plain double arithmetic.

    A little is added, which moves exact ties off the edge where two engines' last
    bits could decide.
    """
    return F.rint(x * 1e6 + 0.001) / F.lit(1e6)


def plain(df: DataFrame) -> DataFrame:
    """Comparable output: dates as ISO text, doubles to six digits."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DoubleType):
            c = six_digits(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)
