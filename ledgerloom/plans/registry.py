"""The catalog of runnable queries and their oracle texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_released
from .oracle import compose
from .warehouse import Warehouse, warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# What each oracle text was composed from, for families that register a variant of it.
STATEMENTS: dict[str, tuple[str, dict[str, str] | None]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types every SQL engine prints alike: doubles for money, text for dates, long counts."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, run: Callable[[Warehouse], DataFrame], sql: str | None = None, extra=None) -> None:
    if name in QUERIES:
        raise ValueError(f"query registered twice: {name}")
    QUERIES[name] = lambda spark, folder: portable(_made(run, spark, folder))
    if sql is not None:
        ORACLES[name] = compose(sql, extra)
        STATEMENTS[name] = (sql, extra)


def _made(run: Callable[[Warehouse], DataFrame], spark: SparkSession, folder: str) -> DataFrame:
    """The result of a query, not run yet; what its steps shuffled is off the disks."""
    with shuffles_released(spark):
        return run(warehouse(spark, folder))


# --- small helpers that spell oracle select lists ------------------------------------------


def real(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def whole(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


def day(*names: str) -> str:
    return ", ".join(f"strftime({n}, '%Y-%m-%d') AS {n}" for n in names)


def moment(*names: str) -> str:
    return ", ".join(f"strftime({n}, '%Y-%m-%d %H:%M:%S') AS {n}" for n in names)
