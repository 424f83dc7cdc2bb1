"""Derives a two-sheet retail ledger from star-schema order tables.

The text is plain SQL that Spark and other ANSI engines read alike, so an oracle can start
from exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ADAPTER_TABLES = ["lineitem", "orders", "part", "nation"]

# Total order of the rows inside a sheet; ties are rows equal in every ledger column.
SOURCE_ORDER = [
    "o_orderdate", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    "copy_no",
]

# Columns that follow from the joined row alone; the customer stands for two columns that nothing else needs.
_DERIVED = """    CASE WHEN d.is_c THEN 'C' WHEN d.is_a THEN 'A' ELSE '' END
        || CAST(d.o_orderkey + CASE WHEN d.is_i THEN 70000000 ELSE 50000000 END AS STRING)
        AS invoice,
    CASE
        WHEN d.is_a THEN 'B'
        WHEN d.l_partkey % 40 = 0 AND d.l_partkey % 3 = 0 THEN ' post '
        WHEN d.l_partkey % 40 = 0 AND d.l_partkey % 3 = 1 THEN 'M'
        WHEN d.l_partkey % 40 = 0 THEN 'gift_0001_20'
        ELSE ' ' || CAST(10000 + d.l_partkey AS STRING) || 'a'
    END AS stock_code,
    CASE
        WHEN d.is_i AND d.l_partkey % 4 <> 0 THEN NULL
        WHEN d.is_a THEN 'Adjust bad debt'
        WHEN d.l_linenumber = 3 THEN d.p_name || ' alt'
        ELSE d.p_name
    END AS description,
    CAST(d.l_quantity AS BIGINT) * CASE WHEN d.is_c OR d.is_i THEN -1 ELSE 1 END AS quantity,
    CASE
        WHEN d.l_linenumber > 5 THEN d.o_orderdate + INTERVAL '1' MINUTE
        ELSE d.o_orderdate
    END AS invoice_date,
    CASE
        WHEN d.is_i THEN CAST(0 AS DOUBLE)
        WHEN d.is_a AND d.l_suppkey % 2 = 0 THEN -d.l_extendedprice
        WHEN d.l_discount = 0 AND d.l_tax = 0 THEN CAST(0 AS DOUBLE)
        ELSE d.l_extendedprice
    END AS price,
"""

_UNSPECIFIED = "o_orderpriority = '4-NOT SPECIFIED'"

_CUSTOMER = """    CASE
        WHEN d.is_a OR {unspecified} THEN NULL
        WHEN d.o_custkey % 100 = 7 AND NOT d.is_c THEN NULL
        ELSE d.o_custkey
    END AS customer_id,
"""

_LINE = """        l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
        l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
        o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority, p.p_name,
"""

# Columns {l} and {o} may come from the tables or from their joined rows.
_FLAGS = """        {l}.l_returnflag = 'R' AS is_c,
        {l}.l_returnflag = 'A' AND {l}.l_linestatus = 'O' AND {l}.l_linenumber = 7 AS is_a,
        {unspecified} AND {l}.l_returnflag = 'N'
            AND {l}.l_linestatus = 'F' AS is_i,
        ({o}.o_custkey + CASE WHEN {o}.o_orderkey % 10 = 0 THEN 1 ELSE 0 END) % 25 AS nation_key,
        CASE
            WHEN {o}.o_orderdate >= TIMESTAMP '1998-06-01 00:00:00'
                AND {o}.o_orderdate < TIMESTAMP '1998-07-01 00:00:00' THEN 'both'
            WHEN {o}.o_orderdate < TIMESTAMP '1998-07-01 00:00:00'
                AND {o}.o_orderkey % 50 = 0 AND {l}.l_linenumber = 1 THEN 'first twice'
            WHEN {o}.o_orderdate < TIMESTAMP '1998-07-01 00:00:00' THEN 'first'
            WHEN {o}.o_orderkey % 50 = 0 AND {l}.l_linenumber = 1 THEN 'second twice'
            ELSE 'second'
        END AS placement
"""

_TABLES = """    FROM {lineitem} AS l
    JOIN {orders} AS o ON o.o_orderkey = l.l_orderkey
    JOIN {part} AS p ON p.p_partkey = l.l_partkey
"""

_PLACES = """JOIN {nation} AS n ON n.n_nationkey = d.nation_key
JOIN (
    VALUES ('both', 'S1', 0), ('both', 'S2', 0), ('first', 'S1', 0), ('second', 'S2', 0),
        ('first twice', 'S1', 0), ('first twice', 'S1', 1),
        ('second twice', 'S2', 0), ('second twice', 'S2', 1)
) AS s(placement, sheet, copy_no) ON s.placement = d.placement
"""

ADAPTER_SQL = f"""
SELECT
{_DERIVED}{_CUSTOMER.format(unspecified=f"d.{_UNSPECIFIED}")}    n.n_name AS country,
    s.sheet AS source_sheet,
    d.o_orderdate, d.o_orderkey, d.l_linenumber, d.l_partkey, d.l_suppkey, d.l_quantity,
    d.l_extendedprice, d.l_discount, d.l_tax, d.l_returnflag, d.l_linestatus, d.l_shipdate,
    s.copy_no
FROM (
    SELECT
{_LINE}{_FLAGS.format(l="l", o="o", unspecified=f"o.{_UNSPECIFIED}")}{_TABLES}) AS d
{_PLACES}"""

SHEETS = ["S1", "S2"]


# The places of _PLACES by placement, for rows that get them one by one.
_COPIES = {
    "both": [("S1", 0), ("S2", 0)], "first": [("S1", 0)], "second": [("S2", 0)], "first twice": [("S1", 0), ("S1", 1)],
    "second twice": [("S2", 0), ("S2", 1)],
}


def placed_lines(spark: SparkSession, folder: str, tasks: int) -> DataFrame:
    """The joined rows with their source-order columns, and ``task``, which of ``tasks`` ranges of orders holds the row: they lie in the
    partition of that number, still unordered there.

    Orders are ranged before the join, which then runs once: a range shuffle of the lines would run it twice, the first time to
    sample it. All lines of an order lie in one range. Only what cannot be derived is shuffled; copies, sheets, countries and flags are made
    in the row's last task.
    """
    tables = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ADAPTER_TABLES}
    orders = tables["orders"].select("o_orderkey", "o_custkey", "o_orderdate", F.expr(_UNSPECIFIED).alias("unspecified"))
    ranged = orders.repartitionByRange(tasks, "o_orderdate", "o_orderkey").withColumn("task", F.spark_partition_id())
    columns = ", ".join(c for c in SOURCE_ORDER if c != "copy_no")
    joined = spark.sql(f"SELECT {columns}, o_custkey, unspecified, p_name, task {_TABLES}", **{**tables, "orders": ranged})
    flags = _FLAGS.format(l="m", o="m", unspecified="m.unspecified")
    flagged = spark.sql(f"SELECT m.*, {flags} FROM {{moved}} AS m", moved=joined.repartitionById(tasks, "task"))
    listed = " ".join(
        f"WHEN '{name}' THEN array({', '.join(f"struct('{sheet}' AS sheet, {copy} AS copy_no)" for sheet, copy in places)})" for name, places in _COPIES.items()
    )
    copied = flagged.select("*", F.inline(F.expr(f"CASE placement {listed} END")))
    text = f"""SELECT {_CUSTOMER.format(unspecified="d.unspecified")} {columns}, d.copy_no, d.task, d.is_c, d.is_a, d.is_i, d.sheet AS source_sheet,
        n.n_name AS country, d.p_name FROM {{copied}} AS d JOIN {{nation}} AS n ON n.n_nationkey = d.nation_key"""
    # A row for each nation: hinted, because a shuffle for this join would move the rows out of their tasks.
    return spark.sql(text, copied=copied, nation=F.broadcast(tables["nation"]))


def ledger_columns(placed: DataFrame) -> DataFrame:
    """The ledger's columns, row by row and in the order of ``placed``."""
    return placed.sparkSession.sql(f"SELECT {_DERIVED} d.customer_id, d.country, d.source_sheet FROM {{placed}} AS d", placed=placed)


def line_count(spark: SparkSession, folder: str) -> int:
    """Rows of the line table, from its file footers: about those of the ledger, which has each line once or twice."""
    return spark.read.parquet(f"{folder}/lineitem.parquet").count()
