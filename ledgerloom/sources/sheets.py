"""Reading ledger sheets with a stable source position, and the raw snapshot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LEDGER_COLUMNS, TEXT_LEDGER_SCHEMA
from ..session import STAGED_CODEC

# Bits of the source position: sheet | file | row inside the file. A position that does not fit is an error.
SHEET_BITS = 12
FILE_BITS = 22
ROW_BITS = 29
SHEET_SHIFT = FILE_BITS + ROW_BITS
ROWS_PER_TASK = 1 << 20  # of a raw snapshot

def require_ledger_columns(ledger: DataFrame) -> DataFrame:
    """Fail on a missing source column; a ledger without sheet gets ``unknown``."""
    missing = [c for c in LEDGER_COLUMNS if c not in ledger.columns]
    if missing:
        raise ValueError(f"ledger lacks source columns: {missing}")
    if "source_sheet" not in ledger.columns:
        ledger = ledger.withColumn("source_sheet", F.lit("unknown"))
    return ledger


def sheet_position(sheet: int, file: Column, row: Column) -> Column:
    """The sortable source position of a row."""
    if sheet >= 1 << SHEET_BITS:
        raise ValueError(f"more than {1 << SHEET_BITS} sheets")
    fits = (file < 1 << FILE_BITS) & (row < 1 << ROW_BITS)
    packed = F.lit(sheet << SHEET_SHIFT) + F.shiftleft(file.cast("bigint"), ROW_BITS) + row
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("source position out of range")).cast("bigint"))


def _part_number(path: Column) -> Column:
    return F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).try_cast("bigint")


def _file_order(sheet: DataFrame) -> DataFrame:
    """(_path, _file): the files of a sheet in order of their part numbers, then names; one row per file."""
    paths = sheet.select(F.col("_metadata.file_path").alias("_path")).distinct()
    order = Window.orderBy(F.coalesce(_part_number(F.col("_path")), F.lit(0)), "_path")
    return paths.select("_path", (F.row_number().over(order) - 1).cast("bigint").alias("_file"))


def read_sheet(spark: SparkSession, path: str, name: str, position: int, *, snapshot: bool = False) -> DataFrame:
    """One Parquet sheet plus ``source_sheet`` and the sortable ``source_order``.

    The files of a ``snapshot`` carry their order in their names; those of other folders are listed by a query.
    """
    sheet = spark.read.parquet(path)
    located = sheet.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.row_index").alias("_row"),
    )
    if snapshot:
        # Spark names them part-<number>-...; a regular expression is run for other names only.
        number = F.substring_index(F.substring_index("_name", "-", 2), "-", -1)
        plain = F.when(F.col("_name").startswith("part-"), number.try_cast("bigint"))
        located = located.withColumn("_file", F.coalesce(plain, _part_number(F.col("_path"))))
    else:
        located = located.join(_file_order(sheet), "_path", "left")
    file = F.coalesce("_file", F.raise_error(F.lit("row comes from an unlisted file")).cast("bigint"))
    return located.select(
        *[F.col(f"`{c}`") for c in sheet.columns],
        F.lit(name).alias("source_sheet"),
        sheet_position(position, file, F.col("_row")).alias("source_order"),
    )


def read_sheets(spark: SparkSession, sheets: dict[str, str], *, snapshot: bool = False) -> DataFrame:
    """N Parquet sheets as one ledger; dictionary order is sheet order."""
    frames = [read_sheet(spark, path, name, i, snapshot=snapshot) for i, (name, path) in enumerate(sheets.items())]
    ledger = frames[0]
    for frame in frames[1:]:
        ledger = ledger.unionByName(frame, allowMissingColumns=True)
    return require_ledger_columns(ledger)


def read_text_sheets(spark: SparkSession, sheets: dict[str, str], header: bool = True, multi_line: bool = False) -> DataFrame:
    """N CSV sheets as all-text columns, the position columns a snapshot sorts by, and ``_broken``.

    A row's position is its sheet, file and ordinal in the file: the rows of the file's earlier splits plus its place in its own split, so it
    is the same however the file is split. ``_broken`` holds records with too few or too many cells, such as the halves of
    a record with a line break in quotes; ``multi_line`` reads those, but a file then is one split.
    """
    schema = T.StructType([*TEXT_LEDGER_SCHEMA.fields, T.StructField(BROKEN, T.StringType())])
    ledger = None
    for i, (name, path) in enumerate(sheets.items()):
        read = spark.read.schema(schema).option("header", header).option("multiLine", multi_line)
        frame = (
            read.option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False).csv(path)
            .select(
                "*",
                F.lit(name).alias("source_sheet"),
                F.lit(i).alias("_sheet"),
                F.col("_metadata.file_path").alias("_path"),
                F.col("_metadata.file_block_start").alias("_block"),
            )
            # Ids grow by one along each split.
            .withColumn("_seq", F.monotonically_increasing_id())
        )
        splits = frame.groupBy("_path", "_block").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        earlier = F.sum("_rows").over(Window.partitionBy("_path").orderBy("_block")) - F.col("_rows")
        splits = splits.select("_path", "_block", "_first", earlier.alias("_earlier"))
        # One row per split, of which the driver has a list anyway. Left to measured sizes, the rows would be on their way through a
        # shuffle before the size is known.
        frame = frame.join(F.broadcast(splits), ["_path", "_block"]).withColumn("_ordinal", F.col("_earlier") + F.col("_seq") - F.col("_first"))
        frame = frame.select(*[F.col(f"`{c}`") for c in schema.names], "source_sheet", "_sheet", "_path", "_ordinal")
        ledger = frame if ledger is None else ledger.unionByName(frame)
    return require_ledger_columns(ledger)


def refuse_broken_records(text_ledger: DataFrame) -> DataFrame:
    """The ledger without ``_broken``; an error if a record does not have the eight cells."""
    broken = text_ledger.agg(F.count(BROKEN).alias("broken"), F.count(F.lit(1)).alias("rows"), F.count("Invoice")).first()["broken"]
    if broken:
        raise ValueError(f"records that do not have {len(LEDGER_COLUMNS)} cells: {broken}; line breaks in quotes need multi_line")
    return text_ledger.drop(BROKEN)


BROKEN = "_broken"
TEXT_POSITION = ["_sheet", "_path", "_ordinal"]


def snapshot_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks, and files, of a table of so many rows in source order."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def write_raw_snapshot(
    ledger: DataFrame,
    path: str,
    order_by: list[str],
    rows: int | None = None,
    *,
    task: str | None = None,
    parted: bool = False,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Persist the ledger, one folder per sheet, files and rows in source order; the number of files follows the rows.

    ``rows`` is their number or about that, if it is known: counting a ledger made by joins repeats the joins. ``task`` names a column that
    parts the rows of each sheet into ranges of the order, numbered from 0 to ``snapshot_tasks``, if the caller knows them; otherwise the ledger is
    computed once more to be sampled. With ``parted`` the rows lie in the partitions of these numbers already. ``finish`` makes the ledger's columns, row by row, from narrower rows that are moved and sorted instead.
    Columns that are neither text, number, boolean nor date are widened to text.
    """
    keep = (T.StringType, T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)
    order = ["source_sheet", *order_by]
    if rows is None:
        rows = ledger.count()
    tasks = snapshot_tasks(ledger.sparkSession, rows)
    if not parted:
        ledger = ledger.repartitionById(tasks, task) if task else ledger.repartitionByRange(tasks, *order)
    ordered = ledger.sortWithinPartitions(*order)
    if finish:
        ordered = finish(ordered)
    columns = [
        F.col(f"`{f.name}`") if isinstance(f.dataType, keep) else F.col(f"`{f.name}`").cast("string").alias(f.name)
        for f in ordered.schema
        if f.name not in order_by and f.name not in ("source_order", task)
    ]
    ordered.select(*columns).write.mode("overwrite").partitionBy("source_sheet").option(*STAGED_CODEC).parquet(path)


def snapshot_sheets(path: str, names: list[str]) -> dict[str, str]:
    """Sheet folders inside a raw snapshot, in the given sheet order."""
    return {name: f"{path}/source_sheet={name}" for name in names}
