"""Content fingerprints of ledgers as trees of digest sums, and fingerprints of text as it arrived.

A row is written as a JSON array of its cells, so no two different rows look alike, and hashed. A tree has leaves (keys, rows, two sums
of 60-bit parts of the row hashes); sums do not depend on order or partitions, and add up to those of any node above. Two trees are
compared from the root: if it agrees, nothing below is looked at, and otherwise only rows of differing leaves need a comparison.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import as_number, as_timestamp
from ..schema import LEDGER_COLUMNS

_SUMS = ["digest_a", "digest_b"]


def _number_cell(ledger: DataFrame, name: str) -> Column:
    """A number written alike for numeric and textual columns; an unreadable cell as it stands, behind a question mark."""
    raw, number = F.col(f"`{name}`").cast("string"), as_number(ledger, name).cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < 9e15)
    written = F.when(whole, number.try_cast("bigint").cast("string")).otherwise(number.cast("string"))
    return F.when(raw.isNull(), F.lit(None)).otherwise(F.coalesce(written, F.concat(F.lit("?"), raw)))


def ledger_cells(ledger: DataFrame) -> list[Column]:
    """The cells of a ledger row as text: texts as they are, numbers and dates by value."""

    def cell(name: str) -> Column:
        if name in ("Quantity", "Price", "Customer ID"):
            return _number_cell(ledger, name)
        raw = F.col(f"`{name}`").cast("string")
        if name == "InvoiceDate":
            written = F.date_format(as_timestamp(ledger, name), "yyyy-MM-dd HH:mm:ss.SSSSSS")
            return F.when(raw.isNull(), F.lit(None)).otherwise(F.coalesce(written, F.concat(F.lit("?"), raw)))
        return raw

    return [cell(c) for c in [*LEDGER_COLUMNS, "source_sheet"]]


def row_digest(cells: list[Column]) -> Column:
    """sha256 of the JSON array of text cells; a null is not the text 'null'."""
    return F.sha2(F.to_json(F.array(*cells), {"ignoreNullFields": "false"}), 256)


def digest_leaves(rows: DataFrame, digest: Column, keys: dict[str, Column]) -> DataFrame:
    """One row per leaf: ``keys``, row count and digest sums. Sums are pre-added in each task."""
    hexed = rows.select(*[k.alias(name) for name, k in keys.items()], digest.alias("_digest"))
    part = lambda at: F.conv(F.substring("_digest", at, 15), 16, 10).cast("bigint")
    parted = hexed.select(*keys, part(1).alias(_SUMS[0]), part(16).alias(_SUMS[1]))
    # Thirds of 20 bits add up as longs for 2^43 rows; decimals are made once per leaf.
    third = lambda name, i: F.sum(F.shiftright(name, 20 * i).bitwiseAND((1 << 20) - 1)).alias(f"_{name}_{i}")
    added = parted.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[third(name, i) for name in _SUMS for i in range(3)])

    def whole(name: str) -> Column:
        low, middle, high = (F.col(f"_{name}_{i}").cast("decimal(19,0)") * F.lit(Decimal(1 << (20 * i))) for i in range(3))
        return (low + middle + high).cast("decimal(38,0)").alias(name)

    return added.select(*keys, "rows", *[whole(name) for name in _SUMS])


def digest_root(leaves: DataFrame) -> DataFrame:
    """One row (rows, sha256) of a whole tree."""
    total = leaves.agg(*[F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias(c) for c in ("rows", *_SUMS)])
    return total.select(
        F.col("rows").cast("bigint").alias("rows"), F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("rows", *_SUMS)]), 256).alias("sha256")
    )


def differing_leaves(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of leaves that two trees do not share; one row per leaf, never one per ledger row."""
    either = left.select(*keys, F.struct("rows", *_SUMS).alias("l")).join(right.select(*keys, F.struct("rows", *_SUMS).alias("r")), keys, "full_outer")
    return either.where(~F.col("l").eqNullSafe(F.col("r"))).select(*keys)


def ledger_tree(ledger: DataFrame) -> DataFrame:
    """Leaves (source_sheet, bucket): rows of a sheet whose digests begin with the same three hex digits."""
    keyed = ledger.withColumn("_row_digest", row_digest(ledger_cells(ledger)))
    return digest_leaves(keyed, F.col("_row_digest"), {"source_sheet": F.col("source_sheet"), "bucket": F.substring("_row_digest", 1, 3)})


def ledger_fingerprint(ledger: DataFrame) -> DataFrame:
    """One row (rows, sha256) that identifies the multiset of ledger rows, up to hash collisions; order plays no part."""
    return digest_root(digest_leaves(ledger, row_digest(ledger_cells(ledger)), {"source_sheet": F.col("source_sheet")}))


def arrival_fingerprint(text_ledger: DataFrame, position: list[str]) -> DataFrame:
    """One row (rows, sha256) over the raw cells and the place of every row, for the decision to reuse a snapshot.

    Cells are taken as they were read, before any coercion; a row that moved, or a cell that was damaged in another way, changes the
    result. Places are file names and line ordinals, so the same files give the same print on any cluster.
    """
    place = [F.element_at(F.split("_path", "/"), -1) if c == "_path" else F.col(f"`{c}`").cast("string") for c in position]
    cells = [F.col(f"`{c}`").cast("string") for c in text_ledger.columns if c not in position]
    digest = F.sha2(F.to_json(F.array(*place, *cells), {"ignoreNullFields": "false"}), 256)
    return digest_root(digest_leaves(text_ledger, digest, {"source_sheet": F.col("source_sheet")}))
