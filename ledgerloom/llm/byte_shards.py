"""Contiguous shards of nearly equal bytes, from prefix sums over partition totals.

The documents are put in order by range partitioning; a document's number inside its partition comes with
the partitioning itself. Byte positions are sums on three levels: inside blocks of ``BLOCK_ROWS`` rows,
over the blocks of a partition, and over the partitions' totals (one row per partition). No step sees all
documents in one task. A document belongs to the shard in which its middle byte falls when the whole byte
range is cut at equal targets, so every cut is within half a document of its target.

Only DataFrame functions are used. Defined results: a null text has no bytes (size 16). Rows are in order of
doc_id, then checksum, size and input position, so repeated ids and whole repeated rows have places of their
own; a null doc_id comes first. An empty table gives no rows; more shards than documents leave some
empty. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged

BLOCK_ROWS = 4096
OVERHEAD_BYTES = 16
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def _before(column: str, window) -> F.Column:
    """Sum of all earlier rows of the window."""
    return F.sum(column).over(window.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col(column)


def byte_positions(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, before, number, total): bytes and rows before each document, and all bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = ["doc_id", "text_crc32", "size", "place"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ordered = ordered.select(
        "doc_id", "size", "text_crc32",
        F.shiftright("at", _ROW_BITS).alias("part"), F.col("at").bitwiseAND((1 << _ROW_BITS) - 1).alias("row"),
    )
    ordered = staged(ordered.withColumn("block", F.expr(f"row div {BLOCK_ROWS}")), "ordered")

    blocks = ordered.groupBy("part", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    blocks = staged(blocks, "block-totals")
    parts = blocks.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    all_parts = W.partitionBy(F.lit(0)).orderBy("part")  # one row per partition
    parts = parts.select(
        "part", _before("bytes", all_parts).alias("part_bytes"), _before("rows", all_parts).alias("part_rows"),
        F.sum("bytes").over(W.partitionBy(F.lit(0))).alias("total"),
    )
    blocks = blocks.withColumn("block_bytes", _before("bytes", W.partitionBy("part").orderBy("block"))).join(parts, "part")
    offsets = blocks.select("part", "block", (F.col("part_bytes") + F.col("block_bytes")).alias("base"), "part_rows", "total")
    inside = ordered.withColumn("inside", _before("size", W.partitionBy("part", "block").orderBy("row")))
    return inside.join(offsets, ["part", "block"]).select(
        "doc_id", "size", "text_crc32", (F.col("base") + F.col("inside")).alias("before"),
        (F.col("part_rows") + F.col("row")).alias("number"), "total",
    )


def balanced_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): ``shards`` contiguous shards of nearly equal bytes."""
    middle = F.expr(f"((2 * before + size) * {shards}) div (2 * total)")
    cut = byte_positions(docs).select("doc_id", "size", "text_crc32", "number", F.least(middle, F.lit(shards - 1)).cast("int").alias("shard"))
    cut = staged(cut, "cut")
    first = cut.groupBy("shard").agg(F.min("number").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(  # at most one row per shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("number") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
