"""Line dedup against levelled sorted runs of line hashes.

Documents come in batches of ascending doc_id. The lines seen so far are an index of *runs*: tables of 128-bit line
hashes, bucketed by hash and sorted inside each bucket. A new batch

1. reduces its lines to one row per hash with its smallest doc_id,
2. is merge-joined with every run: a hash that a run holds belongs to an earlier document, all others are new,
3. adds its new hashes as a run of level 0. When a level has ``FAN_IN`` runs, they are merged into one run of the
   next level before another one is added, so a batch meets a number of runs that grows with the logarithm of the batches.

Runs and batches share the bucketing, so the index is never shuffled when it is probed. A line goes if its hash is in an
earlier run, or if an earlier document of its own batch has it; the others stay. Only hashes and line numbers are shuffled for
the decision; texts move once, to meet the numbers of their dropped lines.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased; it counts from ``MIN_CHARS``
code points on. Only DataFrame functions are used. A line in very many documents is reduced to one row per task before
the shuffle, and its rows in the later join lie on a side that Spark can split.

Defined results: a null text is one empty line. Rows of equal doc_id are one document: they keep their lines if it is
the first. A null doc_id is one document after all others. Repeated rows, ties and lines repeated within a document
stay together or go together. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.staging import new_folder, partitions_for, staged

MIN_CHARS = 10
BATCHES = 4
FAN_IN = 2
LINE_BYTES = 48
_BLANKS = " \t\n\x0b\x0c\r"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


class LineIndex:
    """Levelled runs of line hashes in the shared folder; ``drop`` removes its tables."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.levels: list[list[str]] = [[]]
        self._tables: list[str] = []

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def _written(self, hashes: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        placed = hashes.select(HASH).repartition(self.buckets, *HASH).sortWithinPartitions(*HASH)
        writer = placed.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet")
        writer.option("path", new_folder(self.spark, f"run-{level}")).saveAsTable(name)
        self._tables.append(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def add(self, hashes: DataFrame) -> None:
        """``hashes`` as a new run, after levels that are full have been merged upwards."""
        for level, runs in enumerate(list(self.levels)):
            if len(runs) < FAN_IN:
                break
            merged = self.spark.table(runs[0])
            for run in runs[1:]:
                merged = merged.unionByName(self.spark.table(run))
            self._compacted(level, merged)
        self._written(hashes, 0)

    def _compacted(self, level: int, merged: DataFrame) -> None:
        if len(self.levels) > level + 1 and len(self.levels[level + 1]) >= FAN_IN:
            upper = self.spark.table(self.levels[level + 1][0])
            for run in self.levels[level + 1][1:]:
                upper = upper.unionByName(self.spark.table(run))
            self._compacted(level + 1, upper)
        self._written(merged, level + 1)
        self.levels[level] = []

    def marked(self, hashes: DataFrame) -> DataFrame:
        """``hashes`` with ``old``: whether some run holds them."""
        old = F.lit(False)
        for number, run in enumerate(self.runs()):
            flag = f"in_run_{number}"
            hashes = hashes.join(self.spark.table(run).withColumn(flag, F.lit(True)), HASH, "left")
            old = old | F.col(flag).isNotNull()
        return hashes.withColumn("old", old).drop(*(f"in_run_{n}" for n in range(len(self.runs()))))

    def drop(self) -> None:
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _keys(lines: F.Column) -> F.Column:
    """(line number, key) of every line whose key is long enough."""
    def key(line):
        bare = F.btrim(line, F.lit(_BLANKS))
        # lower() knows more capitals than A-Z, but agrees with it on ASCII lines and is far faster than translate().
        return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _CAPITALS, _SMALL))

    pairs = F.transform(lines, lambda line, at: F.struct(at.alias("at"), key(line).alias("key")))
    return F.filter(pairs, lambda x: F.char_length(x["key"]) >= MIN_CHARS)


def _cuts(docs: DataFrame, batches: int) -> list:
    """At most ``batches`` - 1 ascending ids that part the documents about evenly; they decide the work of a batch, not results."""
    shares = [k / batches for k in range(1, batches)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 1000).alias("cuts")).first().cuts if shares else None
    return sorted(set(found or []))


def dropped_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, text_hash, dropped): the numbers of the lines that go, for every document that loses any."""
    spark = docs.sparkSession
    cuts = _cuts(docs, batches)
    batch = F.lit(len(cuts))
    for number, cut in reversed(list(enumerate(cuts))):
        batch = F.when(F.col("doc_id") <= F.lit(cut), number).otherwise(batch)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), batch.alias("batch"), F.explode(_keys(F.split(text, "\n"))).alias("line"))
    key = F.col("line.key")
    lines = lines.select("doc_id", "text_hash", "batch", F.col("line.at").alias("at"), F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    lines = staged(lines, "lines")

    # With as many buckets as a shuffle has partitions, or more, Spark never moves a run to meet a batch.
    buckets = max(partitions_for(spark, lines.count() * LINE_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = LineIndex(spark, buckets)
    repeated = []
    for number in range(len(cuts) + 1):
        mine = lines.where(F.col("batch") == number)
        # A null id is after all others: min() passes over it, and a document with it is no first one beside another.
        seen = mine.groupBy(*HASH).agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("unnamed")
        )
        several = ~F.col("first").eqNullSafe(F.col("last")) | (F.col("unnamed") & F.col("first").isNotNull())
        seen = staged(index.marked(seen.withColumn("several", several)), "batch-lines")
        repeated.append(seen.where("old or several").select(F.lit(number).alias("batch"), *HASH, "first", "old"))
        if number < len(cuts):
            index.add(seen.where("not old"))
    index.drop()

    known = repeated[0]
    for part in repeated[1:]:
        known = known.unionByName(part)
    gone = lines.join(known, ["batch", *HASH]).where(F.col("old") | ~F.col("doc_id").eqNullSafe(F.col("first")))
    # The numbers are those of one text, whatever the number of rows that hold it.
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("dropped"))


def without_repeated_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    gone = staged(dropped_lines(docs, batches), "dropped-lines")
    gone = gone.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "dropped")
    rows = docs.select("doc_id", text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    rows = rows.join(gone.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left")

    def kept(lines):
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
        return F.array_join(F.transform(places, lambda at: F.get(lines, at)), "\n")

    # An array of one element binds the lines once for all uses inside the function.
    rebuilt = F.transform(F.array(F.split("text", "\n")), kept)[0]
    return rows.select(
        "doc_id",
        (F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(rebuilt).alias("kept_text"),
    )
