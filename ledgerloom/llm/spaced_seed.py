"""Benchmark passages in training documents, found by spaced seeds and verified word by word.

A seed is a fixed mask over a window of words: only the marked positions are hashed, so a substituted word at
an ignored position does not hide the passage. All masks are applied at every position of every benchmark
item and of every document; equal hashes are joined. A hit fixes how item and document lie on each
other; along that line every word is then compared, and the passage counts where a window of ``VERIFY``
words has at least ``EQUAL_PERCENT`` hundredths equal. The words around a hit decide, not the hit. The masks are chosen
so that any two substitutions in a window of ``VERIFY`` words leave one of them a place to hit: no passage that
would pass the verification is missed.

Most document positions hit nothing. A bitmap of fixed size (8 MB) with one bit for each benchmark hash drops them
inside the scan; it is broadcast, and its size does not depend on the data. A bitmap that fills up lets
more rows through to the join but never changes the result.

Items of fewer than ``VERIFY`` words have masks of their own and are compared as a whole by the same percentage: one
substitution from six words on, two from ten on. Items of fewer than six words show nothing and never match. Items of equal
text are one item with the smallest id; an item without id counts like any other and is reported with a null id.
Alignments are gathered per document and item, so a sentence that many items share makes many rows and no large one.
Defined results: null or blank texts contain nothing; rows repeating a doc_id are judged by their own texts;
an empty benchmark or document table gives no rows and drops nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import free_names, staged
from ledgerloom.llm.text import hashed_words, mix, row_ranges

LONG_MASKS = ("10101111", "11100111", "11101101")  # for items of VERIFY words and more
SHORT_MASKS = ("111100", "110011", "001111")  # for items of six words and more
MASKS = (*LONG_MASKS, *SHORT_MASKS)
LEAST = len(SHORT_MASKS[0])
VERIFY = 12
EQUAL_PERCENT = 80
BITMAP_BITS = 26

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(4004))
_STEPS = _rng.integers(0, 2**62, (len(MASKS), len(LONG_MASKS[0])), dtype=np.uint64) * _U(2) + _U(1)


def _seeds(words: np.ndarray, rows: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of one mask at all positions whose window stays inside its text."""
    marks = MASKS[mask]
    n = len(words) - len(marks) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, mask, np.uint64)
    for k, mark in enumerate(marks):
        if mark == "1":
            total += words[k : k + n] * _STEPS[mask, k]
    inside = np.flatnonzero(rows[:n] == rows[len(marks) - 1 :])
    return mix(total[inside]), inside


def _benchmark_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last, words, rows, _ in hashed_words(batch.column(1)):
            bounds = row_ranges(rows, last - first)
            lengths = np.diff(bounds)
            for mask in range(len(MASKS)):
                hashes, at = _seeds(words, rows, mask)
                right = (lengths[rows[at]] >= VERIFY) == (mask < len(LONG_MASKS))
                hashes, at = hashes[right], at[right]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(ids[first + rows[at]]), pa.array((at - bounds[rows[at]]).astype(np.int32))],
                    ["hash", "item", "item_at"],
                )


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for first, last, words, rows, _ in hashed_words(batch.column(1)):
            bounds = row_ranges(rows, last - first).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(words.view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids.slice(first, last - first), lists], ["item", "item_words"])


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """One bit per seed hash in 2**BITMAP_BITS bits; at most 2**(BITMAP_BITS - 6) words reach the driver."""
    bit = F.col("hash").bitwiseAND((1 << BITMAP_BITS) - 1)
    words = seeds.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(hash & 63 as int))")).alias("bits"))
    filled = words.toPandas()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    bitmap[filled["word"].to_numpy(np.int64)] = filled["bits"].to_numpy(np.int64)
    return bitmap.view(np.uint64)


def _scan(bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        low = _U((1 << BITMAP_BITS) - 1)
        for batch in batches:
            for first, last, words, rows, _ in hashed_words(batch.column(2)):
                bounds = row_ranges(rows, last - first)
                for mask in range(len(MASKS)):
                    hashes, at = _seeds(words, rows, mask)
                    place = hashes & low
                    found = np.flatnonzero((bits[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1))
                    if len(found):
                        at = at[found]
                        where = pa.array(first + rows[at])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(where), batch.column(1).take(where), pa.array(hashes[found].view(np.int64)), pa.array((at - bounds[rows[at]]).astype(np.int32))],
                            ["doc_id", "text_key", "hash", "at"],
                        )

    return run


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The document's words under an item at each of its alignments, and the item position where they begin."""
    for batch in batches:
        items, lengths, shifts = (batch.column(c).to_pylist() for c in (3, 4, 5))
        for first, last, words, rows, _ in hashed_words(batch.column(2)):
            bounds = row_ranges(rows, last - first)
            out = []
            for row in range(first, last):
                lo, hi = bounds[row - first], bounds[row - first + 1]
                for shift in shifts[row]:
                    begin, end = max(0, shift), min(hi - lo, shift + lengths[row])
                    out.append((row, items[row], begin, begin - shift, words[lo + begin : lo + end].view(np.int64)))
            for at in range(0, len(out), 10_000):
                part = out[at : at + 10_000]
                where = pa.array([p[0] for p in part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(where), batch.column(1).take(where), pa.array([p[1] for p in part], pa.int64()),
                     pa.array([p[2] for p in part], pa.int32()), pa.array([p[3] for p in part], pa.int32()), pa.array([p[4] for p in part], pa.list_(pa.int64()))],
                    ["doc_id", "text_key", "item", "start", "item_start", "doc_words"],
                )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps alignments with a window of VERIFY words (or the whole shorter item) that is equal enough."""
    for batch in batches:
        kept, starts, lengths, equals = [], [], [], []
        for row in range(batch.num_rows):
            doc = batch.column(5)[row].values.to_numpy()
            item = batch.column(6)[row].values.to_numpy()
            window = min(VERIFY, len(item))
            item_start = batch.column(4)[row].as_py()
            same = doc == item[item_start : item_start + len(doc)]
            if len(same) < window:
                continue
            sums = np.concatenate([[0], np.cumsum(same)])
            good = np.flatnonzero(100 * (sums[window:] - sums[:-window]) >= EQUAL_PERCENT * window)
            if len(good):
                begin, end = int(good[0]), int(good[-1]) + window
                kept.append(row)
                starts.append(batch.column(3)[row].as_py() + begin)
                lengths.append(end - begin)
                equals.append(int(sums[end] - sums[begin]))
        where = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(where) for c in (0, 1, 2)], pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(equals, pa.int64())],
            ["doc_id", "text_key", "item", "start_word", "n_words", "n_equal"],
        )


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item, item_id, start_word, n_words, n_equal): every benchmark passage in every document."""
    items = benchmark.where("text is not null").groupBy("text").agg(F.min(F.col("item_id").cast("long")).alias("item_id"))
    items = staged(items.withColumn("item", F.monotonically_increasing_id()), "items")
    numbered = items.select("item", "text")
    seeds = staged(numbered.mapInArrow(_benchmark_seeds, "hash long, item long, item_at int"), "item-seeds")
    words = staged(numbered.mapInArrow(_item_words, "item long, item_words array<long>"), "item-words")
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(seeds))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    hits = texts.mapInArrow(_scan(bitmap), "doc_id long, text_key long, hash long, at int")
    lines = hits.join(seeds, "hash").select(
        F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "item", (F.col("at") - F.col("item_at")).alias("shift")
    )
    lines = lines.groupBy("hit_id", "hit_key", "item").agg(F.collect_set("shift").alias("shifts"))
    lines = staged(lines.join(words.select("item", F.size("item_words").alias("item_length")), "item"), "lines")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
    hit = texts.dropna(subset=["text"]).join(lines, same).select("doc_id", "text_key", "text", "item", "item_length", "shifts")
    schema = "doc_id long, text_key long, item long, start int, item_start int, doc_words array<long>"
    aligned = hit.mapInArrow(_aligned, schema).join(words, "item")
    aligned = aligned.select("doc_id", "text_key", "item", "start", "item_start", "doc_words", "item_words")
    found = aligned.mapInArrow(_verify, "doc_id long, text_key long, item long, start_word long, n_words long, n_equal long")
    return found.join(items.select("item", "item_id"), "item")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item: the longest overlap, and how often the item occurs in it."""
    found = overlaps(docs, benchmark).groupBy("doc_id", "item", "item_id")
    best = F.max(F.struct("n_equal", "n_words", (-F.col("start_word")).alias("s"))).alias("best")
    return found.agg(best, F.count("*").alias("n_overlaps")).select(
        "doc_id", "item_id", (-F.col("best.s")).alias("start_word"), F.col("best.n_words").alias("n_words"),
        F.col("best.n_equal").alias("n_equal"), "n_overlaps",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark passage, all columns kept."""
    hit_id, hit_key = free_names(docs, "hit_id", "hit_key")
    found = staged(overlaps(docs, benchmark).select(F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key)).distinct(), "contaminated")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(hit_id)) & (F.xxhash64("text") == F.col(hit_key))
    return docs.join(found, same, "left_anti")
