"""Repeated passages by content-defined chunks of a gear rolling hash.

The gear hash of a byte position depends on the last ``GEAR_WINDOW`` bytes only. A chunk ends where that hash
is the smallest within ``REACH`` bytes on both sides, so cuts follow the content: an insertion moves the cuts around it
and none behind it. Equal smallest hashes all cut: text that repeats a word or line has a cut at the same place of
every period, whatever its period. Chunks are compared by 128-bit digests. The first occurrence of a chunk (smallest doc_id, then
position) is the original, all others are repeats. A run of neighbouring repeated chunks is a repeated passage if
it holds at least ``MIN_WORDS`` words; a passage loses at most its two outermost chunks, and single short chunks that
agree by chance make no run.

Chunks are counted per digest with partial sums; only digests seen twice are joined back, and a very frequent
chunk's join partition can be split because both sides are plain shuffles. Texts themselves are never shuffled
for the search. Chunks have at least ``MIN_BYTES`` bytes (but for the last of a text) and at most ``MAX_BYTES``, so a
text without any cut still gives chunks of bounded size.

Defined results: a null or empty text has no chunks. Rows that repeat doc_id and text are copies of one
row and are searched once. A null doc_id comes after all others. Positions are bytes of the UTF-8 text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged
from ledgerloom.llm.text import _SPACE, buffers, slices

GEAR_WINDOW = 16
REACH = 12  # one cut in 2 * REACH + 1 bytes of varied text
MIN_BYTES, MAX_BYTES = 8, 1024
MIN_WORDS = 16
_gear = np.random.Generator(np.random.PCG64(2002)).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[data[i - j]] << j for j < GEAR_WINDOW, by doubling the window."""
    h = _gear[data]
    width = 1
    while width < GEAR_WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h, width = longer, 2 * width
    return h


def _smallest_near(h: np.ndarray) -> np.ndarray:
    """Minimum of h over REACH places on both sides, by doubling the window."""
    width, wanted = 1, 2 * REACH + 1
    low = np.pad(h, REACH, constant_values=np.iinfo(h.dtype).max)
    while width < wanted:
        step = min(width, wanted - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    return low


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all chunks of the texts between ``offsets``, and the row of each."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = gear_hashes(data)
    # a window that reaches back over the text's start would depend on the text before; REACH ends before the next full one
    full = np.ones(len(data), bool)
    early = (offsets[:-1, None] + np.arange(GEAR_WINDOW - 1)).ravel()
    full[early[early < len(data)]] = False
    h[~full] = np.iinfo(h.dtype).max
    cuts = np.flatnonzero((h == _smallest_near(h)) & full) + 1
    ends: list[int] = []
    at = 0
    cut_list = cuts.tolist()
    for row in range(len(offsets) - 1):
        begin, stop = int(offsets[row]), int(offsets[row + 1])
        while at < len(cut_list) and cut_list[at] < stop:
            cut = cut_list[at]
            at += 1
            if cut - begin < MIN_BYTES:
                continue
            while cut - begin > MAX_BYTES:
                begin += MAX_BYTES
                ends.append(begin)
            if cut > begin:
                ends.append(cut)
                begin = cut
        while at < len(cut_list) and cut_list[at] <= stop:
            at += 1
        while stop - begin > MAX_BYTES:
            begin += MAX_BYTES
            ends.append(begin)
        if stop > begin:
            ends.append(stop)
    found = np.asarray(ends, np.int64)
    return found, np.searchsorted(offsets, found, "left") - 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column(2))
        for first, last in slices(offsets):
            lo = offsets[first]
            part, inner = data[lo : offsets[last]], offsets[first : last + 1] - lo
            # empty rows share their offset with the next row; searchsorted must see distinct starts
            filled = np.flatnonzero(np.diff(inner))
            ends, rows = chunk_ends(part, np.append(inner[filled], inner[-1]))
            if not len(ends):
                continue
            rows = filled[rows]
            starts = np.concatenate([[0], ends[:-1]])
            starts = np.maximum(starts, inner[rows])
            raw = part.tobytes()
            digests = np.frombuffer(b"".join([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())]), np.int64).reshape(-1, 2)
            space = _SPACE[part]
            begins = ~space
            begins[1:] &= space[:-1]
            begins[inner[filled]] = ~space[inner[filled]]
            words = np.concatenate([[0], np.cumsum(begins)])
            where = pa.array(first + rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(where), batch.column(1).take(where), pa.array((starts - inner[rows]).astype(np.int32)), pa.array((ends - inner[rows]).astype(np.int32)),
                 pa.array((words[ends] - words[starts]).astype(np.int32)), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())],
                ["doc_id", "text_key", "start", "stop", "n_words", "d1", "d2"],
            )


_SCHEMA = "doc_id long, text_key long, start int, stop int, n_words int, d1 long, d2 long"


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, stop, n_words, d1, d2): the chunks of every text with their digests."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return texts.mapInArrow(_chunks, _SCHEMA)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, start, stop, n_words, n_chunks, first_doc_id): runs of chunks that occur earlier elsewhere.

    ``first_doc_id`` is the document that holds the original of the run's longest chunk.
    """
    found = chunks(docs)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "start")
    originals = found.groupBy("d1", "d2").agg(F.min(place).alias("o"), F.count("*").alias("times")).where("times > 1")
    originals = originals.select("d1", "d2", F.col("o.doc_id").alias("first_doc_id"), F.col("o.text_key").alias("first_key"), F.col("o.start").alias("first_start"))
    originals = staged(originals, "originals")
    repeats = found.join(originals, ["d1", "d2"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("text_key") == F.col("first_key")) & (F.col("start") == F.col("first_start")))
    )
    repeats = repeats.select("doc_id", "text_key", "start", "stop", "n_words", "first_doc_id").dropDuplicates(["doc_id", "text_key", "start"])
    in_text = W.partitionBy("doc_id", "text_key").orderBy("start")
    run = F.sum((~F.col("start").eqNullSafe(F.lag("stop").over(in_text))).cast("int")).over(in_text)
    runs = repeats.withColumn("run", run).groupBy("doc_id", "text_key", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n_words").cast("long").alias("n_words"), F.count("*").alias("n_chunks"),
        F.max_by("first_doc_id", F.struct(F.col("stop") - F.col("start"), -F.col("start"))).alias("first_doc_id"),
    )
    return runs.where(F.col("n_words") >= min_words).drop("run")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every repeated passage cut out of its text but for the first occurrence; all columns kept."""
    spans = repeated_passages(docs, min_words).groupBy(F.col("doc_id").alias("__span_id"), F.col("text_key").alias("__span_key"))
    spans = staged(spans.agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("__spans")), "spans")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__span_id")) & (F.xxhash64("text") == F.col("__span_key"))
    marked = docs.join(spans, same, "left").drop("__span_id", "__span_key")
    raw = F.col("text").cast("binary")
    # the bytes before each passage, then those after the last; chunk borders may fall inside a character, which
    # belongs to the passage whose first byte it starts in, so incomplete characters are dropped when decoding
    previous = F.concat(F.array(F.lit(0)), F.transform("__spans", lambda s: s["stop"]))
    following = F.concat(F.transform("__spans", lambda s: s["start"]), F.array(F.octet_length("text")))
    parts = F.transform(F.arrays_zip(previous.alias("a"), following.alias("b")), lambda p: F.hex(F.substring(raw, p["a"] + 1, p["b"] - p["a"])))
    cut = F.unhex(F.array_join(parts, "")).cast("string")
    return marked.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.make_valid_utf8(cut))).drop("__spans")
