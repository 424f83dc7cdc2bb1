"""Product-quantisation codes of vectors by Lloyd rounds whose members stay with their owners.

A vector of d components is cut into ``parts`` equal pieces, and every piece is coded by the nearest of ``entries``
codebook entries of its position. Pieces live in *packs*: one row holds the pieces of one (position, entry, salt),
their rows as 16-bit numbers and their components in the narrowest integer type. The salt is a block of
``BLOCK_ROWS`` vectors, so a pack is bounded however many vectors share an entry, and packs are dealt over the
cluster by (position, entry, salt). A round then is

1. the owners add up their resident members; the sums of all salts (one row per position and entry) make the new codebook;
2. each owner looks for the nearest new entry of every resident member. Members that keep their entry are written where
   they are, in a narrow step; only members with another entry are shuffled, to the owner of that entry.

Both states of a round are written tables in the shared folder, so a lost executor costs only tasks of the running step.
Only codebooks come to the driver: parts x entries rows, whatever the number of vectors. All arithmetic is on integers.

Defined results: a vector that is null or holds a null, NaN or infinite component is dropped. Rows are taken in order of
vec_id (null last), then of components, for the first codebooks; repeated ids and whole repeated rows count as rows
of their own, and only equal rows are interchangeable. With fewer kept rows than ``entries`` the codebooks are that
short. Vectors of another length than the first kept row cannot be compared with it and are dropped; a length that
``parts`` does not divide is an error. Components must be below 2^31 after scaling. An empty table, or one
whose vectors are all dropped, gives no rows. Null labels are one label. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.staging import partitions_for, staged

SCALE = 256
BLOCK_BITS = 13
BLOCK_ROWS = 1 << BLOCK_BITS  # a divisor of the row numbers that one partition may hold
EXACT = 1 << 53
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows whose components are all finite, as integers floor(SCALE * x)."""
    finite = F.expr("embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return vectors.where(F.coalesce(finite, F.lit(False))).select("vec_id", "label", scaled.alias("v"))


def nearest(pieces: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each piece (lowest on ties) and the squared distance, exactly."""
    width = pieces.shape[1]
    if not width:
        return np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    high = max(int(np.abs(pieces).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * width * high * high < EXACT:
        p, c = pieces.astype(np.float64), book.astype(np.float64)
        far = (c * c).sum(1) - 2.0 * (p @ c.T)
        best = far.argmin(1)
        return best, (far[np.arange(len(p)), best] + (p * p).sum(1)).astype(np.int64)
    best, least = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    for at, piece in enumerate(pieces.tolist()):
        far = [sum((a - b) ** 2 for a, b in zip(piece, entry, strict=True)) for entry in book.tolist()]
        best[at] = far.index(min(far))
        least[at] = min(far)
    return best, least


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary cells: the bytes of ``values`` between consecutive ``cuts`` (in items)."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _narrow(values: np.ndarray) -> np.ndarray:
    high = int(np.abs(values).max(initial=0))
    if high >= 1 << 31:
        raise ValueError("components must be below 2^31 after scaling")
    return values.astype(next(t for t in _WIDTHS if high <= np.iinfo(t).max))


PACK = "position int, entry int, salt long, moved boolean, n int, bytes int, rows binary, pieces binary, sums array<long>"
CODE = "salt long, position int, entry int, rows binary, errors binary"


def _packed(position: int, entry: np.ndarray, salt: np.ndarray, moved: np.ndarray, rows: np.ndarray, pieces: np.ndarray) -> pa.RecordBatch | None:
    """Packs of one position: members sorted by (moved, entry, salt) and cut where these change."""
    if not len(rows):
        return None
    order = np.lexsort((rows, salt, entry, moved))
    entry, salt, moved, rows, pieces = entry[order], salt[order], moved[order], rows[order], pieces[order]
    new = np.flatnonzero((np.diff(entry) != 0) | (np.diff(salt) != 0) | (np.diff(moved) != 0)) + 1
    first = np.concatenate([[0], new])
    cuts = np.concatenate([first, [len(rows)]])
    width = pieces.shape[1]
    narrow = _narrow(pieces)
    sums = np.add.reduceat(pieces, first, axis=0) if width else np.zeros((len(first), 0), np.int64)
    return pa.record_batch(
        [
            pa.array(np.full(len(first), position, np.int32)),
            pa.array(entry[first].astype(np.int32)),
            pa.array(salt[first]),
            pa.array(moved[first]),
            pa.array(np.diff(cuts).astype(np.int32)),
            pa.array(np.full(len(first), narrow.itemsize, np.int32)),
            _blobs(rows.astype(np.uint16), cuts),
            _blobs(narrow.reshape(-1), cuts * width),
            pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * width), pa.array(sums.reshape(-1))),
        ],
        names=["position", "entry", "salt", "moved", "n", "bytes", "rows", "pieces", "sums"],
    )


def _members(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, entry, salt, row, pieces) of all members of a batch of packs, one position and integer width at a time."""
    column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
    positions, entries, salts, counts, sizes = (column(c) for c in ("position", "entry", "salt", "n", "bytes"))
    rows, pieces = batch.column("rows"), batch.column("pieces")
    for position, size in sorted(set(zip(positions.tolist(), sizes.tolist(), strict=True))):
        at = np.flatnonzero((positions == position) & (sizes == size))
        row = np.frombuffer(b"".join(rows[int(k)].as_py() for k in at), np.uint16).astype(np.int64)
        kind = next(t for t in _WIDTHS if np.dtype(t).itemsize == size)
        piece = np.frombuffer(b"".join(pieces[int(k)].as_py() for k in at), kind).astype(np.int64).reshape(len(row), width)
        yield position, np.repeat(entries[at], counts[at]), np.repeat(salts[at], counts[at]), row, piece


def _first_owners(numbered: DataFrame, books: np.ndarray) -> DataFrame:
    """Packs of all pieces under the first codebooks."""
    parts, _, width = books.shape

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("row").to_numpy()
            values = batch.column("v").flatten().to_numpy().reshape(len(number), parts, width)
            for position in range(parts):
                pieces = values[:, position]
                entry, _ = nearest(pieces, books[position])
                packs = _packed(position, entry, number >> BLOCK_BITS, np.ones(len(number), bool), number & (BLOCK_ROWS - 1), pieces)
                if packs is not None:
                    yield packs

    return numbered.select("row", "v").mapInArrow(pack, PACK)


def _reassigned(packs: DataFrame, books: np.ndarray) -> DataFrame:
    """Every owner's members under new codebooks: packs of those that stay, and of those that move to another entry."""
    width = books.shape[2]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for position, entry, salt, row, pieces in _members(batch, width):
                best, _ = nearest(pieces, books[position])
                out = _packed(position, best, salt, best != entry, row, pieces)
                if out is not None:
                    yield out

    return packs.mapInArrow(step, PACK)


def _coded(packs: DataFrame, books: np.ndarray) -> DataFrame:
    """Final entries and squared distances, packed by (salt, position, entry)."""
    width = books.shape[2]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for position, _, salt, row, pieces in _members(batch, width):
                best, error = nearest(pieces, books[position])
                order = np.lexsort((best, salt))
                best, salt, row, error = best[order], salt[order], row[order], error[order]
                first = np.concatenate([[0], np.flatnonzero((np.diff(salt) != 0) | (np.diff(best) != 0)) + 1])
                cuts = np.concatenate([first, [len(row)]])
                yield pa.record_batch(
                    [
                        pa.array(salt[first]), pa.array(np.full(len(first), position, np.int32)), pa.array(best[first].astype(np.int32)),
                        _blobs(row.astype(np.uint16), cuts), _blobs(error, cuts),
                    ],
                    names=["salt", "position", "entry", "rows", "errors"],
                )

    return packs.mapInArrow(step, CODE)


def _updated(books: np.ndarray, packs: DataFrame) -> np.ndarray:
    """Each entry as the floored mean of its resident members; entries without members stay."""
    width = books.shape[2]
    sums = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    new = books.copy()
    for row in packs.groupBy("position", "entry").agg(F.sum(F.col("n").cast("long")).alias("members"), *sums).collect():
        new[row.position, row.entry] = [int(row[f"s{k}"]) // row.members for k in range(width)]
    return new


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector; see the module's text."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors)
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most ``entries`` rows
    label = vectors.schema["label"].dataType
    result = T.StructType().add("vec_id", vectors.schema["vec_id"].dataType).add("label", label).add("code", "string").add("error", "long")
    if not seeds:
        empty = spark.createDataFrame([], result)
        return empty.select("vec_id", "code", "error", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    length = len(seeds[0].v)
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    first = [row.v for row in seeds if len(row.v) == length]
    width = length // parts
    books = np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    _narrow(books)

    numbered = kept.where(F.size("v") == length).withColumn("row", F.monotonically_increasing_id())
    numbered = staged(numbered, "vectors")
    owners = partitions_for(spark, numbered.count() * parts * (2 * width + 2))
    place = ["position", "entry", "salt"]

    state = staged(_first_owners(numbered, books).repartition(owners, *place), "owners")
    books = _updated(books, state)
    for _ in range(rounds - 1):
        step = staged(_reassigned(state, books), "reassigned")
        moved = staged(step.where("moved").repartition(owners, *place), "migrated")
        state = step.where("not moved").unionByName(moved)
        books = _updated(books, state)

    def assembled(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.column("row").to_numpy() & (BLOCK_ROWS - 1)
        code = np.zeros((BLOCK_ROWS, parts), np.uint8)
        error = np.zeros(BLOCK_ROWS, np.int64)
        for position, entry, at, far in zip(*(right.column(c).to_pylist() for c in ("position", "entry", "rows", "errors")), strict=True):
            at = np.frombuffer(at, np.uint16)
            code[at, position] = entry
            np.add.at(error, at, np.frombuffer(far, np.int64))
        digits = [code[k].tobytes().hex() for k in rows]
        return pa.table({"vec_id": left.column("vec_id"), "label": left.column("label"), "code": pa.array(digits, pa.string()), "error": pa.array(error[rows])})

    block = F.shiftright("row", BLOCK_BITS)
    ids = numbered.select(block.alias("salt"), "row", "vec_id", "label").groupBy("salt")
    coded = ids.cogroup(_coded(state, books).groupBy("salt")).applyInArrow(assembled, result)
    coded = staged(coded, "codes")
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
