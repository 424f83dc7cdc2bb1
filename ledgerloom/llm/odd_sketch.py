"""Near-duplicate documents by MinHash bands, odd-sketch estimates and exact confirmation.

A text is the set of its distinct word shingles. ``BANDS * ROWS`` MinHash values are drawn from it by as many
permutations; texts that agree on all rows of a band meet in that band's bucket. The ``SAMPLE`` smallest
shingle hashes (the bottom-k form of MinHash samples; the whole set, if it is no larger) are folded into one
parity bitmap, the odd sketch: each sample flips one bit. The XOR of two sketches has one bit for each sample
that only one text has (up to collisions, which the estimator undoes), so its population count gives the
similarity of a pair that met, from 256 bytes and without the sets. Pairs whose estimate is near or above
the threshold are confirmed on their full sets.

A pair at similarity 0.8 misses all 48 bands of 6 rows with probability 5e-7. Its estimate has a standard
deviation of about 0.006 for sets up to ``SAMPLE`` and 0.017 beyond; pairs are confirmed down to ``MARGIN_WHOLE`` or
``MARGIN_SAMPLED`` below the threshold, five deviations and more.

Buckets are never expanded into all their pairs:

1. Equal sets are one class, represented by the row with the smallest doc_id.
2. Every class is tried against one leader of each of its buckets; the leader with the best estimate is
   confirmed. A group of near copies thereby falls together at a cost linear in its size.
3. Only buckets that still hold several components are searched, and only across components, which are run to the end
   before each search. Members of the bucket's largest component are laid against the others alone; the others are cut into
   blocks, by number and by size, and each pair of blocks is one task's work. First the best-looking pair of
   each two components is confirmed, which joins what belongs together. Then every likely pair that is still across
   components is confirmed, so no link is left out. Where a task finds more than ``DENSE`` likely pairs a row (a group whose
   members lie just under the threshold, say), it passes on its rows instead of its pairs: their full sets meet in one task,
   which counts the intersections and gives a spanning forest of the links, less than one link a row.

Defined results: a null, empty or blank text has an empty set (size 0) and is linked with nothing; fewer words
than a shingle make one shingle of all words. Rows that repeat a doc_id are judged by their own texts.
A null doc_id takes part; its component is the smallest id that is not null (null if there is none). Other columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.links import components
from ledgerloom.llm.staging import free_names, staged
from ledgerloom.llm.text import hashed_words, mix, row_ranges

BANDS, ROWS = 48, 6
SAMPLE = 1024
SKETCH_BITS = 2048
MARGIN_WHOLE, MARGIN_SAMPLED = 0.035, 0.1
BLOCK = 1000  # rows of a block
BLOCK_SHINGLES = 1 << 20  # and shingles, as far as single rows allow
DENSE = 4
_PERMUTATIONS = BANDS * ROWS
_WORDS = SKETCH_BITS // 64
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(7001))
_MULTIPLY = (_rng.integers(0, 2**31, _PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_FLIP = _rng.integers(0, 2**32, _PERMUTATIONS, dtype=np.uint32)[:, None]
_STEPS = _rng.integers(0, 2**62, 64, dtype=np.uint64) * _U(2) + _U(1)
_CHUNK = 1024  # shingles hashed at once, so that the working set stays in the processor's cache


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle numbers of each text, in order."""
    for first, last, words, rows, _ in hashed_words(texts):
        bounds = row_ranges(rows, last - first)
        grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            grams += words[k : k + len(grams)] * _STEPS[k]
        grams = mix(grams)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo >= width:
                yield np.unique(grams[lo : hi - width + 1])
            elif hi > lo:
                short = np.append(words[lo:hi], _U(hi - lo)) * np.append(_STEPS[: hi - lo], _STEPS[63])
                yield mix(short.sum(keepdims=True, dtype=np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def least_values(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of the permutations of 32-bit numbers."""
    low = shingles.astype(np.uint32)
    least = np.full(_PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), _CHUNK):
        np.minimum(least, ((low[None, at : at + _CHUNK] ^ _FLIP) * _MULTIPLY).min(axis=1), out=least)
    return least


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of the smallest SAMPLE hashes of a sorted set, as 64-bit words."""
    at = (mix(shingles[:SAMPLE]) & _U(SKETCH_BITS - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    values = least.astype(np.uint64).reshape(-1, BANDS, ROWS)
    keys = (values * _STEPS[None, None, :ROWS]).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)[None, :] * _STEPS[ROWS]
    return mix(keys)


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, values.shape[1], dtype=np.int32)), flat)


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches, drawn = [], [], [], []
            for shingles in shingle_sets(batch.column(1), width):
                sizes.append(len(shingles))
                digests.append(blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                sketches.append(odd_sketch(shingles))
                drawn.append(least_values(shingles))
            if not sizes:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    _lists(np.stack(sketches)), _lists(band_keys(np.stack(drawn))),
                ],
                ["doc_id", "text_key", "n", "digest", "sketch", "keys"],
            )

    return run


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(rid, doc_id, text_key, n, digest, sketch, keys) per document, written once; ``rid`` numbers the rows."""
    schema = "doc_id long, text_key long, n long, digest binary, sketch array<long>, keys array<long>"
    signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    signed = signed.mapInArrow(_sign(width), schema)
    return staged(signed.withColumn("rid", F.monotonically_increasing_id()), "signatures")


def _similarity(differing, n_a, n_b, least, most, log1p):
    """Jaccard estimate and its margin from the XOR's population count and the set sizes.

    The count undoes to the number d of samples on one side only. The two samples share (k_a + k_b - d) / 2
    hashes; they cover the smaller of the two sampled shares of the intersection.
    """
    d = log1p(-least(0.999, 2.0 * differing / SKETCH_BITS)) * (-SKETCH_BITS / 2.0)
    k_a, k_b = least(n_a, SAMPLE), least(n_b, SAMPLE)
    common = (k_a + k_b - d) / 2.0 * most(n_a / k_a, n_b / k_b)
    return common / (n_a + n_b - common)


def _estimate():
    differing = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(_WORDS)), start=F.lit(0))
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return _similarity(
        differing, F.col("n_a").cast("double"), F.col("n_b").cast("double"),
        lambda x, y: F.least(as_column(x), as_column(y)), F.greatest, F.log1p,
    )


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, kept = [], []
            for rid, digest, shingles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2), width)):
                # a doc_id that repeats with another text brings that text along; its digest gives it away
                if blake2b(shingles.tobytes(), digest_size=16).digest() == digest:
                    rids.append(rid)
                    kept.append(shingles)
            if kept:
                bounds = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
                flat = pa.array(np.concatenate(kept).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rids, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), flat)], ["rid", "shingles"]
                )

    return run


def _full_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(rid, shingles) of the rows ``wanted`` (rid)."""
    wanted = wanted.distinct().join(classes, "rid").select("rid", "digest", F.col("doc_id").alias("wanted_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("rid", "digest", "text")
    return staged(found.mapInArrow(_sets(width), "rid long, shingles array<long>").dropDuplicates(["rid"]), "sets")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b: row numbers) with 100 * intersection >= percent * union, on full sets."""
    pairs = staged(pairs.select("a", "b").distinct(), "pairs")
    sets = _full_sets(pairs.select(F.col("a").alias("rid")).union(pairs.select("b")), classes, docs, width)
    left = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(left, "a").join(right, "b")
    joined = joined.select("a", "b", F.size(F.array_intersect("x", "y")).alias("i"), (F.size("x") + F.size("y")).alias("s"))
    return staged(joined.where(F.col("i") * 100 >= (F.col("s") - F.col("i")) * percent).select("a", "b"), "confirmed")


def _forest(percent: int):
    def run(group: pa.Table) -> pa.Table:
        """Links between the rows of one dense task, as a spanning forest over the components that they are in already."""
        group = group.sort_by("rid")
        rid, root, side = (group[c].to_numpy() for c in ("rid", "root", "side"))
        sets = group["shingles"].combine_chunks()
        sizes = sets.value_lengths().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(rid)), sizes)
        kinds, which = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        by_kind = np.argsort(which, kind="stable")
        begins, holders = np.searchsorted(which[by_kind], np.arange(len(kinds) + 1)), owner[by_kind]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        two_sides = side.min() < side.max()
        tree: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := tree.get(x, x)) != x:
                tree[x] = tree.get(up, up)
                x = up
            return x

        links = []
        for at in range(len(rid)):
            if two_sides and side[at]:
                continue
            mine = which[bounds[at] : bounds[at + 1]]
            common = np.zeros(len(rid), np.int64)
            for kind in mine:
                common[holders[begins[kind] : begins[kind + 1]]] += 1
            linked = (root != root[at]) & (100 * common >= percent * (sizes + sizes[at] - common))
            if two_sides:
                linked &= side == 1
            else:
                linked[: at + 1] = False
            for other in np.flatnonzero(linked).tolist():
                x, y = top(int(root[at])), top(int(root[other]))
                if x != y:
                    tree[max(x, y)] = min(x, y)
                    links.append((int(rid[at]), int(rid[other])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _likely(percent: int):
    """Sizes that allow the threshold at all, and an estimate not clearly below it."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    margin = F.when(F.greatest("n_a", "n_b") <= SAMPLE, MARGIN_WHOLE).otherwise(MARGIN_SAMPLED)
    return sizes & (_estimate() >= percent / 100 - margin)


def _to_leaders(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Every class with the best-looking of the leaders of its buckets."""
    tries = members.where("rid <> leader").select(F.col("rid").alias("a"), F.col("leader").alias("b")).distinct()
    sketches = classes.select("rid", "n", "sketch")
    tries = tries.join(sketches.toDF("a", "n_a", "sketch_a"), "a").join(sketches.toDF("b", "n_b", "sketch_b"), "b")
    likely = tries.where(_likely(percent)).select("a", "b", _estimate().alias("e"))
    return likely.groupBy("a").agg(F.max_by("b", F.struct("e", "b")).alias("b"))


def _across(percent: int, best: bool):
    low = percent / 100

    def run(group: pa.Table) -> pa.Table:
        """Likely pairs of one block, or of two blocks, that lie in different components.

        ``best`` keeps the best-looking pair of each two components. Otherwise every likely pair is
        given, once: in the first bucket that both texts share. Of very many pairs only the rows are given, as pairs
        without a second row.
        """
        order = np.lexsort((group["rid"].to_numpy(), group["side"].to_numpy()))
        rid, root, size, side = (group[c].to_numpy()[order] for c in ("rid", "root", "n", "side"))
        sketch = np.frombuffer(group["sketch"].combine_chunks().flatten().to_numpy(), np.uint64).reshape(-1, _WORDS)[order]
        keys = group["keys"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)[order]
        here = group["key"][0].as_py()
        cut = int(np.searchsorted(side, 1))
        found = []
        for at in range(cut if cut < len(rid) else len(rid)):
            rest = slice(cut, None) if cut < len(rid) else slice(at + 1, None)
            other = np.flatnonzero((root[rest] != root[at]) & (100 * np.minimum(size[rest], size[at]) >= percent * np.maximum(size[rest], size[at])))
            other = other + rest.start
            differing = np.bitwise_count(sketch[other] ^ sketch[at]).sum(axis=1, dtype=np.int64)
            alike = _similarity(differing, float(size[at]), size[other], np.minimum, np.maximum, np.log1p)
            margin = np.where(np.maximum(size[other], size[at]) <= SAMPLE, MARGIN_WHOLE, MARGIN_SAMPLED)
            likely = alike >= low - margin
            other, alike = other[likely], alike[likely]
            if best and len(other):
                ranked = np.argsort(-alike, kind="stable")
                ranked = ranked[np.unique(root[other[ranked]], return_index=True)[1]]
                other, alike = other[ranked], alike[ranked]
            elif len(other):
                shared = keys[other] == keys[at]
                first = keys[at][shared.argmax(axis=1)] == here
                other, alike = other[first], alike[first]
            if len(other):
                found.append((np.full(len(other), at), other, alike))
        if not found:
            return pa.table({c: pa.array([], t) for c, t in _PAIR.items()})
        a, b, alike = (np.concatenate(x) for x in zip(*found))
        lower, upper = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if best:
            ranked = np.lexsort((-alike, upper, lower))
            new = np.ones(len(ranked), bool)
            new[1:] = (np.diff(lower[ranked]) != 0) | (np.diff(upper[ranked]) != 0)
            keep = ranked[new]
            a, b, alike, lower, upper = a[keep], b[keep], alike[keep], lower[keep], upper[keep]
        if not best and len(a) > DENSE * len(rid):
            used = np.unique(np.concatenate([a, b]))
            task = [np.full(len(used), group[c][0].as_py()) for c in _TASK]
            columns = (rid[used], [None] * len(used), [None] * len(used), root[used], side[used], *task)
        else:
            columns = (np.minimum(rid[a], rid[b]), np.maximum(rid[a], rid[b]), alike, lower, upper, *[[None] * len(a)] * len(_TASK))
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(_PAIR.items(), columns)})

    return run


_TASK = ["key", "kind", "p", "q"]
_PAIR = {
    "a": pa.int64(), "b": pa.int64(), "e": pa.float64(), "lower": pa.int64(), "upper": pa.int64(),
    "key": pa.int64(), "kind": pa.int32(), "p": pa.int32(), "q": pa.int32(),
}


_PAIR_SCHEMA = "a long, b long, e double, lower long, upper long, key long, kind int, p int, q int"


def _tasks(members: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component, dealt to the tasks (key, kind, p, q) that compare them.

    Kind 0 compares blocks p and q of the rows outside the largest component; kind 1 compares part p of that component with
    block q of the others. So a bucket costs its largest component only once for each block of the others.
    """
    placed = members.join(roots.toDF("rid", "found_root"), "rid", "left")
    placed = staged(placed.select("key", "rid", "n", F.coalesce("found_root", "rid").alias("root")), "placed")
    # each row counts for its part of a full block, by number or by shingles
    parts = placed.groupBy("key", "root").agg(F.sum(F.greatest(F.lit(1 / BLOCK), F.col("n") / BLOCK_SHINGLES)).alias("weight"))
    still_open = parts.groupBy("key").agg(F.max(F.struct("weight", "root")).alias("main"), F.sum("weight").alias("weight"), F.count("*").alias("components"))
    blocks = lambda c: F.greatest(F.ceil(c - 1e-9), F.lit(1)).cast("int")
    still_open = still_open.where("components > 1").select(
        "key", F.col("main.root").alias("main"), blocks(F.col("main.weight")).alias("main_parts"), blocks(F.col("weight") - F.col("main.weight")).alias("blocks")
    )
    rows = placed.join(staged(still_open, "open-buckets"), "key").join(classes.select("rid", "sketch", "keys"), "rid")
    in_main = F.col("root") == F.col("main")
    block = F.pmod(F.xxhash64("rid"), F.when(in_main, F.col("main_parts")).otherwise(F.col("blocks"))).cast("int")
    rows = rows.withColumn("block", block)
    # p and q are packed with the kind and the side, so that one explode deals a row to all of its tasks
    task = lambda kind, p, q, side: F.struct(F.lit(kind).alias("kind"), p.alias("p"), q.alias("q"), side.cast("int").alias("side"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    at = F.col("block")
    as_main = F.transform(upto(F.col("blocks")), lambda q: task(1, at, q, F.lit(1)))
    as_other = F.transform(upto(F.col("blocks")), lambda q: task(0, F.least(at, q), F.greatest(at, q), at > q))
    against = F.transform(upto(F.col("main_parts")), lambda p: task(1, p, at, F.lit(0)))
    rows = rows.withColumn("task", F.explode(F.when(in_main, as_main).otherwise(F.concat(as_other, against))))
    return rows.select("key", "task.*", "rid", "root", "n", "sketch", "keys")


def _best_links(rows: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links among the best-looking pairs of each two components that meet in a bucket."""
    pairs = rows.groupBy(*_TASK).applyInArrow(_across(percent, True), _PAIR_SCHEMA)
    pairs = pairs.groupBy("lower", "upper").agg(F.max_by(F.struct("a", "b"), F.struct("e", "a", "b")).alias("pair")).select("pair.*")
    return confirmed(pairs, classes, docs, width, percent)


def _all_links(rows: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links that join all components which any link across them joins."""
    found = staged(rows.groupBy(*_TASK).applyInArrow(_across(percent, False), _PAIR_SCHEMA), "likely")
    dense = found.where("b is null").select(F.col("a").alias("rid"), F.col("lower").alias("root"), F.col("upper").cast("int").alias("side"), *_TASK)
    sets = _full_sets(dense.select("rid"), classes, docs, width)
    forest = dense.join(sets, "rid").groupBy(*_TASK).applyInArrow(_forest(percent), "a long, b long")
    return confirmed(found.where("b is not null"), classes, docs, width, percent).unionByName(staged(forest, "forest"))


def _judged(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, text_key, digest, n, component_id, root) per row; digest, component_id and root are null for empty sets."""
    signed = signatures(docs, width)
    first = signed.where("digest is not null").groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("f"))
    first = staged(first.select("digest", F.col("f.rid").alias("class"), F.col("f.doc_id").alias("class_id")), "classes")
    classes = staged(signed.join(first.select(F.col("class").alias("rid")), "rid", "left_semi"), "class-signatures")

    keyed = classes.select("rid", "n", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("members"), F.min(F.struct(F.xxhash64("rid", "key"), "rid")).alias("l"))
    buckets = staged(buckets.where("members > 1").select("key", F.col("l.rid").alias("leader")), "buckets")
    members = staged(keyed.join(buckets, "key"), "members")

    links = confirmed(_to_leaders(members, classes, percent), classes, docs, width, percent)
    roots = staged(components(links), "roots")
    for search in (_best_links, _all_links):
        links = links.unionByName(search(_tasks(members, classes, roots), classes, docs, width, percent))
        roots = staged(components(links), "roots")

    placed = first.join(roots.toDF("class", "root"), "class", "left").select("digest", "class_id", F.coalesce("root", "class").alias("root"))
    placed = staged(placed, "placed-classes")
    lowest = placed.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = staged(placed.join(lowest, "root").select("digest", "root", "component_id"), "components")
    return signed.select("doc_id", "text_key", "n", "digest").join(named, "digest", "left")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Two rows are linked if their sets of ``width``-word shingles have at least ``percent`` hundredths in
    common. ``component_id`` is the smallest doc_id reachable over links; a row is kept if that is its own.
    """
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return _judged(docs, width, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group, that with the smallest doc_id; all columns kept.

    Texts with an empty set are in no group and stay. Rows that repeat both doc_id and text stay once. Among rows
    of one group that repeat the smallest doc_id with different texts, the hash of the text decides.
    """
    judged = _judged(docs, width, percent)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = judged.where("root is not null").groupBy("root").agg(F.min(order).alias("f")).select("f.doc_id", "f.text_key")
    stay_id, stay_key, text_key = free_names(docs, "stay_id", "stay_key", "text_key")
    stay = first.unionByName(judged.where("root is null").select("doc_id", "text_key")).toDF(stay_id, stay_key)
    marked = docs.withColumn(text_key, F.xxhash64("text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(stay_id)) & (F.col(text_key) == F.col(stay_key))
    return marked.join(stay, same, "left_semi").dropDuplicates(["doc_id", text_key]).drop(text_key)
