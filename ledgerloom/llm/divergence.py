"""Divergence of the sources of a language, by Gustavson row accumulation over a term-major index.

Groups are (lang, source). A term's smoothed share in a group is p = 1 + floor(10^9 (count + 5) / (N + 5 V)), so a term
that a group lacks has the group's baseline share z, that of a count of zero. The distance of two groups sums
|p - q| over all kept terms of the language. Most terms are missing in most groups, hence

    distance(g, o) = V |z_g - z_o|  +  S(g, z_o)  +  S(o, z_g)  +  C(g, o)

where S(g, z) sums |p_g - z| - |z_g - z| over the terms of g, as if the peer had none of them, and C corrects the
terms that both have: |p_g - p_o| - |p_g - z_o| - |z_g - p_o| + |z_g - z_o|. C is the sparse part: the cells
(term, group, p) are dealt by blocks of terms; inside a block the rows of the term-major index are laid
end to end, and each group walks its own terms, scattering every posting it meets into one dense array with a place
per peer. A task so returns one number per pair of groups that meet in its block, and no pair of
postings is ever a row. S needs only how often a group has each share.

Term counts come from whole texts: a batch is cut into terms on its UTF-8 bytes, encoded against its own dictionary
and counted per group before anything is shuffled. Blocks of terms are cut from the number of cells, so a language or
source with a third of all rows is spread like the rest. All numbers are exact integers (shares by decimal division).

Defined results: a null text, lang or source is ''. A group whose texts hold no kept term has N = 0 and the
baseline share for all terms; with V = 0 all distances are 0 and there are no term rows. A language with one source
has no pair rows. Repeated rows count as often as they occur; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged
from ledgerloom.llm.text import buffers, slices, word_bounds

MIN_DOCUMENTS = 30
TOP_TERMS = 50
SMOOTHING = 5
SHARES = 1_000_000_000
BLOCK_CELLS = (1 << 16, 1 << 21)  # of a task: at least the pairs of groups that it may answer with, within these bounds
RUN_POSTINGS = 1 << 18  # postings in one vector step
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
COUNTS = "lang string, source string, term string, n long, docs long"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of a run of texts and the row that holds each."""
    starts, stops, rows = word_bounds(data, offsets, ~_LETTER)
    letters = np.ascontiguousarray(_LOWER[data[_LETTER[data]]])
    ends = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_utf8(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]), rows


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, sources = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        data, offsets = buffers(batch.column("text"))
        for first, last in slices(offsets):
            lo, hi = offsets[first], offsets[last]
            terms, rows = _terms(data[lo:hi], offsets[first : last + 1] - lo)
            if not len(terms):
                continue
            coded = pc.dictionary_encode(terms)
            size = len(coded.dictionary)
            index = coded.indices.to_numpy().astype(np.int64)
            cells, n = np.unique(rows * size + index, return_counts=True)  # one per document and term
            keys, at = np.unique(group[first:last][cells // size] * size + cells % size, return_inverse=True)
            of_group, of_term = keys // size, keys % size
            yield pa.record_batch(
                [
                    langs.dictionary.take(pa.array(of_group // len(sources.dictionary))),
                    sources.dictionary.take(pa.array(of_group % len(sources.dictionary))),
                    coded.dictionary.take(pa.array(of_term)).cast(pa.utf8()),
                    pa.array(np.bincount(at, n, len(keys)).astype(np.int64)),
                    pa.array(np.bincount(at, minlength=len(keys)).astype(np.int64)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def _share(count: str, total: str, terms: str) -> F.Column:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), exact for any counts."""
    over = f"cast({SHARES} as decimal(10,0)) * cast({count} + {SMOOTHING} as decimal(20,0))"
    return F.expr(f"1 + ({over}) div cast({total} + {SMOOTHING} * {terms} as decimal(20,0))")


def term_statistics(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """``groups`` (lang, source, total, terms, z) and ``cells`` (lang, source, term, n, p, z, q) of the kept terms."""
    texts = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = texts.mapInArrow(_counted, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = staged(counts, "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = staged(kept.where(F.col("docs") >= min_documents).drop("docs"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    cells = counts.drop("docs").join(kept, ["lang", "term"])
    cells = staged(cells, "term-cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("total", "terms", "lang_total")))
    z = F.when(F.col("terms") > 0, _share("0", "total", "terms")).otherwise(0)
    groups = staged(groups.withColumn("z", z), "term-groups")
    cells = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", _share("n", "total", "terms").alias("p"), "z", _share("lang_n", "lang_total", "terms").alias("q")
    )
    return groups, cells


PAIR = "lang string, source string, item string, part long"


def _accumulated(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
    """Corrections of all ordered pairs of groups that share a term of the block."""
    groups = pc.dictionary_encode(block.column("source").combine_chunks())
    terms = pc.dictionary_encode(block.column("term").combine_chunks())
    names = groups.dictionary
    g, t = groups.indices.to_numpy().astype(np.int64), terms.indices.to_numpy().astype(np.int64)
    p, z = block.column("p").to_numpy(), block.column("z").to_numpy()
    by_term = np.argsort(t, kind="stable")  # the term-major index: postings of each term side by side
    begins = np.searchsorted(t[by_term], np.arange(len(terms.dictionary) + 1))
    post_g, post_p, post_z = g[by_term], p[by_term], z[by_term]
    by_group = np.argsort(g, kind="stable")
    bounds = np.searchsorted(g[by_group], np.arange(len(names) + 1))
    out = []
    for own in range(len(names)):
        mine = by_group[bounds[own] : bounds[own + 1]]
        dense, met = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        lengths = begins[t[mine] + 1] - begins[t[mine]]
        ends = np.cumsum(lengths)
        cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + RUN_POSTINGS, RUN_POSTINGS)).clip(0, len(mine)))
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            part = slice(first, last)
            n = lengths[part]
            at = np.repeat(begins[t[mine[part]]] - (ends[part] - n - (ends[first] - n[0])), n) + np.arange(n.sum())
            p_own, z_own = np.repeat(p[mine[part]], n), z[mine[0]]
            peer, q, y = post_g[at], post_p[at], post_z[at]
            np.add.at(dense, peer, np.abs(p_own - q) - np.abs(p_own - y) - np.abs(z_own - q) + np.abs(z_own - y))
            met[peer] = True
        met[own] = False
        peers = np.flatnonzero(met)
        out.append(
            pa.table({
                "lang": pa.array([key[0].as_py()] * len(peers), pa.string()), "source": names.take(pa.array(np.full(len(peers), own))),
                "item": names.take(pa.array(peers)), "part": pa.array(dense[peers]),
            })
        )
    return pa.concat_tables(out)


def _baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """V |z_g - z_o| / 2 twice and S(g, z_o) for both directions of every pair (g, o); one group's peers at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            name, z, terms = (batch.column(c)[k].as_py() for c in ("source", "z", "terms"))
            found, around = batch.column("shares")[k].values, batch.column("peers")[k].values
            shares, times = (np.zeros(0, np.int64) if found is None else found.field(c).to_numpy() for c in ("p", "times"))
            order = np.argsort(shares)
            shares, times = shares[order], times[order]
            upto_n, upto_p = np.concatenate([[0], np.cumsum(times)]), np.concatenate([[0], np.cumsum(times * shares)])
            around = around.filter(pc.not_equal(around.field("source"), name))
            y = around.field("z").to_numpy()
            below = np.searchsorted(shares, y)
            n_low, p_low = upto_n[below], upto_p[below]
            alone = (upto_p[-1] - p_low) - (upto_n[-1] - n_low) * y + n_low * y - p_low - upto_n[-1] * np.abs(z - y)
            peers = around.field("source")
            own = pa.array([name] * len(peers), pa.string())
            lang = pa.array([batch.column("lang")[k].as_py()] * len(peers), pa.string())
            columns = ["lang", "source", "item", "part"]
            yield pa.record_batch([lang, own, peers, pa.array(alone + terms * np.abs(z - y))], names=columns)
            yield pa.record_batch([lang, peers, own, pa.array(alone)], names=columns)


def pair_distances(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two different sources of a language, in both orders."""
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    blocks = -(-cells.count() // min(max(most * most, BLOCK_CELLS[0]), BLOCK_CELLS[1])) or 1
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block")
    shared = cells.select("lang", block, "source", "term", "p", "z").groupBy("lang", "block").applyInArrow(_accumulated, PAIR)
    # Distinct shares of a group and the baselines of a language's groups: the size of one row of the result's matrix.
    shares = cells.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    shares = shares.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "times")).alias("shares"))
    peers = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "z")).alias("peers"))
    rows = groups.select("lang", "source", "z", "terms").join(shares, ["lang", "source"], "left").join(peers, "lang")
    alone = rows.mapInArrow(_baselines, PAIR)
    return shared.unionByName(alone).groupBy("lang", "source", "item").agg(F.sum("part").alias("value"))


def term_excesses(cells: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): each group's terms with the largest share above the language's."""
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def source_divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): ranked distances to all peers, and the ``top`` most typical terms."""
    groups, cells = term_statistics(docs, min_documents)
    cells = staged(cells, "term-shares")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = staged(pair_distances(groups, cells), "pair-distances").withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(term_excesses(cells, top).withColumn("part", F.lit("term")).select(columns))
