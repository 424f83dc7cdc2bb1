from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import llm_helpers as H
import numpy as np
import pytest

from ledgerloom.llm import divergence, resident_codes, staging

VECTORS = "vec_id long, embedding array<float>, label int, row long, salt string, code int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows], VECTORS).repartition(3)


def lloyd(rows, parts, entries, rounds):
    """The contract in plain Python integers: {(vec_id, components): (code, error)} and the codebooks' digest."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assigned():
        return [[min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e)) for p in range(parts)] for _, v, _ in kept]

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                members = [cut(v, p) for (_, v, _), code in zip(kept, found, strict=True) if code[p] == e]
                if members:
                    books[p][e] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    out = []
    for (i, v, label), code in zip(kept, assigned(), strict=True):
        out.append((i, label, "".join(f"{e:02x}" for e in code), sum(far(cut(v, p), books[p][e]) for p, e in enumerate(code))))
    sums = Counter()
    for _, label, _, error in out:
        sums[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((str(i), code, error, sums[label], digest) for i, label, code, error in out))


def found(frame):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in frame.collect())


def test_codes_match_plain_lloyd(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8)], int(i) % 3) for i in rng.permutation(300)]
    rows += [(1000 + k, rows[0][1], None) for k in range(150)]  # a third in one entry
    rows += [(7, rows[1][1], 2), (7, rows[1][1], 2), (None, rows[2][1], 1), (400, [0.5] * 8, 1), (401, [-0.5] * 8, 1)]
    rows += [(500, None, 1), (501, [1.0] * 7 + [None], 1), (502, [float("nan")] * 8, 1), (503, [float("inf")] + [0.0] * 7, 1)]
    rows += [(504, [0.1] * 4, 1), (505, [], 1)]
    want = lloyd([r for r in rows if r[0] not in (504, 505)], 4, 6, 3)
    assert found(resident_codes.vector_codes(vectors(spark, rows), parts=4, entries=6, rounds=3)) == want
    monkeypatch.setattr(resident_codes, "BLOCK_BITS", 4)  # many salts
    monkeypatch.setattr(resident_codes, "BLOCK_ROWS", 16)
    monkeypatch.setattr(resident_codes, "EXACT", 1)  # the path for large numbers
    assert found(resident_codes.vector_codes(vectors(spark, rows).coalesce(1), parts=4, entries=6, rounds=3)) == want


def test_only_changed_members_move(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in rng.normal(0, 0.3, 4)], 0) for k in range(200)]
    kept = resident_codes.kept_vectors(vectors(spark, rows)).withColumn("row", resident_codes.F.col("vec_id"))
    books = np.array([r[1] for r in rows[:5]], float)
    books = np.floor(256 * books).astype(np.int64).reshape(5, 2, 2).transpose(1, 0, 2).copy()
    first = staging.staged(resident_codes._first_owners(kept, books), "test")
    new = resident_codes._updated(books, first)
    step = resident_codes._reassigned(first, new).collect()
    entry = lambda v, p, book: int(resident_codes.nearest(np.floor(256 * np.array([np.float32(v)]))[:, 2 * p : 2 * p + 2].astype(np.int64), book[p])[0][0])
    changed = sum(entry(v, p, books) != entry(v, p, new) for _, v, _ in rows for p in (0, 1))
    assert changed and sum(r.n for r in step if r.moved) == changed and sum(r.n for r in step) == 400


def test_odd_tables_of_vectors(spark):
    assert resident_codes.vector_codes(vectors(spark, [])).count() == 0
    assert resident_codes.vector_codes(vectors(spark, [(1, None, 1)])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError, match="equal parts"):
        resident_codes.vector_codes(vectors(spark, [(1, [1.0, 2.0, 3.0], 1)]), parts=2)
    one = resident_codes.vector_codes(vectors(spark, [(1, [0.0] * 16, 1)])).collect()
    assert [(r.code, r.error) for r in one] == [("00" * 16, 0)]


def audited(rows, least, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        key = (lang or "", source or "")
        groups.add(key)
        words = term.findall((text or "").translate(H.LOWER))
        counts[key].update(words)
        docs[key[0]].update(set(words))
    out = set()
    for lang in {k[0] for k in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        mine = sorted(k for k in groups if k[0] == lang)

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {k: shares(counts[k]) for k in mine}
        q = shares(sum((counts[k] for k in mine), Counter()))
        for k in mine:
            pairs = [(-sum(abs(p[k][t] - p[o][t]) for t in kept), o[1].encode()) for o in mine if o != k]
            terms = [(q[t] - p[k][t], t.encode()) for t in kept if counts[k][t] and p[k][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                out |= {(*k, part, item.decode(), -value, rank + 1) for rank, (value, item) in enumerate(sorted(found)[:limit])}
    return out


def corpus():
    rows = [("en", f"s{k % 5}", H.prose(k % 17, 40) + " Alpha alpha ÄRGER x1y") for k in range(60)]
    rows += [("en", "s0", H.prose(3, 30))] * 40 + [("de", f"s{k % 2}", H.prose(100 + k % 3, 25)) for k in range(12)]
    rows += [("en", "empty", None), ("en", None, "alpha"), (None, "s1", "beta beta"), (None, None, ""), ("fr", "only", "éa éa"), ("en", "digits", "1 2 3")]
    return rows


def test_divergence_matches_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "lang string, source string, text string, term long, item string, n int").repartition(3)
    got = lambda: {tuple(r) for r in divergence.source_divergence(docs, 5, 7).collect()}
    want = audited(rows, 5, 7)
    assert got() == want and len(want) > 60
    monkeypatch.setattr(divergence, "BLOCK_CELLS", (20, 20))  # many blocks of terms
    monkeypatch.setattr(divergence, "RUN_POSTINGS", 3)
    assert got() == want


def test_divergence_without_kept_terms_or_rows(spark):
    docs = spark.createDataFrame([("en", "a", "one"), ("en", "b", "two")], "lang string, source string, text string")
    got = sorted(tuple(r) for r in divergence.source_divergence(docs).collect())
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.source_divergence(docs.limit(0)).count() == 0


def test_shares_are_exact_for_huge_counts(spark):
    n, total, terms = 10**17 + 12345, 9 * 10**17 + 77, 10**6
    got = spark.range(1).select(divergence._share(f"{n}L", f"{total}L", f"{terms}L").alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (n + 5) // (total + 5 * terms)


def test_temporary_folders_go(spark, tmp_path):
    before = set(tmp_path.iterdir())
    with staging.temporary(spark):
        frame = staging.staged(spark.range(3), "gone")
        assert frame.count() == 3
        folder = frame.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    import os

    assert not os.path.exists(folder) and set(tmp_path.iterdir()) == before
