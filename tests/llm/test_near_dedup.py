from __future__ import annotations

import random

import numpy as np
import llm_helpers as H

from ledgerloom.llm import odd_sketch
from ledgerloom.llm.links import components


def shingles(text, width):
    w = H.words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, width, percent):
    """Component (smallest id) per row index, over all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                root[find(a)] = find(b)
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(k), []).append(doc_id)
    low = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return [(d, len(sets[k]), low[find(k)] if sets[k] else d) for k, (d, _) in enumerate(rows)]


def near_copies():
    """A text, heavily and lightly changed copies of it, and a chain in which only neighbours are alike."""
    rnd = random.Random(5)
    base = H.prose(77, 120).split()
    rows = []
    for k in range(60):
        copy = list(base)
        for _ in range(rnd.randint(1, 9)):
            copy[rnd.randrange(len(copy))] = f"w{rnd.randrange(10**6)}"
        rows.append((100 + k, " ".join(copy)))
    step = list(base[:100])
    for k in range(12):
        rows.append((300 - k, " ".join(step)))
        step = step[4:] + [f"n{k}a", f"n{k}b", f"n{k}c", f"n{k}d"]
    return rows


def test_matches_all_pairs_and_awkward_rows(spark):
    rows = H.AWKWARD + near_copies()
    got = odd_sketch.near_duplicates(H.documents(spark, rows), 2, 80).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute(rows, 2, 80), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def large_groups():
    """Near copies of one text by the hundred, and a group whose members lie just under the threshold pairwise."""
    rnd = random.Random(11)
    base, other = H.prose(5, 60).split(), H.prose(6, 60).split()
    rows = []
    for k in range(300):
        copy = list(base)
        copy[rnd.randrange(60)] = f"own{k}"
        rows.append((1000 + k, " ".join(copy)))
    for k in range(160):  # two changed words each: 61 - 4 of 61 shingles, and about 52 / 66 of them in common
        copy = list(other)
        for at in rnd.sample(range(2, 58, 3), 3):
            copy[at] = f"else{k}x{at}"
        rows.append((3000 + k, " ".join(copy)))
    return rows


def test_large_groups_match_all_pairs_and_stay_linear(spark, monkeypatch):
    rows = large_groups() + near_copies()
    key = lambda r: tuple(str(x) for x in r)
    expected = sorted(brute(rows, 2, 80), key=key)
    seen = []
    staged = odd_sketch.staged
    monkeypatch.setattr(odd_sketch, "staged", lambda df, label: (seen.append((label, out := staged(df, label))), out)[1])
    for block, dense in ((1000, 4), (37, 4), (37, 0)):
        monkeypatch.setattr(odd_sketch, "BLOCK", block)
        monkeypatch.setattr(odd_sketch, "DENSE", dense)
        seen.clear()
        got = odd_sketch.near_duplicates(H.documents(spark, rows), 2, 80).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == expected
        if block == 1000:  # buckets of one block: no more rows than go in
            assert sum(df.count() for label, df in seen if label == "likely") <= 4 * 48 * len(rows)
        assert dense or any(df.where("b is null").count() for label, df in seen if label == "likely")


def test_forest_joins_what_all_pairs_join():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**62, 100)
    sets = [np.unique(np.concatenate([np.delete(base, rng.integers(0, 100, 6)), rng.integers(0, 2**62, 6)])) for _ in range(60)]
    root = np.arange(60) // 2 * 2
    for sides in (np.zeros(60, int), np.arange(60) % 2):
        table = pa.table({"rid": np.arange(60), "root": root, "side": sides, "shingles": [s.tolist() for s in sets]})
        links = odd_sketch._forest(80)(table).to_pylist()
        parent = {int(r): int(r) for r in root}

        def top(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a in range(60):
            for b in range(a):
                common = len(np.intersect1d(sets[a], sets[b]))
                if (sides.max() == 0 or sides[a] != sides[b]) and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    parent[top(int(root[a]))] = top(int(root[b]))
        groups = len({top(int(r)) for r in root})
        assert len(links) == len(set(root.tolist())) - groups  # a forest: one link for each join
        assert all(top(int(root[x["a"]])) == top(int(root[x["b"]])) for x in links)


def test_deduplicated_keeps_one_row_of_each_group_and_all_columns(spark):
    rows = [(5, "a b c d e f g"), (3, "A b c d e f g"), (9, "other words stand here alone now"), (9, "other words stand here alone now"), (11, None), (12, "")]
    kept = odd_sketch.deduplicated(H.documents(spark, rows), 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 9, 11, 12]
    assert kept.columns == H.documents(spark, rows).columns
    clashing = H.documents(spark, rows).selectExpr("*", "1 as stay_id", "2 as Stay_Key", "3 as text_key", "4 as __stay_id")
    assert odd_sketch.deduplicated(clashing, 5, 80).columns == clashing.columns
    assert odd_sketch.deduplicated(clashing, 5, 80).count() == 4


def test_empty_table(spark):
    assert odd_sketch.near_duplicates(H.documents(spark, [])).count() == 0


def test_estimates_stay_within_their_margin():
    rng = np.random.default_rng(8)
    for size, margin in ((60, odd_sketch.MARGIN_WHOLE), (900, odd_sketch.MARGIN_WHOLE), (6000, odd_sketch.MARGIN_SAMPLED)):
        for _ in range(60):
            pool = rng.integers(0, 2**63, size + size // 4, dtype=np.uint64)
            a, b = np.unique(pool[: len(pool) * 9 // 10]), np.unique(pool[len(pool) // 10 :])
            common = len(np.intersect1d(a, b))
            differing = int(np.bitwise_count(odd_sketch.odd_sketch(a) ^ odd_sketch.odd_sketch(b)).sum())
            guess = odd_sketch._similarity(differing, float(len(a)), float(len(b)), np.minimum, np.maximum, np.log1p)
            assert abs(guess - common / (len(a) + len(b) - common)) < margin


def test_components_of_paths_stars_and_cycles(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{100 + k: 100 for k in range(1, 30)}, 201: 200, 202: 200}
