from __future__ import annotations

import random
from itertools import combinations

import llm_helpers as H
import numpy as np

from ledgerloom.llm import chunk_dedup, spaced_seed


def test_gear_hash_depends_on_its_window_only():
    data = np.random.default_rng(1).integers(0, 256, 500, dtype=np.uint8)
    whole = chunk_dedup.gear_hashes(data)
    for at in (16, 100, 499):
        part = data[at - chunk_dedup.GEAR_WINDOW + 1 : at + 1]
        expected = sum(int(chunk_dedup._gear[b]) << (len(part) - 1 - k) for k, b in enumerate(part)) % 2**32
        assert int(whole[at]) == expected


def test_chunks_cover_every_byte_once(spark):
    rows = chunk_dedup.chunks(H.documents(spark, H.AWKWARD)).collect()
    texts = {}
    for i, t in H.AWKWARD:
        texts.setdefault(i, set()).add(len((t or "").encode()))
    by_text = {}
    for r in rows:
        by_text.setdefault((r.doc_id, r.text_key), set()).add((r.start, r.stop))
    for (doc_id, _), spans in by_text.items():
        spans = sorted(spans)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] in texts[doc_id]
        assert max(b - a for a, b in spans) <= chunk_dedup.MAX_BYTES
    assert not {1, 2} & {d for d, _ in by_text}


def test_repeated_passages_are_found_shifted_and_clean_texts_are_left(spark):
    passage = H.prose(50, 70)
    rows = [(k, f"{H.prose(k, 40 + k)} {passage} {H.prose(1000 + k, 30)}") for k in range(1, 9)]
    rows += [(k, H.prose(k, 150)) for k in range(20, 40)] + [(90, None), (91, ""), (92, " \n")]
    docs = H.documents(spark, rows)
    found = chunk_dedup.repeated_passages(docs).collect()
    assert {r.doc_id for r in found} == set(range(2, 9)) and {r.first_doc_id for r in found} == {1}
    texts = dict(rows)
    assert all(texts[r.doc_id].encode()[r.start : r.stop].decode() in texts[1] for r in found)
    cut = {r.doc_id: r.text for r in chunk_dedup.without_repeats(docs).collect()}
    assert cut[1] == texts[1] and cut[25] == texts[25] and all(len(cut[k]) < len(texts[k]) - 300 for k in range(2, 9))
    assert all(cut[k].startswith(H.prose(k, 40 + k)) for k in range(2, 9))


def test_periodic_passages_are_found_at_other_places(spark):
    words = ["ingan", "ta", "x", "venost", "miremi", "quari", "del", "notalu", "ostven", "riri", "luta", "redelmi"]
    rows = []
    for k, word in enumerate(words):
        for at in range(2):
            rows.append((2 * k + at, f"{H.prose(500 + 2 * k + at, 30 + 7 * at)} {' '.join([word] * 51)} {H.prose(900 + 2 * k + at, 20)}"))
    found = {}
    for r in chunk_dedup.repeated_passages(H.documents(spark, rows)).collect():
        found[r.doc_id] = max(found.get(r.doc_id, 0), r.n_words)
    assert all(2 * k + 1 in found for k in range(len(words)))


def plain_chunks(raw):
    """Ends of the chunks of one text, byte by byte."""
    gear = [int(g) for g in chunk_dedup._gear]
    first, reach = chunk_dedup.GEAR_WINDOW - 1, chunk_dedup.REACH
    h = [sum(gear[raw[at - j]] << j for j in range(first + 1)) % 2**32 if at >= first else 2**32 for at in range(len(raw))]
    cuts = [at + 1 for at in range(first, len(raw)) if h[at] == min(h[max(0, at - reach) : at + reach + 1])]
    ends, begin = [], 0
    for cut in [*(c for c in cuts if c < len(raw)), len(raw)]:
        if cut < len(raw) and cut - begin < chunk_dedup.MIN_BYTES:
            continue
        while cut - begin > chunk_dedup.MAX_BYTES:
            begin += chunk_dedup.MAX_BYTES
            ends.append(begin)
        if cut > begin:
            ends.append(cut)
            begin = cut
    return ends


def plain_passages(rows):
    """All repeated passages of rows (doc_id, text_key, text) by the definition, without digests."""
    places, words = {}, {}
    for doc_id, key, text in set(rows):
        raw, begin = (text or "").encode(), 0
        for end in plain_chunks(raw):
            place = (doc_id is None, doc_id or 0, key, begin)
            places.setdefault(raw[begin:end], []).append((place, end))
            words[place] = sum(raw[k] not in b" \t\n\x0b\x0c\r" and (k == 0 or raw[k - 1] in b" \t\n\x0b\x0c\r") for k in range(begin, end))
            begin = end
    repeats = sorted((place, end, min(found)[0]) for found in places.values() for place, end in found if place != min(found)[0])
    runs = []
    for place, end, original in repeats:
        if not (runs and runs[-1][-1][0][:3] == place[:3] and runs[-1][-1][1] == place[3]):
            runs.append([])
        runs[-1].append((place, end, original))
    out = []
    for run in runs:
        n_words = sum(words[place] for place, _, _ in run)
        longest = max(run, key=lambda c: (c[1] - c[0][3], -c[0][3]))[2]
        if n_words >= chunk_dedup.MIN_WORDS:
            out.append((None if run[0][0][0] else run[0][0][1], run[0][0][2], run[0][0][3], run[-1][1], n_words, len(run), None if longest[0] else longest[1]))
    return sorted(out, key=str)


def test_all_rows_equal_brute_force_chunks_and_runs(spark):
    shared = [H.prose(70 + k, 25 + 20 * k) for k in range(4)]
    rows = [(k, f"{H.prose(k, 20 + k)}\n{shared[k % 4]} {H.prose(200 + k, k)} {shared[k % 3].upper() if k % 5 == 0 else shared[k % 3]}") for k in range(1, 40)]
    rows += [(100 + k, f"{H.prose(k, k)} {' '.join([word] * 60)} {H.prose(300 + k, 9)}") for k, word in enumerate(["ta", "ingan", "x", "ta", "ingan", "x"])]
    rows += [(200, "z" * 5000), (201, "y" + "z" * 4000), (202, "Ä é 中 " * 40), (203, f"{H.prose(5, 3)} {'Ä é 中 ' * 40}"), (7, rows[20][1]), (None, rows[3][1])]
    docs = H.documents(spark, rows + rows[5:8] + [*H.AWKWARD[:8], *H.AWKWARD[9:]])
    given = [tuple(r) for r in docs.selectExpr("doc_id", "xxhash64(text)", "text").collect()]
    got = chunk_dedup.repeated_passages(docs).select("doc_id", "text_key", "start", "stop", "n_words", "n_chunks", "first_doc_id").collect()
    expected = plain_passages(given)
    assert sorted(map(tuple, got), key=str) == expected and len(expected) > 60


def test_whole_repeated_rows_and_empty_tables(spark):
    text = H.prose(3, 200)
    docs = H.documents(spark, [(1, text), (1, text), (2, text)])
    found = chunk_dedup.repeated_passages(docs).collect()
    assert [(r.doc_id, r.first_doc_id, r.start, r.stop) for r in found] == [(2, 1, 0, len(text))]
    assert chunk_dedup.repeated_passages(H.documents(spark, [])).count() == 0


BENCH = [(1, H.prose(900, 40)), (2, H.prose(901, 9)), (3, "too short"), (4, None), (5, H.prose(900, 40)), (6, ""), (None, H.prose(902, 10)), (None, H.prose(903, 6))]
BENCH_SCHEMA = "item_id long, text string"


def test_passages_with_substitutions_are_found_and_clean_texts_kept(spark):
    item = BENCH[0][1].split()
    swapped = [f"zz{k}" if k % 9 == 4 else w for k, w in enumerate(item)]
    rows = [
        (1, f"{H.prose(1, 50)} {BENCH[0][1].upper()} {H.prose(2, 50)}"), (2, " ".join([*H.prose(3, 20).split(), *swapped])),
        (3, " ".join(item[10:30])), (4, f"{H.prose(4, 5)} {BENCH[1][1]}"), (5, H.prose(5, 500)), (6, f"{H.prose(6, 9)} too short"),
        (20, f"{H.prose(7, 9)} {' '.join(['qq', *BENCH[1][1].split()[1:]])}"), (21, " ".join(["x1", "x2", *BENCH[1][1].split()[2:], "x3"])),
        (22, " ".join("qq" if k in (3, 7) else w for k, w in enumerate(BENCH[6][1].split()))), (23, BENCH[7][1].upper()),
        (24, " ".join("qq" if k in (1, 3) else w for k, w in enumerate(BENCH[7][1].split()))), (7, " ".join(item[:7])), (8, " ".join(w if k % 2 else f"q{k}" for k, w in enumerate(item))), (1, "same id, clean text"), *H.AWKWARD,
    ]
    docs, bench = H.documents(spark, rows), spark.createDataFrame(BENCH, BENCH_SCHEMA)
    found = {(r.doc_id, r.item_id): r for r in spaced_seed.contaminated(docs, bench).collect()}
    assert set(found) == {(1, 1), (2, 1), (3, 1), (4, 2), (20, 2), (22, None), (23, None)}
    assert (found[1, 1].start_word, found[1, 1].n_words, found[1, 1].n_equal) == (50, 40, 40)
    assert found[2, 1].n_equal == sum(a == b for a, b in zip(item, swapped))
    kept = spaced_seed.decontaminated(docs, bench)
    assert kept.count() == len(rows) - 7 and kept.columns == docs.columns
    clashing = docs.withColumn("hit_id", docs.doc_id).withColumn("__hit_key", docs.doc_id)
    assert spaced_seed.decontaminated(clashing, bench).columns == clashing.columns
    assert [r.text for r in kept.where("doc_id = 1 and text like 'same%'").collect()] == ["same id, clean text"]


def test_overlaps_equal_brute_force_alignment(spark):
    rows = [(k, f"{H.prose(k, 30)} {' '.join(BENCH[0][1].split()[k : k + 8 + k])} {H.prose(100 + k, 30)}") for k in range(1, 20)]
    for k in range(40):  # changed copies of the shorter items
        item = BENCH[(1, 6, 7)[k % 3]][1].split()
        changed = random.Random(k).sample(range(len(item)), k % 4)
        rows.append((200 + k, " ".join(f"q{k}" if at in changed else w for at, w in enumerate(item)) + (" and more" if k % 2 else "")))
    found = {r.doc_id for r in spaced_seed.contaminated(H.documents(spark, rows), spark.createDataFrame(BENCH, BENCH_SCHEMA)).collect()}
    expected = set()
    for doc_id, text in rows:
        doc = H.words(text)
        for _, item in BENCH:
            item = H.words(item)
            window = min(spaced_seed.VERIFY, len(item))
            for shift in range(-len(item), len(doc)) if window >= spaced_seed.LEAST else ():
                same = [0 <= shift + k < len(doc) and doc[shift + k] == w for k, w in enumerate(item)]
                inside = lambda k: 0 <= shift + k and shift + k + window <= len(doc)
                if any(inside(k) and 100 * sum(same[k : k + window]) >= spaced_seed.EQUAL_PERCENT * window for k in range(len(item) - window + 1)):
                    expected.add(doc_id)
    assert found == expected and len(expected) > 25


def test_masks_leave_no_tolerated_substitutions_unseen():
    for length in range(spaced_seed.LEAST, spaced_seed.VERIFY + 1):
        masks = spaced_seed.LONG_MASKS if length >= spaced_seed.VERIFY else spaced_seed.SHORT_MASKS
        for missed in combinations(range(length), length * (100 - spaced_seed.EQUAL_PERCENT) // 100):
            assert any(
                all(mark == "0" or at + k not in missed for k, mark in enumerate(mask)) for mask in masks for at in range(length - len(mask) + 1)
            )


def test_no_benchmark_and_no_documents(spark):
    docs, none = H.documents(spark, H.AWKWARD), spark.createDataFrame([], BENCH_SCHEMA)
    assert spaced_seed.decontaminated(docs, none).count() == len(H.AWKWARD)
    assert spaced_seed.contaminated(H.documents(spark, []), spark.createDataFrame(BENCH, BENCH_SCHEMA)).count() == 0
