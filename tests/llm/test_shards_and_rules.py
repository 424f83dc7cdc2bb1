from __future__ import annotations

import zlib
from collections import Counter

import llm_helpers as H

from ledgerloom.llm import byte_shards, host_rules


def test_shards_are_contiguous_balanced_and_gapless(spark):
    rows = [(k * 7 % 1009, "é" * (k * 37 % 400)) for k in range(900)] + H.AWKWARD
    got = byte_shards.balanced_shards(H.documents(spark, rows), 8).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    place = sorted(got, key=lambda r: (r.shard, r.slot))
    assert all([r.slot for r in place if r.shard == s] == list(range(n)) for s, n in Counter(r.shard for r in got).items())
    ids = [-1 if r.doc_id is None else r.doc_id for r in place]
    assert ids == sorted(ids)
    total, before = sum(r.size for r in got), 0
    for r in place:
        assert r.shard == min(7, (2 * before + r.size) * 8 // (2 * total))
        before += r.size
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_blocks_and_partitions_do_not_change_the_cut(spark, monkeypatch):
    rows = [(k, "x" * (k % 50)) for k in range(300)] + [(5, "same")] * 100
    key = lambda r: (r.doc_id, r.text_crc32, r.shard)
    once = sorted(map(key, byte_shards.balanced_shards(H.documents(spark, rows), 5).collect()))
    monkeypatch.setattr(byte_shards, "BLOCK_ROWS", 7)
    assert sorted(map(key, byte_shards.balanced_shards(H.documents(spark, rows).coalesce(1), 5).collect())) == once
    assert byte_shards.balanced_shards(H.documents(spark, []), 5).count() == 0


def measured(text):
    text = text or ""
    w = H.words(text, lower=False)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if H.words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_measures_match_plain_python(spark):
    rows = H.AWKWARD + [
        (20, "a b c d e f g a b c d e x a b c d e"), (21, "a a a a a a a a a a a"), (22, "l one\nl two\nl one\n \n\nl one"), (23, "#$% <x> & | * ok"), (24, "a b c d e " * 500),
    ]
    got = host_rules.host_verdicts(H.documents(spark, rows)).collect()
    found = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert found == sorted((str(i), *measured(t)) for i, t in rows)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)


def test_bad_hosts_go_small_hosts_lean_on_the_prior(spark):
    good, bad = H.prose(1, 30), "# " * 3 + "<x> " * 20
    rows = [(k, good if k % 10 else bad, "fine") for k in range(200)] + [(300 + k, bad if k % 10 else good, "spam") for k in range(200)]
    rows += [(600, bad, "tiny"), (601, good, "tiny"), (700, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in host_rules.host_verdicts(docs).collect()}
    assert not any(got[300 + k].kept for k in range(200)) and all(got[k].kept for k in range(200) if k % 10)
    assert got[601].kept and got[700].kept and not got[300].base_failed
    rates = {r.host: r for r in host_rules.host_rates(docs.selectExpr("source as host", "text like '# %' as failed")).collect()}
    prior = 0.5  # about half of all documents fail
    assert abs(rates["tiny"].shrunk_rate - 0.5) < 0.1 and rates["spam"].shrunk_rate > 0.8 and abs(rates[None].shrunk_rate - prior) < 0.3
    kept = host_rules.kept_documents(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def test_no_python_on_the_native_paths_and_empty_table(spark):
    docs = H.documents(spark, H.AWKWARD)
    for frame in (byte_shards.balanced_shards(docs), host_rules.host_verdicts(docs), host_rules.measured(docs)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert host_rules.host_verdicts(H.documents(spark, [])).count() == 0
