from __future__ import annotations

import math
import zlib
from collections import Counter

import llm_helpers as H
import numpy as np
import pytest

from ledgerloom.llm import gated_lm as G


class FakeLexicon:
    rng = np.random.default_rng(0)
    vocabulary_counts = rng.random(G.VOCABULARY) * 50
    tail_mass = rng.random(G.TAIL_CLASSES) * 30 + 1


@pytest.fixture(scope="module")
def weights():
    rng = np.random.default_rng(1)
    w = G.start_weights(FakeLexicon)
    for k in ("c", "w"):
        w[k][:] = rng.normal(0, 0.3, w[k].shape)
    return w


def test_gradients_match_differences(weights):
    rng = np.random.default_rng(2)
    window = rng.integers(0, G.VOCABULARY + G.TAIL_CLASSES, (5, 3))
    mask = np.ones((5, 3), bool)
    mask[3:, 2] = False
    start = np.zeros((3, G.HIDDEN), np.float32)

    def loss(w):
        h, total = start, 0.0
        for t in range(5):
            total -= G.token_scores(w, h, window[t])[mask[t]].sum()
            h = np.where(mask[t][:, None], G._step(w, h, window[t])[0], h)
        return total / mask.sum()

    wide = {k: v.astype(np.float64) for k, v in weights.items()}
    found, _ = G._window_gradients(weights, start, window, mask)
    for k, g in found.items():
        for at in np.argsort(-np.abs(g).ravel())[:3]:
            change = np.zeros(g.size)
            change[at] = 1e-4
            change = change.reshape(g.shape)
            slope = (loss({**wide, k: wide[k] + change}) - loss({**wide, k: wide[k] - change})) / 2e-4
            assert abs(slope - g.ravel()[at]) < 2e-3 * max(1, abs(slope))


def test_probabilities_sum_to_one(weights):
    h = np.random.default_rng(3).normal(size=(1, G.HIDDEN)).astype(np.float32)
    every = np.arange(G.VOCABULARY + G.TAIL_CLASSES)
    assert np.exp(G.token_scores(weights, np.repeat(h, len(every), axis=0), every)).sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_through_whole_texts(weights):
    rng = np.random.default_rng(4)
    lengths = [1, 300, 17, 0, 64]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    tokens = rng.integers(0, G.VOCABULARY + G.TAIL_CLASSES, offsets[-1])
    got = G.text_scores(weights, tokens, offsets)
    for k in range(len(lengths)):
        h, total = np.zeros((1, G.HIDDEN), np.float32), 0.0
        for token in tokens[offsets[k] : offsets[k + 1]]:
            total += G.token_scores(weights, h, np.array([token]))[0]
            h = G._step(weights, h, np.array([token]))[0]
        assert got[k] == pytest.approx(total, abs=1e-2)


def in_training(doc_id):
    return zlib.crc32(str("null" if doc_id is None else doc_id).encode()) % 10 != 0


def languages():
    """Two languages of different words, so that what was read tells what comes."""
    rng = np.random.default_rng(6)
    rows = []
    for k in range(300):
        pool = "abcde" if k % 2 else "vwxyz"
        rows.append((1000 + k, " ".join("".join(rng.choice(list(pool), 3)) for _ in range(60))))
    return rows


def test_base_scores_are_exact_and_the_model_beats_them(spark):
    rows = languages() + H.AWKWARD
    got = G.document_scores(H.documents(spark, rows)).collect()
    counts = Counter()
    for doc_id, text in rows:
        if in_training(doc_id):
            counts.update([*H.words(text), None])
    total, kinds = sum(counts.values()), len(counts)
    expected = sorted(
        (str(d), len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w), 4))
        for d, w in ((d, [*H.words(t), None]) for d, t in rows)
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == expected
    assert all(r.train_tokens == total and r.held_out == (not in_training(r.doc_id)) and r.score < 0 for r in got)
    held_out = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 1000]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out) + 2 * len(held_out)


def test_training_reads_every_document_once(spark):
    rows = languages() + H.AWKWARD + [(10, "twice")] * 30
    lexicon, _ = G.lexicon_of(H.documents(spark, rows))
    table = G.numbered(H.documents(spark, rows), lexicon).collect()
    read = Counter(r.doc_id for r in table if r.turn >= 0)
    assert read == Counter(d for d, t in rows if in_training(d)) and {r.turn for r in table} == {-1, *range(G.ROUNDS)}
    assert sum(len(r.tokens) for r in table if r.turn >= 0) == lexicon.tokens
    assert len({r.spread for r in table if r.doc_id == 10}) > 5  # equal rows are spread


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(G, "COPY_TOKENS", 700)  # many copies, averaged in several levels
    monkeypatch.setattr(G, "FAN_IN", 3)
    monkeypatch.setattr(G, "HEAD", 40)
    rows = languages() + H.AWKWARD[:9]
    found = []
    for docs in (H.documents(spark, rows).repartition(7, "text"), H.documents(spark, rows).coalesce(1)):
        lexicon, counts = G.lexicon_of(docs)
        tokens = G.numbered(docs, lexicon)
        weights = G.trained(tokens, lexicon)
        found.append((weights, {r.doc_id: r for r in G.scored(tokens, lexicon, counts, weights).collect()}))
    (weights, apart), (same_weights, whole) = found
    assert np.array_equal(weights, same_weights) and len(whole) == len(rows)
    for k, r in whole.items():  # what is left is single precision in products of other shapes
        assert r.base_score == pytest.approx(apart[k].base_score, abs=1e-9) and r.score == pytest.approx(apart[k].score, rel=1e-6, abs=1e-4)


def test_vocabulary_does_not_depend_on_the_broadcast_head(spark, monkeypatch):
    docs = H.documents(spark, languages())
    large, _ = G.lexicon_of(docs)
    monkeypatch.setattr(G, "HEAD", 5)  # less than the first frequency step
    small, _ = G.lexicon_of(docs)
    assert np.array_equal(large.vocabulary_counts, small.vocabulary_counts) and (small.vocabulary_counts > 0).sum() > 100
    assert np.allclose(large.tail_mass, small.tail_mass)


def test_streams_read_every_token_and_start_anew_with_each_document(weights):
    rng = np.random.default_rng(5)
    lengths = [1, 3000, 17, 0, 9000, 64]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    tokens = rng.integers(0, G.VOCABULARY + G.TAIL_CLASSES, offsets[-1])
    trainer = G.Trainer(G.packed(weights))
    trainer.fit(tokens, offsets)
    assert trainer.tokens == len(tokens)
    # two documents one behind the other give the gradients that they give side by side
    window = rng.integers(0, G.VOCABULARY + G.TAIL_CLASSES, (8, 1))
    fresh = np.isin(np.arange(8), [0, 4])[:, None]
    joined, _ = G._window_gradients(weights, np.ones((1, G.HIDDEN), np.float32), window, np.ones((8, 1), bool), fresh)
    apart, _ = G._window_gradients(weights, np.zeros((2, G.HIDDEN), np.float32), window.reshape(2, 4).T, np.ones((4, 2), bool))
    for k in joined:
        assert np.allclose(joined[k], apart[k], atol=1e-5)


def test_empty_table(spark):
    assert G.document_scores(H.documents(spark, [])).count() == 0
