from __future__ import annotations

import random
import re
from hashlib import sha256

import llm_helpers as H
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import bpe
from ledgerloom.llm import pii_tagger as P

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a<|endoftext|>b<|startoftext|>", "<|ENDOFTEXT|>", "I'M DON'T we'll", "x" * 3000, "ab" * 2000, "ΣΑΣ ς İ ǅ", "e\u0301 café", "!\x1c! \x85 \u3000x", "日本語 123 4½²", "'s't're", "a\x00b"]


@pytest.fixture(scope="module")
def coders():
    return bpe.WordBpe(open(VOCABULARY, "rb").read()), Tokenizer.from_file(VOCABULARY)


def agree(coders, text):
    ours, theirs = coders
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids, text[:50]
    assert ours.decode(ids).decode() == theirs.decode(ids, skip_special_tokens=False)


def test_every_token_and_odd_texts_agree_with_the_library(coders):
    for number in range(0, 49406, 5):
        agree(coders, coders[1].id_to_token(number).replace("</w>", ""))
    for text in ODD:
        agree(coders, text)


def test_random_texts_agree_with_the_library(coders):
    rnd = random.Random(4)
    for _ in range(3000):
        agree(coders, "".join(rnd.choice("abcdefghijklmnorstuy' .,!?é中́Σ😀<|>0\x1c\n") for _ in range(rnd.randint(0, 60))))


def test_words_outside_the_caches_are_the_same(coders, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 400)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 3)
    coder = bpe.WordBpe(open(VOCABULARY, "rb").read())
    for text in (H.prose(1, 400), "long" * 40 + " word", H.prose(2, 50)):
        agree((coder, coders[1]), text)
        assert len(coder.words) <= 3 and len(coder.older_words) <= 3 and len(coder.compatible_pairs) <= 3
        assert not any(len(word) > bpe.LONG_WORD for word in [*coder.words, *coder.older_words])
    coder.forget()
    assert not coder.words and not coder.older_words and not coder.compatible_pairs


def test_query_rows(spark, coders):
    rows = H.AWKWARD + [(50 + k, t) for k, t in enumerate(ODD)]
    got = bpe.encoded(H.documents(spark, rows), VOCABULARY, with_ids=True).collect()
    expected = []
    for i, t in rows:
        ids = coders[1].encode(t or "", add_special_tokens=False).ids
        decoded = coders[1].decode(ids, skip_special_tokens=False)
        expected.append((str(i), len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest(), str(ids)))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, str(r.ids)) for r in got) == sorted(expected)
    assert bpe.encoded(H.documents(spark, []), VOCABULARY).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and P.luhn(digits(m[0]))]
    spans += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(spans)


def test_patterns_equal_their_regular_expressions():
    rnd = random.Random(2)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab1@.+-% 0()9\n255é") for _ in range(rnd.randint(0, 60)))
        assert P.pattern_spans(text) == plain_spans(text), text
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "@" * 100_000, "+1" * 100_000):
        P.pattern_spans(text)  # linear time


def card(rnd):
    body = [4, *(rnd.randrange(10) for _ in range(14))]
    return next("".join(map(str, [*body, d])) for d in range(10) if P.luhn("".join(map(str, [*body, d]))))


def personal(seed):
    rnd = random.Random(seed)
    spans = [f"{H.prose(seed, 1)}.{rnd.randrange(100)}@mail{rnd.randrange(9)}.example.com", ".".join(str(rnd.randrange(1, 256)) for _ in range(4)),
             card(rnd), f"+1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"]
    return f"{H.prose(seed, 30)} {rnd.choice(spans)} {H.prose(seed + 1, 20)} {rnd.randrange(10)}.0. {H.prose(seed + 2, 9)} {rnd.choice(spans)} {H.prose(seed + 3, 15)}"


@pytest.fixture(scope="module")
def tagger():
    return P.fit([personal(k) for k in range(0, 1500, 5)])


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    w = {k: rng.normal(0, 0.4, s) for k, s in P._SHAPES.items()}
    windows, tags = rng.integers(0, 130, (3, 7)), rng.integers(0, P.TAGS, (3, 7))
    _, g = P.loss_and_gradients(w, windows, tags)
    for k in w:
        for at in np.argsort(-np.abs(g[k]).ravel())[:3]:
            change = np.zeros(g[k].size)
            change[at] = 1e-4
            change = change.reshape(g[k].shape)
            slope = (P.loss_and_gradients({**w, k: w[k] + change}, windows, tags)[0] - P.loss_and_gradients({**w, k: w[k] - change}, windows, tags)[0]) / 2e-4
            assert abs(slope - g[k].ravel()[at]) < 5e-3 * max(1, abs(slope))


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(2)
    w = {"t": rng.normal(size=(P.TAGS, P.TAGS)), "s": rng.normal(size=P.TAGS)}
    scores = rng.normal(size=(4, 1, P.TAGS))
    best = max(np.ndindex(*[P.TAGS] * 4), key=lambda p: w["s"][p[0]] + sum(scores[t, 0, p[t]] for t in range(4)) + sum(w["t"][p[t], p[t + 1]] for t in range(3)))
    assert tuple(P.viterbi(w, scores)[0]) == best


def test_held_out_spans_and_variants_are_tagged(tagger):
    texts = [personal(k) for k in range(5001, 5601, 5)]
    gold = [set(P.pattern_spans(t)) for t in texts]
    found = [set(s) for s in P.added_spans(tagger, texts, [[] for _ in texts])]
    hit = sum(len(a & b) for a, b in zip(gold, found))
    assert hit >= 0.85 * sum(map(len, gold)) and hit >= 0.85 * sum(map(len, found))
    rng, caught = np.random.default_rng(3), 0
    for text, spans in zip(texts, gold):
        start, kind, end = min(spans)
        changed = P._variant(kind, text[start:end], rng)
        text = text[:start] + changed + text[end:]
        known = P.pattern_spans(text)
        caught += any(a < start + len(changed) and start < b for a, _, b in [*P.added_spans(tagger, [text], [known])[0], *known])
    assert caught >= 0.8 * len(texts)


def test_clean_texts_get_no_spans_and_windows_join(tagger):
    clean = [H.prose(k, 300) + " version 2.0. and 1999, page 3" for k in range(30)] + ["", "1", "@"]
    assert not any(P.added_spans(tagger, clean, [[] for _ in clean]))
    texts = [" " * pad + personal(7001) for pad in range(0, 96, 7)]
    none = [[] for _ in texts]
    assert P.added_spans(tagger, texts, none) == P.added_spans(tagger, texts, none, dense=True)


def test_query_rows_and_redaction(spark):
    rows = [(k, personal(k)) for k in range(100, 160)] + H.AWKWARD
    docs = H.documents(spark, rows)
    got = P.personal_data(docs).collect()
    expected = sorted((str(i), sha256(P.written(plain_spans(t or "")).encode()).hexdigest(), *(sum(s[1] == k for s in plain_spans(t or "")) for k in range(4))) for i, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == expected
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    assert all(any(set(P.written(plain_spans(t)).split(",")) <= set(r.spans.split(",")) for t in texts[r.doc_id]) for r in got)
    clean = {r.doc_id: r for r in P.without_personal_data(docs).collect()}
    assert not any(plain_spans(r.text or "") for r in clean.values()) and clean[1].text is None and clean[9].text == H.AWKWARD[8][1]
    assert clean[100].n_chars == len(clean[100].text)
    assert P.personal_data(H.documents(spark, [])).count() == 0


def test_rare_kinds_are_in_the_fit_sample(spark):
    rnd = random.Random(8)
    rows = [(k, f"{H.prose(k, 12)} version {k} page {k % 7}") for k in range(3000)]
    rows += [(5000 + k, f"{H.prose(k, 9)} a{k}@mail.example.com {H.prose(k, 5)}") for k in range(6)]
    rows += [(6000 + k, f"{H.prose(k, 9)} {card(rnd)} {H.prose(k, 5)}") for k in range(400)]
    rows += [(7000 + k, rows[-1][1]) for k in range(500)] + H.AWKWARD
    texts = [r.text for r in P.fit_sample(H.documents(spark, rows), 100).collect()]
    kinds = [{kind for _, kind, _ in P.pattern_spans(t)} for t in texts]
    assert len(set(texts)) == len(texts) <= 100
    assert [sum(k in found for found in kinds) for k in (0, 1, 2, 3)] == [6, 0, 20, 0] and sum(not found for found in kinds) == 20
    assert P.trained(H.documents(spark, rows), 100) is not None
    assert P.trained(H.documents(spark, rows[:50] + H.AWKWARD), 100) is None
