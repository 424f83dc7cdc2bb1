"""Exact BPE encoding by backtracking over longest tokens, and decoding from an offset table.

The merge order of a BPE vocabulary decides, for any two tokens, whether they may stand side by side: they
may not if a merge across their border would have happened before one of them was complete. A text has
exactly one split into tokens whose neighbours are all compatible, and that split is what merging step by step
would give. So a word is encoded by taking the longest token at each position (found by an Aho-Corasick automaton),
checking it against the token before, trying the shorter tokens that begin it where it does not fit, and stepping
back where none fits. A position that was left once never fits again, which makes the work linear in the word's length.
Compatibilities are kept in a table as they come up.

The vocabulary file is read once on the driver and broadcast; its size is fixed. Words repeat, so a task keeps the ids
of recent words, up to twice ``CACHED_BYTES`` of memory whatever the words are, and ``CACHED_PAIRS`` compatibilities. The caches
only save time; they are dropped when the task ends, since its worker process may stay and serve other work.

Defined results: a null text is encoded like an empty one, with no ids and an empty decoded text. Texts of
any length are encoded whole. Strings of special tokens inside a text become their ids, as the library does.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

CACHED_BYTES = 32 << 20
CACHED_PAIRS = 200_000
LONG_WORD = 64  # longer words hardly repeat and are not kept
_ENTRY_BYTES = 120  # of a dictionary entry, its text and its tuple, without letters and ids
_NEVER = 1 << 60
# Unicode White_Space, which differs from str.isspace by the separators U+001C..U+001F
_WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_WHITE_RUN = re.compile(f"[{_WHITE}]+")
_OTHER_SPACE = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    letters.update({b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in letters)})
    return [letters[b] for b in range(256)]


def lower(text: str) -> str:
    """Lower case letter by letter, so a final sigma is lowered like any other."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class WordBpe:
    """Encoder and decoder for a tokenizers file: BPE with an end-of-word suffix over byte letters."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.suffix = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern.replace(r"\s", _WHITE))
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.merged = {(vocab[a], vocab[b]): vocab[a + b] for a, b in merges}
        size = max(*vocab.values(), *self.special.values()) + 1
        self.left, self.right, self.born = [-1] * size, [-1] * size, [-1] * size
        for order, ((a, b), whole) in enumerate(self.merged.items()):
            self.left[whole], self.right[whole], self.born[whole] = a, b, order

        # one symbol for each byte, and another for each byte that ends a word
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        number_of: dict[str, int] = {}
        self.tokens = ahocorasick.Automaton()
        self.lengths, self.shorter = [0] * size, [-1] * size  # the longest token that begins a token
        for token, number in vocab.items():
            body, ends = (token[: -len(self.suffix)], True) if token.endswith(self.suffix) and len(token) > len(self.suffix) else (token, False)
            symbols = [byte_of[c] for c in body]
            if ends:
                symbols[-1] += 256
            number_of["".join(map(chr, symbols))] = number
        for symbols, number in number_of.items():
            self.tokens.add_word(symbols, number)
            self.lengths[number] = len(symbols)
            self.shorter[number] = next((number_of[symbols[:k]] for k in range(len(symbols) - 1, 0, -1) if symbols[:k] in number_of), -1)
        self.tokens.make_automaton()

        names = [b""] * size
        for token, number in [*vocab.items(), *self.special.items()]:
            names[number] = token.encode()
        self.offsets = np.concatenate([[0], np.cumsum([len(n) for n in names])])
        self.characters = np.frombuffer(b"".join(names) + b" ", np.uint8)
        self.numbers = [str(k) for k in range(size)]
        self.forget()

    def forget(self) -> None:
        """Empty the caches."""
        self.compatible_pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older_words: dict[str, tuple[int, ...]] = {}
        self.word_bytes = 0

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the text of ``a`` and ``b`` leaves a border between them."""
        pair = a << 32 | b
        known = self.compatible_pairs.get(pair)
        if known is None:
            if len(self.compatible_pairs) >= CACHED_PAIRS:
                self.compatible_pairs.clear()
            known = self.compatible_pairs[pair] = self._border_holds(a, b)
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        # Walk back in time: undo whichever of the two neighbours was merged last, and ask each time whether
        # the neighbours as they then were would have merged first. At equal order the left merge goes first.
        born, undone_a, undone_b = self.born, _NEVER, _NEVER
        while True:
            across = self.merged.get((a, b))
            if across is not None and born[across] < undone_a and born[across] <= undone_b:
                return False
            if born[a] < 0 and born[b] < 0:
                return True
            if born[a] > born[b]:
                undone_a, a = born[a], self.right[a]
            else:
                undone_b, b = born[b], self.left[b]

    def encode_piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        symbols = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
        end = len(symbols)
        # Longest tokens from left to right are the answer if no border among them breaks.
        ids = [number for _, number in self.tokens.iter_long(symbols)]
        known, before = self.compatible_pairs.get, ids[0]
        for k in range(1, len(ids)):
            token = ids[k]
            holds = known(before << 32 | token)
            if holds is None:
                holds = self.compatible(before, token)
            if not holds:
                return self._stepped_back(symbols, ids[:k], token)
            before = token
        return ids

    def _stepped_back(self, symbols: str, ids: list[int], refused: int) -> list[int]:
        """Goes on behind ``ids``, where ``refused`` is the longest token but does not fit."""
        known, shorter, lengths, longest = self.compatible_pairs.get, self.shorter, self.lengths, self.tokens.iter_long
        end, here, candidate = len(symbols), 0, shorter[refused]
        for token in ids:
            here += lengths[token]
        left_behind = bytearray(end + 1)
        while True:
            before = ids[-1] if ids else -1
            while candidate >= 0:
                if not left_behind[here + lengths[candidate]]:
                    holds = before < 0 or known(before << 32 | candidate)
                    if holds or (holds is None and self.compatible(before, candidate)):
                        break
                candidate = shorter[candidate]
            if candidate >= 0:
                ids.append(candidate)
                here += lengths[candidate]
                if here == end:
                    return ids
                candidate = next(longest(symbols, here))[1]
            elif ids:
                left_behind[here] = 1
                last = ids.pop()
                here, candidate = here - lengths[last], shorter[last]
            else:
                raise ValueError(f"the vocabulary has no tokens for {symbols!r}")

    def _word(self, word: str) -> tuple[int, ...]:
        ids = self.older_words.get(word)
        if ids is None:
            pieces = self.pieces.findall(word)
            if len(pieces) == 1:
                ids = tuple(self.encode_piece(pieces[0]))
            else:  # no alternative of the pattern looks around, so a piece alone is the same piece
                ids = tuple(chain.from_iterable([self.words.get(p) or self._word(p) for p in pieces]))
        if len(word) <= LONG_WORD:
            if self.word_bytes >= CACHED_BYTES:  # words in use move on to the new generation, the others go
                self.older_words, self.words, self.word_bytes = self.words, {}, 0
            self.words[word] = ids
            self.word_bytes += _ENTRY_BYTES + 4 * len(word) + 8 * len(ids)
        return ids

    def _plain(self, text: str) -> list[int]:
        text = lower(unicodedata.normalize("NFC", text))
        words = _WHITE_RUN.split(text) if _OTHER_SPACE.search(text) else text.split()
        known, encode = self.words.get, self._word
        return list(chain.from_iterable([known(w) or encode(w) for w in words]))

    def encode(self, text: str) -> list[int]:
        if self.special_split is None or not any(s in text for s in self.special):
            return self._plain(text)
        ids: list[int] = []
        for part in self.special_split.split(text):
            ids.extend([self.special[part]] if part in self.special else self._plain(part))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """Token texts between single spaces (the file names no decoder), cut from one string by their offsets."""
        at = np.asarray(ids, np.int64)
        starts = self.offsets[at]
        lengths = self.offsets[at + 1] - starts + 1
        ends = np.cumsum(lengths)
        # source position of every output byte; the byte after each token is a space
        source = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
        characters = self.characters[np.minimum(source, len(self.characters) - 1)]
        characters[ends - 1] = 32
        return characters[:-1].tobytes()


_loaded: dict[str, WordBpe] = {}


def _encode_batches(content, key: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _loaded.get(key)
        if coder is None:
            coder = _loaded[key] = WordBpe(content.value)
            gc.freeze()  # the tables stay; garbage collections need not walk them
        numbers = coder.numbers
        for batch in batches:
            counts, id_digests, text_digests, kept = [], [], [], []
            for text in batch.column(batch.num_columns - 1):
                ids = coder.encode(text.as_py() or "")
                counts.append(len(ids))
                id_digests.append(sha256(" ".join([numbers[i] for i in ids]).encode()).hexdigest())
                text_digests.append(sha256(coder.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(ids)
            columns = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            names = [*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        coder.forget()
        pa.default_memory_pool().release_unused()

    return run


def encoded(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) per document; ``vocabulary`` is the file's path."""
    with open(vocabulary, "rb") as file:
        content = file.read()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids
    shared = docs.sparkSession.sparkContext.broadcast(content)
    key = sha256(content).hexdigest()
    return docs.select("doc_id", "text").mapInArrow(_encode_batches(shared, key, with_ids), schema)
