"""Document log-likelihoods from a gated recurrent language model trained on the corpus itself.

Words are numbered from corpus counts over every training document. The ``WORD_CLASSES * CLASS_SIZE`` most frequent
words form classes of like frequency; each further word belongs to one of ``TAIL_CLASSES`` classes by its last
two bytes. A GRU reads a text word by word and gives P(class | history) and, for frequent words,
P(word | class, history); a further word has its smoothed corpus share inside its class, with one more share for
words never seen in training. So every text has a probability.

Every text is cut into words once; the numbers of its tokens are written as a table that training and scoring read.

Training is truncated backpropagation in numpy over windows of ``STEPS`` words, the state being carried from window to
window. Documents lie end to end in up to ``LANES`` streams of equal length, so every window is full whatever the
lengths of the documents; the state starts anew with each document. It takes ``ROUNDS`` rounds, which part the training
documents among them: each document is read in exactly one round. A round's documents are dealt by a hash of id and text to blocks
of about ``COPY_TOKENS`` tokens, as many as the corpus needs. Every block trains a copy of the current weights on its documents
in order of their hashes, and the copies are averaged by the tokens they saw, ``FAN_IN`` at a time, in order of their
numbers. So scores do not depend on how the input is partitioned. Weights have a fixed size, about half a megabyte.
Scoring carries the state through the whole document, so windows change nothing in the result.

The vocabulary is a top-k of all words. Counts of the most frequent words, as many whole steps of frequency as ``HEAD`` words
hold (a fixed bound), are broadcast; the others are joined by a shuffle, after repeats inside a document are summed.

Defined results: a null or blank text is the end token alone. Ids decide what is held out; a null id counts as the
text 'null'. Rows that repeat are scored each and all are trained on; those of one input batch that repeat id and text are spread over
the blocks, and only then blocks depend on the batches. With no training documents all counts are zero and
the model gives its uniform start. Words are told apart by 64-bit numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged
from ledgerloom.llm.text import _LOWER, hashed_words, mix, row_ranges

WORD_CLASSES, CLASS_SIZE, TAIL_CLASSES = 32, 64, 64
VOCABULARY = WORD_CLASSES * CLASS_SIZE
CLASSES = WORD_CLASSES + TAIL_CLASSES
HEAD = 1 << 18
HIDDEN = 16
STEPS, LANES = 16, 512
WINDOWS = 64  # windows that a slice is cut into at least, before the streams get fewer
ROUNDS = 4
RATE = 0.01
CLIP = 1.0
STEPS_PER_DOUBLING = 64
END = 0  # the end token's number; no word hashes to it
HELD_OUT = 10
_CHUNK = 8192
_SHAPES = {
    "x": (VOCABULARY + TAIL_CLASSES, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
    "c": (HIDDEN, CLASSES), "cb": (CLASSES,), "w": (WORD_CLASSES, HIDDEN, CLASS_SIZE), "wb": (WORD_CLASSES, CLASS_SIZE),
}
_SIZES = {k: int(np.prod(s)) for k, s in _SHAPES.items()}
_CLASS_OF = np.concatenate([np.repeat(np.arange(WORD_CLASSES), CLASS_SIZE), WORD_CLASSES + np.arange(TAIL_CLASSES)]).astype(np.int16)
COPY_TOKENS = 1 << 20
FAN_IN = 64
_BLOCK = 8192  # weights per row when copies are averaged


# ---- words --------------------------------------------------------------------------------------


def _tail_classes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    last = _LOWER[data[stops - 1]].astype(np.uint64)
    before = np.where(stops - starts > 1, _LOWER[data[np.maximum(stops - 2, 0)]], 0).astype(np.uint64)
    return (mix(last * np.uint64(257) + before + np.uint64(1)) % np.uint64(TAIL_CLASSES)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, classes = [(np.array([END], np.uint64), np.array([batch.num_rows]))], [np.array([-1])]  # the end of every text
        for _, _, words, _, (data, starts, stops) in hashed_words(batch.column(0)):
            found, first, counts = np.unique(words, return_index=True, return_counts=True)
            hashes.append((found, counts))
            classes.append(_tail_classes(data, starts[first], stops[first]))
        rows = pd.DataFrame({"hash": np.concatenate([h for h, _ in hashes]).view(np.int64), "n": np.concatenate([c for _, c in hashes]), "tail": np.concatenate(classes)})
        rows = rows.groupby("hash", sort=False).agg({"n": "sum", "tail": "first"}).reset_index()
        yield pa.RecordBatch.from_pandas(rows[["hash", "tail", "n"]].astype("int64"), preserve_index=False)


class Lexicon:
    """Frequent words with their counts and model numbers; a fixed number of entries."""

    def __init__(self, head: pd.DataFrame, tail_mass: np.ndarray, tokens: int, types: int, documents: int):
        ranked = head.sort_values(["n", "hash"], ascending=[False, True])
        number = np.full(len(ranked), -1, np.int32)
        number[: VOCABULARY - 1] = np.arange(1, min(len(ranked), VOCABULARY - 1) + 1)
        order = np.argsort(ranked["hash"].to_numpy().view(np.uint64))
        self.hashes = ranked["hash"].to_numpy().view(np.uint64)[order]
        self.counts = ranked["n"].to_numpy(np.float64)[order]
        self.numbers = number[order]
        self.documents = documents
        self.tokens = tokens + documents
        self.types = types + (documents > 0)
        self.divisor = self.tokens + 0.1 * (self.types + 1)
        self.vocabulary_counts = np.zeros(VOCABULARY)
        self.vocabulary_counts[END] = documents
        self.vocabulary_counts[self.numbers[self.numbers > 0]] = self.counts[self.numbers > 0]
        self.tail_mass = tail_mass + 0.1

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Model number (-1: none) and count (-1: not in the head) of every word."""
        if not len(words) or not len(self.hashes):
            return np.full(len(words), -1, np.int32), np.full(len(words), -1.0)
        distinct, back = np.unique(words, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        known = self.hashes[at] == distinct
        return np.where(known, self.numbers[at], -1)[back], np.where(known, self.counts[at], -1.0)[back]


def _numbered(batch_texts: pa.Array, lexicon: Lexicon):
    """Per slice: first row, last row, tokens (end tokens included), offsets, and the words' hashes, numbers, counts, rows."""
    for first, last, words, rows, (data, starts, stops) in hashed_words(batch_texts):
        numbers, counts = lexicon.look_up(words)
        tails = VOCABULARY + _tail_classes(data, starts, stops) if len(words) else np.zeros(0, np.int64)
        tokens = np.where(numbers >= 0, numbers, tails)
        bounds = row_ranges(rows, last - first)
        tokens = np.insert(tokens, bounds[1:], END)
        yield first, last, tokens.astype(np.int32), bounds + np.arange(last - first + 1), (words, numbers, counts, rows, tails)


# ---- model --------------------------------------------------------------------------------------


def start_weights(lexicon: Lexicon, seed: int = 11) -> dict[str, np.ndarray]:
    """Small random recurrence; output biases at the corpus frequencies."""
    rng = np.random.default_rng(seed)
    w = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}
    w["x"][:] = rng.normal(0, 0.3, w["x"].shape)
    for k in range(3):
        w["u"][:, k * HIDDEN : (k + 1) * HIDDEN] = np.linalg.qr(rng.normal(size=(HIDDEN, HIDDEN)))[0] * 0.7
    words = (lexicon.vocabulary_counts + 0.1).reshape(WORD_CLASSES, CLASS_SIZE)
    w["cb"][:] = np.log(np.concatenate([words.sum(axis=1), lexicon.tail_mass]) / (words.sum() + lexicon.tail_mass.sum()))
    w["wb"][:] = np.log(words / words.sum(axis=1, keepdims=True))
    return w


def packed(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in _SHAPES])


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    at, w = 0, {}
    for k, shape in _SHAPES.items():
        w[k] = flat[at : at + _SIZES[k]].reshape(shape).astype(np.float32)
        at += _SIZES[k]
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _step(w, h: np.ndarray, tokens: np.ndarray):
    """One step of the GRU for several texts."""
    x = w["x"][tokens]
    x += w["b"]
    gates = h @ w["u"]
    zr = _sigmoid(x[:, : 2 * HIDDEN] + gates[:, : 2 * HIDDEN])
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    n = np.tanh(x[:, 2 * HIDDEN :] + r * gates[:, 2 * HIDDEN :])
    return n + z * (h - n), (z, r, n, gates[:, 2 * HIDDEN :])


def _tame(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no logit can leave the range of exp in single precision: states lie between -1 and 1."""
    return float(np.abs(weights).sum(axis=-2).max() + np.abs(bias).max()) < 80


def _log_share(x: np.ndarray, chosen: np.ndarray, tame: bool) -> np.ndarray:
    """Log of the softmax down each column of ``x`` (overwritten) at the row chosen for it."""
    if not tame:
        x -= x.max(axis=0)
    picked = x[chosen, np.arange(len(chosen))]
    return picked - np.log(np.exp(x, out=x).sum(axis=0))


def _by_class(classes: np.ndarray):
    order = np.argsort(classes, kind="stable")
    edges = np.searchsorted(classes[order], np.arange(WORD_CLASSES + 1))
    for k in range(WORD_CLASSES):
        if edges[k + 1] > edges[k]:
            yield k, order[edges[k] : edges[k + 1]]


def token_scores(w, h: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Natural log of P(class | h), times P(word | class, h) for words of the vocabulary."""
    out = np.empty(len(tokens))
    classes = _CLASS_OF[tokens]
    tame, tame_words = _tame(w["c"], w["cb"]), _tame(w["w"], w["wb"])
    for at in range(0, len(tokens), _CHUNK):
        part = slice(at, at + _CHUNK)
        out[part] = _log_share(w["c"].T @ h[part].T + w["cb"][:, None], classes[part], tame)
    for k, rows in _by_class(classes):
        for at in range(0, len(rows), _CHUNK):
            part = rows[at : at + _CHUNK]
            out[part] += _log_share(w["w"][k].T @ h[part].T + w["wb"][k][:, None], tokens[part] % CLASS_SIZE, tame_words)
    return out


def text_scores(w, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of token scores of every text; the state is carried through each whole text."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = offsets[:-1][order], lengths[order]
    h = np.zeros((len(order), HIDDEN), np.float32)
    total = np.zeros(len(order))
    states, read, owner, waiting = [], [], [], 0
    longest = int(lengths[0]) if len(lengths) else 0
    for t in range(longest):
        active = int(np.searchsorted(-lengths, -t, "left"))  # texts longer than t
        now = tokens[starts[:active] + t]
        states.append(h[:active].copy())
        read.append(now)
        owner.append(np.arange(active))
        h[:active] = _step(w, h[:active], now)[0]
        waiting += active
        if waiting >= _CHUNK or t + 1 == longest:  # few long texts wait until a whole chunk can be scored
            scores = token_scores(w, np.concatenate(states), np.concatenate(read))
            total += np.bincount(np.concatenate(owner), scores, minlength=len(order))
            states, read, owner, waiting = [], [], [], 0
    out = np.empty(len(order))
    out[order] = total
    return out


def _excess(x: np.ndarray, chosen: np.ndarray, scale: np.float32, tame: bool) -> np.ndarray:
    """Gradient of the negative log-likelihood by the logits, in their place: softmax less one at the chosen rows."""
    if not tame:
        x -= x.max(axis=0)
    np.exp(x, out=x)
    x *= scale / x.sum(axis=0)
    x[chosen, np.arange(len(chosen))] -= scale
    return x


def _window_gradients(w, h: np.ndarray, window: np.ndarray, mask: np.ndarray, fresh: np.ndarray | None = None):
    """Gradients of the mean negative log-likelihood over one window [steps, lanes], and the state after it.

    ``fresh`` marks first words of documents: the state before them is the start state. Inside, lanes are the last
    axis, so that gates are whole blocks of memory.
    """
    steps, lanes = window.shape
    whole, start = mask.all(axis=1), np.zeros(steps, bool) if fresh is None else fresh.any(axis=1)
    read = window.ravel()
    x = np.ascontiguousarray((w["x"][read] + w["b"]).T).reshape(3 * HIDDEN, steps, lanes)
    u = np.ascontiguousarray(w["u"].T)
    after, kept = np.ascontiguousarray(h.T), []
    states = np.empty((HIDDEN, steps, lanes), np.float32)
    for t in range(steps):
        before = np.where(fresh[t], np.float32(0), after) if start[t] else after
        states[:, t] = before
        gates = u @ before
        zr = _sigmoid(x[: 2 * HIDDEN, t] + gates[: 2 * HIDDEN])
        z, r, candidate = zr[:HIDDEN], zr[HIDDEN:], gates[2 * HIDDEN :]
        n = np.tanh(x[2 * HIDDEN :, t] + r * candidate)
        after = n + z * (before - n)
        if not whole[t]:
            after = np.where(mask[t], after, before)
        kept.append((before, z, r, n, candidate))
    seen = np.flatnonzero(mask.ravel())
    classes = _CLASS_OF[read[seen]]
    order = np.argsort(classes, kind="stable")
    seen, classes = seen[order], classes[order]
    words = read[seen] % CLASS_SIZE
    outputs = np.take(states.reshape(HIDDEN, -1), seen, axis=1)
    scale = np.float32(1 / max(1, len(seen)))
    g = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}
    p = _excess(w["c"].T @ outputs + w["cb"][:, None], classes, scale, _tame(w["c"], w["cb"]))
    g["c"], g["cb"] = outputs @ p.T, p.sum(axis=1)
    back = w["c"] @ p
    edges, tame = np.searchsorted(classes, np.arange(WORD_CLASSES + 1)), _tame(w["w"], w["wb"])
    for k in range(WORD_CLASSES):
        part = slice(edges[k], edges[k + 1])
        if part.start < part.stop:
            p = _excess(w["w"][k].T @ outputs[:, part] + w["wb"][k][:, None], words[part], scale, tame)
            g["w"][k], g["wb"][k] = outputs[:, part] @ p.T, p.sum(axis=1)
            back[:, part] += w["w"][k] @ p
    from_output = np.zeros((HIDDEN, steps * lanes), np.float32)
    from_output[:, seen] = back
    from_output = from_output.reshape(HIDDEN, steps, lanes)
    flow = np.zeros((HIDDEN, lanes), np.float32)
    inputs = np.empty((3 * HIDDEN, steps, lanes), np.float32)
    gates = np.empty((3 * HIDDEN, lanes), np.float32)
    for t in reversed(range(steps)):
        before, z, r, n, candidate = kept[t]
        dh = flow if whole[t] else np.where(mask[t], flow, np.float32(0))
        through = dh * z
        dn = (dh - through) * (1 - n * n)
        inputs[:HIDDEN, t] = gates[:HIDDEN] = through * (before - n) * (1 - z)
        inputs[HIDDEN : 2 * HIDDEN, t] = gates[HIDDEN : 2 * HIDDEN] = dn * candidate * r * (1 - r)
        inputs[2 * HIDDEN :, t] = dn
        gates[2 * HIDDEN :] = dn * r
        g["u"] += before @ gates.T
        through += w["u"] @ gates
        flow = (through if whole[t] else np.where(mask[t], through, flow)) + from_output[:, t]
        if start[t]:
            flow[:, fresh[t]] = 0
    by_word = np.argsort(read.astype(np.int16), kind="stable")  # 16 bits are sorted by radix
    kinds, edges = np.unique(read[by_word], return_index=True)
    flat = inputs.reshape(3 * HIDDEN, -1)
    g["x"][kinds] = np.add.reduceat(np.ascontiguousarray(flat.T)[by_word], edges)
    g["b"] = flat.sum(axis=1)
    return g, np.ascontiguousarray(after.T)


class Trainer:
    """Adam over windows of many streams side by side; state carried from window to window of a document."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat.astype(np.float32).copy()
        self.first, self.second, self.updates, self.tokens = np.zeros_like(self.flat), np.zeros_like(self.flat), 0, 0

    def fit(self, tokens: np.ndarray, offsets: np.ndarray) -> None:
        tokens = tokens[offsets[0] : offsets[-1]]
        if not len(tokens):
            return
        first_words = np.zeros(len(tokens) + 1, bool)
        first_words[offsets - offsets[0]] = True
        lanes = min(LANES, max(1, len(tokens) // (STEPS * WINDOWS)))
        length = -(-len(tokens) // lanes)
        places = np.arange(lanes) * length
        h = np.zeros((lanes, HIDDEN), np.float32)
        for begin in range(0, length, STEPS):
            steps = np.arange(begin, min(begin + STEPS, length))[:, None]
            at = places + steps
            mask = at < len(tokens)
            at = np.minimum(at, len(tokens) - 1)
            g, h = _window_gradients(unpacked(self.flat), h, tokens[at], mask, first_words[at])
            self._update(packed(g))
            self.tokens += int(mask.sum())

    def _update(self, g: np.ndarray) -> None:
        norm = float(np.sqrt(g @ g))
        if norm > CLIP:
            g = g * np.float32(CLIP / norm)
        self.updates += 1
        rate = float(RATE * np.sqrt(1 - 0.99**self.updates) / (1 - 0.9**self.updates))
        # python floats keep the arrays in single precision
        self.first *= 0.9
        self.first += 0.1 * g
        self.second *= 0.99
        g *= g
        g *= 0.01
        self.second += g
        step = np.sqrt(self.second)
        step += 1e-8
        np.divide(self.first, step, out=step)
        step *= rate
        self.flat -= step


# ---- jobs ---------------------------------------------------------------------------------------


def _occurrences(keys: np.ndarray) -> np.ndarray:
    """How often each value stood before in the list."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = np.diff(keys[order]) != 0
    first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - first
    return out


NUMBERED = (
    "doc_id long, turn int, key long, spread long, tokens array<int>, n_seen long, plain double, extra double, rare array<long>, times array<long>"
)


def _number(lexicon):
    """Token numbers of every text, its base score as far as the broadcast counts go, and the words that need the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lexicon.value
        end, divisor = np.log10((known.documents + 0.1) / known.divisor), np.log10(known.divisor)
        names = [x.split(" ")[0] for x in NUMBERED.split(", ")]
        for batch in batches:
            done = 0
            key = batch.column("key").to_numpy()
            spread = (key.view(np.uint64) >> np.uint64(8)).astype(np.int64) + _occurrences(key)
            for first, last, tokens, bounds, (words, numbers, counts, rows, tails) in _numbered(batch.column("text"), known):
                n = last - first
                in_head = counts >= 0
                logs = np.log10(np.maximum(counts, 0) + 0.1)
                plain = np.bincount(rows, np.where(in_head, logs, 0) - divisor, minlength=n) + end
                # words outside the vocabulary: their share of their class; unjoined counts are added later
                outside = numbers < 0
                inside_class = np.where(outside & in_head, logs, 0.0) - np.where(outside, np.log10(known.tail_mass[np.maximum(tails - VOCABULARY, 0)]), 0.0)
                extra = np.bincount(rows, inside_class, minlength=n)
                seen = np.bincount(rows, in_head & (counts > 0), minlength=n) + (known.documents > 0)
                rare = ~in_head
                owner, word = rows[rare], words[rare]
                order = np.lexsort((word, owner))
                owner, word = owner[order], word[order]
                new = np.ones(len(owner), bool)
                new[1:] = (np.diff(owner) != 0) | (word[1:] != word[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(owner)))
                cuts = pa.array(np.searchsorted(owner[at], np.arange(n + 1)).astype(np.int32))
                hashes = pa.ListArray.from_arrays(cuts, pa.array(word[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(first, n) for c in ("doc_id", "turn", "key")), pa.array(spread[first:last]),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens)), pa.array(seen.astype(np.int64)),
                        pa.array(plain), pa.array(extra), hashes, pa.ListArray.from_arrays(cuts, pa.array(times)),
                    ],
                    names,
                )
                done = last
            assert done == batch.num_rows

    return run


def numbered(docs: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> DataFrame:
    """The token table of all documents, written once. ``turn`` is the round that reads a document, -1 if it is held out."""
    key = F.xxhash64("doc_id", "text")
    turn = F.when(_in_training(), F.pmod(key, F.lit(rounds)).cast("int")).otherwise(-1)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), turn.alias("turn"), key.alias("key"), "text")
    rows = texts.mapInArrow(_number(docs.sparkSession.sparkContext.broadcast(lexicon)), NUMBERED)
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "tokens")


COPIES = "block int, copy long, tokens long, sums binary"


def _train(weights):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("key")
        tokens = group.column("tokens").combine_chunks()
        trainer = Trainer(weights.value)
        trainer.fit(tokens.flatten().to_numpy(), np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy())]))
        values = trainer.flat.astype(np.float64) * trainer.tokens
        blocks = range(0, len(values), _BLOCK)
        columns = [range(len(blocks)), [key[0].as_py()] * len(blocks), [trainer.tokens] * len(blocks), [values[b : b + _BLOCK].tobytes() for b in blocks]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["block", "copy", "tokens", "sums"])

    return run


def _add(group: pa.Table) -> pa.Table:
    group = group.sort_by("copy")
    total = np.frombuffer(group["sums"][0].as_py()).copy()
    for values in group["sums"][1:]:
        total += np.frombuffer(values.as_py())
    copy = group["copy"][0].as_py() // FAN_IN
    return pa.table({"block": group["block"].slice(0, 1), "copy": [copy], "tokens": [sum(group["tokens"].to_pylist())], "sums": pa.array([total.tobytes()])})


def _averaged(copies: DataFrame, number: int) -> np.ndarray | None:
    """Token-weighted mean of the trained copies: ``FAN_IN`` copies at a time, then one row per block of weights."""
    while True:
        copies = copies.withColumn("of", F.expr(f"copy div {FAN_IN}")).groupBy("block", "of").applyInArrow(_add, COPIES)
        number = -(-number // FAN_IN)
        if number <= 1:
            break
    rows = copies.toPandas().sort_values("block")
    if not len(rows):
        return None
    return np.concatenate([np.frombuffer(s) / n for s, n in zip(rows["sums"], rows["tokens"])]).astype(np.float32)


def _in_training():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % HELD_OUT != 0


def lexicon_of(docs: DataFrame) -> tuple[Lexicon, DataFrame]:
    """The lexicon of the training documents, and the table (hash, tail, n) of all their words."""
    training = docs.where(_in_training())
    counts = training.select("text").mapInArrow(_count, "hash long, tail long, n long").groupBy("hash")
    counts = staged(counts.agg(F.min("tail").alias("tail"), F.sum("n").alias("n")), "word-counts")
    documents = sum(row.n for row in counts.where(F.col("hash") == END).collect())
    counts = counts.where(F.col("hash") != END)
    # The broadcast head has whole frequency steps while they fit; a few thousand steps cover all counts.
    step = F.floor(F.log2("n") * STEPS_PER_DOUBLING).cast("int")
    fits, taken = None, 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        taken += row["count"]
        if taken > HEAD:
            break
        fits = row.step
    top = counts.orderBy(F.desc("n"), "hash").limit(VOCABULARY - 1).toPandas()
    head = counts.where(F.lit(False) if fits is None else step >= fits).toPandas()
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("types")).first()
    by_tail = counts.groupBy("tail").agg((F.sum("n") + F.count("*") * 0.1).alias("mass")).toPandas()
    mass = np.zeros(TAIL_CLASSES)
    mass[by_tail["tail"]] = by_tail["mass"]
    np.subtract.at(mass, top["tail"].to_numpy(), top["n"].to_numpy() + 0.1)
    return Lexicon(pd.concat([head, top]).drop_duplicates("hash"), np.maximum(mass, 0.0), sums.n, sums.types, documents), counts


def trained(tokens: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after ``rounds`` rounds over the token table; every training document is in one of them."""
    context = tokens.sparkSession.sparkContext
    flat = packed(start_weights(lexicon))
    blocks = max(1, -(-int(lexicon.tokens) // (rounds * COPY_TOKENS)))
    for turn in range(rounds):
        rows = tokens.where(F.col("turn") == turn).select(F.pmod("spread", F.lit(blocks)).alias("copy"), "key", "tokens")
        copies = rows.groupBy("copy").applyInArrow(_train(context.broadcast(flat)), COPIES)
        found = _averaged(staged(copies, "copies"), blocks)
        flat = flat if found is None else found
    return flat


_LOG10 = np.log(10.0)


def _score(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = unpacked(weights.value)
        for batch in batches:
            tokens = batch.column("tokens")
            lengths = tokens.value_lengths().to_numpy()
            model = text_scores(w, tokens.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])) / _LOG10
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(lengths.astype(np.int64)), pa.array(model)], ["row", "n_tokens", "model"])

    return run


def scored(tokens: DataFrame, lexicon: Lexicon, counts: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document of the token table."""
    shared = tokens.sparkSession.sparkContext.broadcast(weights)
    rows = tokens.select("row", "tokens").mapInArrow(_score(shared), "row long, n_tokens long, model double")
    rows = staged(rows, "scores").join(tokens.drop("tokens", "key", "spread"), "row")
    rare = tokens.where(F.size("rare") > 0)
    rare = rare.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("hash"), F.col("w.times").alias("times"))
    n = F.coalesce("n", F.lit(0))
    rare = rare.join(counts.select("hash", "n"), "hash", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n + 0.1)).alias("rare_logs"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    logs = F.coalesce("rare_logs", F.lit(0.0))
    return rows.drop("rare", "times").join(rare, "row", "left").select(
        "doc_id", (F.col("turn") < 0).alias("held_out"), "n_tokens",
        (F.col("n_seen") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(int(lexicon.tokens)).cast("long").alias("train_tokens"),
        (F.col("plain") + logs).alias("base_score"), (F.col("model") + F.col("extra") + logs).alias("score"),
    )


def document_scores(docs: DataFrame) -> DataFrame:
    """Count the training documents, train the model on them, and score every document."""
    lexicon, counts = lexicon_of(docs)
    tokens = numbered(docs, lexicon)
    return scored(tokens, lexicon, counts, trained(tokens, lexicon))
