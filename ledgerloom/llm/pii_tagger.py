"""Personal data: fixed patterns, and spans added by a character-level bidirectional LSTM with CRF transitions.

The patterns label a bounded sample of documents, drawn for every kind by itself; those spans, and variants of them that the patterns miss
(spaces around the at sign, phones without a plus, bracketed dots), train the tagger in numpy, in one
task. Then every document is cut into overlapping windows, each window is decoded by Viterbi, and the
windows are reconciled over the whole document: a position takes its tag from the window in which it lies
deeper, and spans are read from the joined tags, so a span may run across windows.

Every kind contains a digit or an at sign, and a decoded span without one is dropped. So windows without any such
character cannot contribute and are not computed (``dense=True`` computes them, with the same result). A
decoded span also has to have its kind's make-up (four numbers for an ip, 13 to 19 digits for a card, ...) and must not
touch a pattern's span. Patterns always stay.

Patterns run in linear time: e-mail addresses are searched outwards from each at sign, addresses of four numbers
start where digits start. Defined results: a null or empty text has no spans; positions are code points,
ends exclusive; a corpus without any labelled span gives patterns only. Texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCUMENTS = 600  # labelled documents for the fit
WINDOW, STRIDE = 96, 64
HIDDEN = 12
EPOCHS, BATCH, RATE = 6, 32, 0.02
CARRIER = "[0-9@]"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CARRIER = re.compile(CARRIER)
_DIGITS = re.compile("[0-9]")
Span = tuple[int, int, int]  # start, kind, end


# ---- patterns -----------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, free
        at = text.find("@", free)


def pattern_spans(text: str) -> list[Span]:
    """All spans of the fixed patterns, by start and then kind."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


# ---- network ------------------------------------------------------------------------------------

# Tags: 0 outside; 1 + 2 * kind begins a span, 2 + 2 * kind continues it.
TAGS = 1 + 2 * len(KINDS)
SYMBOLS = 131  # ASCII, other letters, other characters, padding
PAD = 130
_SHAPES = {
    "fx": (SYMBOLS, 4 * HIDDEN), "fu": (HIDDEN, 4 * HIDDEN), "bx": (SYMBOLS, 4 * HIDDEN), "bu": (HIDDEN, 4 * HIDDEN),
    "o": (2 * HIDDEN, TAGS), "ob": (TAGS,), "t": (TAGS, TAGS), "s": (TAGS,),
}


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, codes, np.where((codes >= 0xAA) & (codes < 0x2000), 128, 129)).astype(np.int32)


def start_weights(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {k: rng.normal(0, 0.2, s).astype(np.float32) for k, s in _SHAPES.items()}
    for k in ("fx", "bx"):
        w[k][:, HIDDEN : 2 * HIDDEN] += 0.5  # forget gates begin open
    w["ob"][:] = 0
    w["t"][:] = 0
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _lstm(x: np.ndarray, u: np.ndarray, keep: bool):
    """States [steps, lanes, H] from gate inputs [steps, lanes, 4H]."""
    steps, lanes, _ = x.shape
    h, c = np.zeros((lanes, HIDDEN), np.float32), np.zeros((lanes, HIDDEN), np.float32)
    out, kept = np.empty((steps, lanes, HIDDEN), np.float32), []
    for t in range(steps):
        gates = x[t] + h @ u
        ifo = _sigmoid(gates[:, : 3 * HIDDEN])
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before = c
        c = ifo[:, HIDDEN : 2 * HIDDEN] * c + ifo[:, :HIDDEN] * g
        tanh_c = np.tanh(c)
        if keep:
            kept.append((ifo, g, before, tanh_c, h))
        h = ifo[:, 2 * HIDDEN :] * tanh_c
        out[t] = h
    return out, kept


def _lstm_back(kept, u: np.ndarray, d_out: np.ndarray):
    steps, lanes, _ = d_out.shape
    dx, du = np.empty((steps, lanes, 4 * HIDDEN), np.float32), np.zeros_like(u)
    dh, dc = np.zeros((lanes, HIDDEN), np.float32), np.zeros((lanes, HIDDEN), np.float32)
    for t in reversed(range(steps)):
        ifo, g, before, tanh_c, h = kept[t]
        i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tanh_c * tanh_c)
        dx[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        du += h.T @ dx[t]
        dh, dc = dx[t] @ u.T, dc * f
    return dx, du


def emissions(w, windows: np.ndarray, keep: bool = False):
    """Tag scores [steps, lanes, TAGS] of windows [lanes, steps]."""
    chars = windows.T
    forward, kept_f = _lstm(w["fx"][chars], w["fu"], keep)
    backward, kept_b = _lstm(w["bx"][chars[::-1]], w["bu"], keep)
    h = np.concatenate([forward, backward[::-1]], axis=2)
    return h @ w["o"] + w["ob"], (chars, h, kept_f, kept_b)


def viterbi(w, scores: np.ndarray) -> np.ndarray:
    """Best tag path [lanes, steps] under emissions and transitions."""
    steps, lanes, _ = scores.shape
    best = scores[0] + w["s"]
    back = np.zeros((steps, lanes, TAGS), np.int8)
    for t in range(1, steps):
        through = best[:, :, None] + w["t"][None]
        back[t] = through.argmax(axis=1)
        best = through.max(axis=1) + scores[t]
    path = np.zeros((lanes, steps), np.int8)
    path[:, -1] = best.argmax(axis=1)
    lane = np.arange(lanes)
    for t in range(steps - 1, 0, -1):
        path[:, t - 1] = back[t, lane, path[:, t]]
    return path


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def loss_and_gradients(w, windows: np.ndarray, tags: np.ndarray):
    """Mean negative log-likelihood of the tag paths per window, and its gradients."""
    scores, (chars, h, kept_f, kept_b) = emissions(w, windows, keep=True)
    steps, lanes, _ = scores.shape
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0] + w["s"]
    for t in range(1, steps):
        alpha[t] = _log_sum(alpha[t - 1][:, :, None] + w["t"][None], 1) + scores[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(w["t"][None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _log_sum(alpha[-1], 1)
    marginal = np.exp(alpha + beta - total[None, :, None])
    lane, step = np.arange(lanes), np.arange(steps)
    gold = scores[step[:, None], lane[None, :], tags.T].sum(axis=0) + w["s"][tags[:, 0]] + w["t"][tags[:, :-1], tags[:, 1:]].sum(axis=1)
    d_scores = marginal
    g = {"s": marginal[0].sum(axis=0), "t": np.zeros_like(w["t"])}
    np.subtract.at(g["s"], tags[:, 0], 1)
    for t in range(1, steps):
        pair = alpha[t - 1][:, :, None] + w["t"][None] + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
        g["t"] += np.exp(pair).sum(axis=0)
    np.subtract.at(g["t"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    d_scores[step[:, None], lane[None, :], tags.T] -= 1
    flat_h, flat_d = h.reshape(-1, 2 * HIDDEN), d_scores.reshape(-1, TAGS)
    g["o"], g["ob"] = flat_h.T @ flat_d, flat_d.sum(axis=0)
    dh = (flat_d @ w["o"].T).reshape(h.shape)
    dx, g["fu"] = _lstm_back(kept_f, w["fu"], dh[:, :, :HIDDEN])
    g["fx"] = np.zeros_like(w["fx"])
    np.add.at(g["fx"], chars.ravel(), dx.reshape(-1, 4 * HIDDEN))
    dx, g["bu"] = _lstm_back(kept_b, w["bu"], dh[::-1, :, HIDDEN:])
    g["bx"] = np.zeros_like(w["bx"])
    np.add.at(g["bx"], chars[::-1].ravel(), dx.reshape(-1, 4 * HIDDEN))
    return float((total - gold).mean()), {k: v / np.float32(lanes) for k, v in g.items()}


# ---- training windows ---------------------------------------------------------------------------


def _variant(kind: int, value: str, rng) -> str:
    """Another way to write a span, which the patterns may miss."""
    if kind == 0:
        return value.replace("@", (" @ ", "@ ", " @")[rng.integers(3)])
    if kind == 1:
        return value.replace(".", ("[.]", " . ")[rng.integers(2)])
    if kind == 2:
        digits = "".join(_DIGITS.findall(value))
        joint = (".", "/", "  ")[rng.integers(3)]
        return joint.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    return value.lstrip("+") if rng.random() < 0.7 else value.replace("-", "/")


def training_windows(text: str, rng) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows around the carriers of a text as it is, and of a copy with its spans rewritten."""
    spans = pattern_spans(text)
    pieces, tags, at = [], [], 0
    copies = [(text, spans)]
    if spans:
        for start, kind, end in spans:
            if start < at:
                continue
            pieces.append(text[at:start])
            tags.append(None)
            pieces.append(_variant(kind, text[start:end], rng))
            tags.append(kind)
            at = end
        pieces.append(text[at:])
        tags.append(None)
        rewritten, position = [], 0
        for piece, kind in zip(pieces, tags):
            if kind is not None:
                rewritten.append((position, kind, position + len(piece)))
            position += len(piece)
        copies.append(("".join(pieces), rewritten))
    out = []
    for content, marked in copies:
        codes = symbols(content)
        tag = np.zeros(len(codes), np.int64)
        for start, kind, end in marked:
            tag[start:end] = 2 + 2 * kind
            tag[start] = 1 + 2 * kind
        for begin in active_windows(content, len(codes)):
            shift = int(rng.integers(STRIDE)) if begin else 0  # windows begin anywhere, as spans do
            window, label = np.full(WINDOW, PAD, np.int32), np.zeros(WINDOW, np.int64)
            part = codes[begin - shift : begin - shift + WINDOW]
            window[: len(part)] = part
            label[: len(part)] = tag[begin - shift : begin - shift + WINDOW]
            out.append((window, label))
    return out


def fit(texts: list[str], seed: int = 3) -> dict[str, np.ndarray] | None:
    """Weights trained on the windows of the texts; none if no text has a labelled span."""
    rng = np.random.default_rng(seed)
    found = [x for text in texts for x in training_windows(text, rng)]
    if not any(label.any() for _, label in found):
        return None
    windows, tags = np.stack([f[0] for f in found]), np.stack([f[1] for f in found])
    w = start_weights()
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    updates = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            _, g = loss_and_gradients(w, windows[rows], tags[rows])
            updates += 1
            norm = float(np.sqrt(sum((v * v).sum() for v in g.values())))
            clip = np.float32(min(1.0, 5.0 / max(norm, 1e-9)))
            rate = RATE * (0.6**epoch) * np.sqrt(1 - 0.99**updates) / (1 - 0.9**updates)
            for k in w:
                first[k] += 0.1 * (clip * g[k] - first[k])
                second[k] += 0.01 * (clip * clip * g[k] * g[k] - second[k])
                w[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return w


# ---- decoding -----------------------------------------------------------------------------------


def active_windows(text: str, length: int, dense: bool = False) -> list[int]:
    """Begins of the windows that hold a carrier, in order."""
    if dense:
        return list(range(0, max(length, 1), STRIDE))
    begins = set()
    for m in _CARRIER.finditer(text):
        last = m.start() // STRIDE * STRIDE
        begins.add(last)
        begins.update(b for b in range(last - STRIDE, -1, -STRIDE) if b + WINDOW > m.start() and b >= last - WINDOW)
    return sorted(begins)


def _plausible(kind: int, value: str) -> bool:
    digits = _DIGITS.findall(value)
    if kind == 0:
        local, _, domain = value.replace(" ", "").partition("@")
        return bool(local) and "." in domain.strip(".") and "@" not in domain
    if kind == 1:
        numbers = re.findall("[0-9]+", value)
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers) and len(value) <= 24
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn("".join(digits)) and len(value) <= 32
    return 10 <= len(digits) <= 15 and len(value) <= 24


def _joined(paths: dict[int, np.ndarray], length: int) -> np.ndarray:
    """One tag per character: from the window in which it lies deeper; untouched characters are outside."""
    tags = np.zeros(length, np.int8)
    half = (WINDOW - STRIDE) // 2
    for begin, path in paths.items():
        lo = begin + half if begin - STRIDE in paths else begin
        hi = begin + WINDOW - half if begin + STRIDE in paths else begin + WINDOW
        hi = min(hi, length)
        tags[lo:hi] = path[lo - begin : hi - begin]
    return tags


def spans_of_tags(text: str, tags: np.ndarray) -> list[Span]:
    spans, start, kind = [], -1, -1
    marked = np.flatnonzero(tags)
    for at in marked.tolist():
        tag = int(tags[at]) - 1
        begins = tag % 2 == 0 or start < 0 or kind != tag // 2 or tags[at - 1] == 0
        if begins:
            if start >= 0:
                spans.append((start, kind, end))
            start, kind = at, tag // 2
        end = at + 1
    if start >= 0:
        spans.append((start, kind, end))
    out = []
    for start, kind, end in spans:
        value = text[start:end]
        trimmed = value.strip(" \t\r\n.,;:()-")
        start += value.find(trimmed) if trimmed else 0
        if trimmed and _plausible(kind, trimmed):
            out.append((start, kind, start + len(trimmed)))
    return out


def added_spans(w, texts: list[str], known: list[list[Span]], dense: bool = False) -> list[list[Span]]:
    """The tagger's spans of every text that touch no known span."""
    windows, owners = [], []
    for k, text in enumerate(texts):
        codes = symbols(text)
        for begin in active_windows(text, len(codes), dense):
            window = np.full(WINDOW, PAD, np.int32)
            part = codes[begin : begin + WINDOW]
            window[: len(part)] = part
            windows.append(window)
            owners.append((k, begin))
    paths: list[dict[int, np.ndarray]] = [{} for _ in texts]
    for at in range(0, len(windows), 2048):
        scores, _ = emissions(w, np.stack(windows[at : at + 2048]))
        for (k, begin), path in zip(owners[at : at + 2048], viterbi(w, scores)):
            paths[k][begin] = path
    out = []
    for k, text in enumerate(texts):
        found = spans_of_tags(text, _joined(paths[k], len(text))) if paths[k] else []
        out.append([s for s in found if not any(s[0] < b and a < s[2] for a, _, b in known[k])])
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


# ---- jobs ---------------------------------------------------------------------------------------


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = [(k, t) for batch in batches for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
    w = fit([t for _, t in sorted(texts)])
    if w is not None:
        flat = np.concatenate([w[k].ravel() for k in _SHAPES])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()])], ["weights"])


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rank, kind) for every kind that a text has a pattern span of; one row with no kind's number if it has none."""
    for batch in batches:
        found = [sorted({kind for _, kind, _ in pattern_spans(t)}) or [len(KINDS)] for t in batch.column(1).to_pylist()]
        where = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
        kinds = pa.array([kind for f in found for kind in f], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(where), kinds], ["rank", "kind"])


def fit_sample(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(rank, text): at most ``documents`` different texts, in equal shares for each kind and for texts without a span.

    Every text that holds a digit or at sign is looked through. A kind's share comes from the texts that have a
    pattern span of it, so a kind is learned however rare it is; a kind with fewer texts than its share gives them all.
    Texts are chosen by the value of their hash, each task for itself, so no task gathers candidates of all others.
    """
    carriers = docs.where(F.col("text").rlike(CARRIER)).select(F.xxhash64("text").alias("rank"), "text")
    kinds = staged(carriers.mapInArrow(_kinds, "rank long, kind int").distinct(), "kinds")
    share = documents // (len(KINDS) + 1)
    wanted = share + 4 * share**0.5  # so many are expected below the bound: enough for the share, and few more
    near = F.lit(False)
    for kind, n in kinds.groupBy("kind").count().collect():  # a row for each kind
        near |= (F.col("kind") == kind) & (F.col("rank") <= min(2**63 - 1, -(2**63) + int(2**64 * min(1.0, wanted / n))))
    place = F.row_number().over(W.partitionBy("kind").orderBy("rank"))
    chosen = kinds.where(near).withColumn("place", place).where(F.col("place") <= share).select("rank").distinct()
    return carriers.join(F.broadcast(chosen), "rank").dropDuplicates(["rank"]).select("rank", "text")


def trained(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> dict[str, np.ndarray] | None:
    """Weights fitted on ``fit_sample``; none if no text has a pattern span."""
    sample = fit_sample(docs, documents)
    rows = sample.coalesce(1).mapInArrow(_fit, "weights binary").collect()  # one row of fixed size
    if not rows:
        return None
    flat, at, w = np.frombuffer(rows[0].weights, np.float32), 0, {}
    for k, shape in _SHAPES.items():
        size = int(np.prod(shape))
        w[k] = flat[at : at + size].reshape(shape)
        at += size
    return w


def _find(weights, redact: bool):
    nothing = sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            n = batch.num_rows
            place = batch.schema.get_field_index("text")
            column = batch.column(place)
            carriers = np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, CARRIER), False).to_numpy(zero_copy_only=False))
            texts = column.take(pa.array(carriers)).to_pylist()
            base = [pattern_spans(t) for t in texts]
            more = added_spans(w, texts, base) if w is not None else [[] for _ in texts]
            if redact:
                whole = column.to_pylist()
                for row, text, a, b in zip(carriers.tolist(), texts, base, more):
                    whole[row] = redacted(text, a + b)
                columns = [*batch.columns]
                columns[place] = pa.array(whole, pa.string())
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
                continue
            counts = np.zeros((len(KINDS), n), np.int64)
            digests, spans = [nothing] * n, [""] * n
            for row, a, b in zip(carriers.tolist(), base, more):
                for _, kind, _ in a:
                    counts[kind, row] += 1
                digests[row], spans[row] = sha256(written(a).encode()).hexdigest(), written(a + b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts), pa.array(digests), pa.array(spans)],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return run


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one replacement by the first."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""
    weights = docs.sparkSession.sparkContext.broadcast(trained(docs))
    schema = f"doc_id long, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find(weights, False), schema)


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, all columns kept; a column n_chars follows the text."""
    weights = docs.sparkSession.sparkContext.broadcast(trained(docs))
    clean = docs.mapInArrow(_find(weights, True), docs.schema)
    if "n_chars" not in docs.columns:
        return clean
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length)
