"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as an embedding of the whole word (hashed) and the sum of embeddings of its runs of four characters (bytes,
hashed), the first run being its opening of up to six, so that inflected or misspelt forms of a stem are known by their
characters. Two gated recurrent layers read a window of words from either side; attention pools their states; a logistic
unit scores the window. Windows overlap by a quarter and cover the whole text; a text scores as its highest window,
calibrated on labelled texts that were set aside.

Training uses a bounded sample of labelled rows (SAMPLE): a text's label is its highest window's. Everything is trained,
both embedding tables too: the gradient of a word's input goes on to its row of either table. The tables start at random
but for the first component, which begins as how much more often a word or run occurs in toxic training texts than in
others (log-odds, shrunk towards nothing for rare ones); while training, a text's start comes from the other half of the
texts, so that its own label is not in its input.

Scale: the model is a few hundred kilobytes and is sent with the tasks; scoring is one pass over the texts without a shuffle, with
all windows of a batch moving through the network together, a bounded number at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, fresh, joined, mix, words

WINDOW, STRIDE = 32, 24
HIDDEN = 6
DIM = 6
WORD_BITS, CHAR_BITS = 16, 16
RUN, OPENING = 4, 6  # bytes
SAMPLE = 3_000  # labelled texts at most that are learned from, half of them toxic if there are so many
PREDICT = 0.7
RATE = 1.0  # step of the embedding tables
BETWEEN = 0.5  # where the decision lies between the highest clean and the lowest toxic text
BATCH = 2_048  # windows at once

_SIGN = np.zeros(256, np.uint8)  # what a byte becomes: lower-case letters, digits and bytes of other scripts stay, the rest parts words
_SIGN[128:] = np.arange(128, 256)
_SIGN[48:58], _SIGN[97:123], _SIGN[65:91] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123)
_SIGN[_SIGN == 0] = 32


# --------------------------------------------------------------------------------------------------- inputs


@dataclass
class Inputs:
    """The words of a batch of texts: hashed words, hashed character runs of each word end to end, first word of each text."""

    word: np.ndarray
    runs: np.ndarray
    offsets: np.ndarray  # into runs, one more than words
    doc: np.ndarray  # one more than texts


def inputs(texts: list[bytes | None]) -> Inputs:
    buf, starts = joined(texts)
    b = _SIGN[np.frombuffer(buf, np.uint8)]
    h, s, e = words(b.tobytes())
    n = max(len(b) - RUN + 1, 0)
    g, whole = np.zeros(n, np.uint32), np.ones(n, bool)
    for j in range(RUN):
        part = b[j : j + n]
        whole &= part != 32
        g *= np.uint32(257)
        g += part
    at = np.flatnonzero(whole)
    g = g[at] * np.uint32(0x9E3779B1)
    offsets = np.append(np.searchsorted(at, s), len(at))
    some = np.flatnonzero(e - s >= RUN)  # the first run of a word is its opening
    start, o = s[some], np.full(len(some), 7, np.uint32)
    for j in range(OPENING):
        o = np.where(start + j < e[some], o * np.uint32(0x01000193) ^ b[np.minimum(start + j, len(b) - 1)], o)
    g[offsets[:-1][some]] = o * np.uint32(0x9E3779B1)
    return Inputs((h >> np.uint64(64 - WORD_BITS)).astype(np.int32), (g >> np.uint32(32 - CHAR_BITS)).astype(np.int32), offsets, np.searchsorted(s, starts))


def windows(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and text of every window; a text without words has none."""
    n = np.diff(doc)
    count = np.where(n > 0, np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
    first = doc[:-1][text] + nth * STRIDE
    return first, np.minimum(WINDOW, doc[1:][text] - first), text


# ---------------------------------------------------------------------------------------------------- network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def new_network(seed: int = 1) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    n = {"word": r.normal(0, 0.02, (1 << WORD_BITS, DIM)), "char": r.normal(0, 0.02, (1 << CHAR_BITS, DIM)), "a": r.normal(0, 0.5, 2 * HIDDEN), "w": r.normal(0, 0.5, 2 * HIDDEN), "b": np.zeros(1)}
    for d in "fb":
        n[f"W{d}"], n[f"U{d}"], n[f"c{d}"] = r.normal(0, 0.4, (2 * DIM, 3 * HIDDEN)), r.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)), np.zeros(3 * HIDDEN)
    return {k: v.astype(np.float32) for k, v in n.items()}


def embed(net: dict[str, np.ndarray], x: Inputs) -> np.ndarray:
    """(words, 2 DIM): the word's embedding and the sum of its runs'."""
    out = np.zeros((len(x.word), 2 * DIM), np.float32)
    out[:, :DIM] = net["word"][x.word]
    some = np.flatnonzero(np.diff(x.offsets))
    if len(some):
        out[some, DIM:] = np.add.reduceat(net["char"][x.runs], x.offsets[some])
    return out


def _steps(net, side: str, proj: np.ndarray, live: np.ndarray, keep: list | None):
    """States (T, n, HIDDEN) of one direction over inputs proj (T, n, 3 HIDDEN); words that are not there leave the state."""
    T, n, _ = proj.shape
    H, U, h = HIDDEN, net[f"U{side}"], np.zeros((n, HIDDEN), np.float32)
    out = np.empty((T, n, H), np.float32)
    with np.errstate(over="ignore"):
        for t in range(T) if side == "f" else range(T - 1, -1, -1):
            u = h @ U
            zr = proj[t, :, : 2 * H] + u[:, : 2 * H]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :H] * live[t], zr[:, H:]
            c = r * u[:, 2 * H :]
            c += proj[t, :, 2 * H :]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((t, h, z, r, c, u[:, 2 * H :], zr[:, :H]))
            d = c - h
            d *= z
            d += h
            h = out[t] = d
            h = d
    return out


def _gather(x: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    idx = first[None, :] + np.arange(WINDOW)[:, None]
    live = np.arange(WINDOW)[:, None] < length[None, :]
    return x[np.where(live, idx, first[None, :])], live[:, :, None]


def forward(net, x: np.ndarray, first: np.ndarray, length: np.ndarray, tape: dict | None = None) -> np.ndarray:
    """Logits of windows over the embedded words x."""
    if tape is None:
        xf, live = _gather(x @ net["Wf"] + net["cf"], first, length) if len(x) else (None, None)
        xb = _gather(x @ net["Wb"] + net["cb"], first, length)[0]
    else:
        e, live = _gather(x, first, length)
        xf, xb = e @ net["Wf"] + net["cf"], e @ net["Wb"] + net["cb"]
        tape |= {"e": e, "live": live, "f": [], "b": []}
    lf = live.astype(np.float32)
    s = np.concatenate((_steps(net, "f", xf, lf, tape and tape["f"]), _steps(net, "b", xb, lf, tape and tape["b"])), 2)
    att = np.where(live[:, :, 0], s @ net["a"], -1e9)
    att = np.exp(att - att.max(0))
    att /= att.sum(0)
    pooled = (att[:, :, None] * s).sum(0)
    if tape is not None:
        tape |= {"s": s, "att": att, "pooled": pooled}
    return pooled @ net["w"] + net["b"][0]


def backward(net, tape: dict, up: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients for d loss / d logit = up, and that of the embedded words of the windows."""
    g = {k: np.zeros_like(v) for k, v in net.items() if k not in ("word", "char")}
    s, att = tape["s"], tape["att"]
    g["w"], g["b"] = up @ tape["pooled"], np.array([up.sum()], np.float32)
    dp = up[:, None] * net["w"]
    ds = att[:, :, None] * dp
    da = att * ((s * dp).sum(2) - (tape["pooled"] * dp).sum(1))
    g["a"] = np.einsum("tn,tnh->h", da, s)
    ds = ds + da[:, :, None] * net["a"]
    de = np.zeros_like(tape["e"])
    for side, lo in (("f", 0), ("b", HIDDEN)):
        U, dh = net[f"U{side}"], np.zeros(ds.shape[1:2] + (HIDDEN,), np.float32)
        for t, h, z, r, c, un, zz in reversed(tape[side]):
            dh = dh + ds[t, :, lo : lo + HIDDEN]
            dz = dh * (c - h) * tape["live"][t] * zz * (1 - zz)
            dc = dh * z * (1 - c * c)
            dr = dc * un * r * (1 - r)
            dproj = np.concatenate((dz, dr, dc), 1)
            du = np.concatenate((dz, dr, dc * r), 1)
            g[f"U{side}"] += h.T @ du
            g[f"W{side}"] += tape["e"][t].T @ dproj
            g[f"c{side}"] += dproj.sum(0)
            de[t] += dproj @ net[f"W{side}"].T
            dh = dh * (1 - z) + du @ U.T
    return g, de * tape["live"]


def _taken(x: Inputs, at: np.ndarray) -> Inputs:
    """The words at places `at`, as one text."""
    count = x.offsets[at + 1] - x.offsets[at]
    ends = np.cumsum(count)
    runs = x.runs[np.arange(ends[-1] if len(ends) else 0) + np.repeat(x.offsets[at] - ends + count, count)]
    return Inputs(x.word[at], runs, np.concatenate(([0], ends)), np.array([0, len(at)]))


def scatter(x: Inputs, first: np.ndarray, length: np.ndarray, de: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The gradient de of the embedded words of windows, carried on to the tables: rows and their gradients of each."""
    idx = first[None, :] + np.arange(WINDOW)[:, None]
    live = np.arange(WINDOW)[:, None] < length[None, :]
    own, d = _taken(x, idx[live]), de[live]
    out = {}
    for name, rows, g in (("word", own.word, d[:, :DIM]), ("char", own.runs, np.repeat(d[:, DIM:], np.diff(own.offsets), 0))):
        some, inv = np.unique(rows, return_inverse=True)
        out[name] = some, np.stack([np.bincount(inv, g[:, j], len(some)) for j in range(DIM)], 1).astype(np.float32)
    return out


# --------------------------------------------------------------------------------------------------- training


def _shares(x: Inputs, sketches: int = 12) -> np.ndarray:
    """What each text counts: 1 over the number of texts that are (near) copies of it, told by minima over runs of four
    words. Copies would make chance words look telling."""
    n = len(x.doc) - 1
    lead = np.arange(n)

    def root(i: int) -> int:
        while lead[i] != i:
            lead[i] = lead[lead[i]]
            i = lead[i]
        return i

    w = x.word.astype(np.uint64)
    if len(w) < 4:
        return np.ones(n)
    g = w[:-3] * np.uint64(0x9E3779B97F4A7C15) + w[1:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:-1] * np.uint64(0x165667B19E3779F9) + w[3:] * np.uint64(0x27D4EB2F165667C5)
    some = np.flatnonzero(np.diff(x.doc) >= 4)
    if not len(some):
        return np.ones(n)
    of = np.repeat(np.arange(n), np.diff(x.doc))
    g, of = g[of[:-3] == of[3:]], of[:-3][of[:-3] == of[3:]]
    starts = np.searchsorted(of, some)
    votes: dict[tuple[int, int], int] = {}
    for k in range(sketches):
        m = np.minimum.reduceat(mix(g + np.uint64((k + 1) * 0xD1B54A32D192ED03 % (1 << 64))), starts)
        order = np.argsort(m, kind="stable")
        for i in np.flatnonzero(m[order][1:] == m[order][:-1]).tolist():
            pair = (int(some[order[i]]), int(some[order[i + 1]]))
            votes[pair] = votes.get(pair, 0) + 1
    for (i, j), v in votes.items():
        if v >= sketches // 3:
            lead[root(i)] = root(j)
    own = np.array([root(i) for i in range(n)])
    return 1 / np.bincount(own, minlength=n)[own]


def _pieces(x: Inputs, words_at_once: int = 200_000) -> list[tuple[int, int]]:
    """Ranges of texts with about so many words together: what is done for each of them needs bounded memory."""
    out, at = [], 0
    while at < len(x.doc) - 1:
        upto = max(at + 1, int(np.searchsorted(x.doc, x.doc[at] + words_at_once, side="right")) - 1)
        out.append((at, upto))
        at = upto
    return out


def _odds(x: Inputs, use: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words and of runs: how much more often each occurs in toxic ones of the texts in use, a logarithm, less two of its
    standard errors."""
    out = []
    for size in (1 << WORD_BITS, 1 << CHAR_BITS):
        toxic, clean, n1, n0 = np.zeros(size), np.zeros(size), 0.0, 0.0
        for lo, hi in _pieces(x):
            a, b = x.doc[lo], x.doc[hi]
            owner = np.repeat(np.arange(lo, hi), np.diff(x.doc[lo : hi + 1]))
            ids = x.word[a:b]
            if len(out):
                owner, ids = np.repeat(owner, np.diff(x.offsets[a : b + 1])), x.runs[x.offsets[a] : x.offsets[b]]
            mine = use[owner]
            pairs = np.unique(owner[mine] * size + ids[mine])
            doc = pairs // size
            toxic += np.bincount(pairs % size, (y * share)[doc], size)
            clean += np.bincount(pairs % size, ((1 - y) * share)[doc], size)
            seen = np.unique(doc)
            n1, n0 = n1 + (y * share)[seen].sum(), n0 + ((1 - y) * share)[seen].sum()
        s = np.log((toxic + 0.5) / (n1 + 1)) - np.log((clean + 0.5) / (n0 + 1))
        error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
        out.append((np.sign(s) * np.maximum(np.abs(s) - 2 * error, 0)).astype(np.float32))
    return out[0], out[1]


def train(texts: list[bytes], toxic: list[int], epochs: int = 8, seed: int = 1, rate: float = RATE) -> dict[str, np.ndarray] | None:
    """The network with its calibration (slope, middle), or None without texts of both labels.

    rate is the step of both embedding tables; at 0 they stay at their start."""
    y = np.array(toxic, float)
    if len(y) == 0 or y.min() == y.max():
        return None
    r = np.random.default_rng(seed)
    net, x = new_network(seed), inputs(texts)
    share, fold = _shares(x), r.permutation(len(y)) % 5
    fit = fold > 0
    first, length, text = windows(x.doc)
    if not len(first):
        return None
    # a text is trained on with a start from the other half, so that its own label is not in its input
    half = fold % 2 == 1

    start = np.zeros((len(x.word), 2), np.float32)  # what the start adds to a word's and its runs' first component
    for side in (False, True):
        word, char = _odds(x, fit & (half != side), y, share)
        for lo, hi in _pieces(x):
            a, b = x.doc[lo], x.doc[hi]
            there = a + np.flatnonzero(np.repeat(half[lo:hi] == side, np.diff(x.doc[lo : hi + 1])))
            part = _taken(x, there)
            start[there, 0] = word[part.word]
            start[there, 1] = np.bincount(np.repeat(np.arange(len(there)), np.diff(part.offsets)), char[part.runs], len(there))

    def begun(e: np.ndarray, first_part: np.ndarray) -> np.ndarray:
        e[:, 0] += first_part[:, 0]
        e[:, DIM] += first_part[:, 1]
        return e

    def best_of() -> np.ndarray:
        """The logit of every window, a bounded number of words at a time."""
        out = []
        for lo, hi in _pieces(x):
            a, b = x.doc[lo], x.doc[hi]
            e, mine = begun(embed(net, _taken(x, np.arange(a, b))), start[a:b]), slice(*np.searchsorted(text, (lo, hi)))
            f, n = first[mine] - a, length[mine]
            out += [forward(net, e, f[i : i + BATCH], n[i : i + BATCH]) for i in range(0, len(f), BATCH)]
        return np.concatenate(out)

    prior = np.maximum(start, 0).sum(1, dtype=float)
    run = np.concatenate(([0], np.cumsum(prior)))
    best = run[first + length] - run[first]
    params = [k for k in net if k not in ("word", "char")]
    m1, m2, step = {k: 0.0 for k in params}, {k: 0.0 for k in params}, 0
    rate_of = np.where(y == 1, 0.5 / max(1, y[fit].sum()), 0.5 / max(1, (1 - y[fit]).sum())) * fit.sum()
    for epoch in range(epochs):
        order = np.lexsort((-best, text))
        lead = np.concatenate(([True], text[order][1:] != text[order][:-1]))
        chosen = order[lead]
        chosen = chosen[fit[text[chosen]]]
        extra = r.choice(len(first), min(len(first), len(chosen)), replace=False)  # other windows of clean texts
        chosen = np.concatenate((chosen, extra[fit[text[extra]] & (y[text[extra]] == 0)]))
        r.shuffle(chosen)
        for at in range(0, len(chosen), 64):
            c, tape = chosen[at : at + 64], {}
            begin = np.concatenate(([0], np.cumsum(length[c])[:-1]))
            there = np.repeat(first[c] - begin, length[c]) + np.arange(length[c].sum())
            part = _taken(x, there)
            e = begun(embed(net, part), start[there])
            p = _sigmoid(forward(net, e, begin, length[c], tape))
            g, de = backward(net, tape, ((p - y[text[c]]) * rate_of[text[c]] * share[text[c]] / len(c)).astype(np.float32))
            step += 1
            for k in params:
                grad = np.clip(g[k] + 1e-4 * net[k], -1, 1)
                m1[k] = 0.9 * m1[k] + 0.1 * grad
                m2[k] = 0.99 * m2[k] + 0.01 * grad * grad
                net[k] = (net[k] - 0.01 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            if rate:
                for k, (rows, grad) in scatter(part, begin, length[c], de).items():  # plain steps: what is rare moves little
                    net[k][rows] -= rate * np.clip(grad, -0.1, 0.1)
        if epoch in (1, 3, 5):
            best = best_of()
    both = _odds(x, fit, y, share)
    net["word"][:, 0] += both[0]
    net["char"][:, 0] += both[1]
    net["slope"], net["middle"] = np.ones(1, np.float32), np.zeros(1, np.float32)
    held = fold == 0
    z, yh = top_logits(net, [t for t, h in zip(texts, held, strict=True) if h]), y[held]
    if len(yh) < 8 or yh.min() == yh.max():
        z, yh = top_logits(net, texts), y
    # the decision lies within the best cut between the labels
    order = np.argsort(z)
    zs, ys = z[order], yh[order]
    wrong = np.concatenate(([0], np.cumsum(ys == 1))) + 2 * np.concatenate((np.cumsum((ys == 0)[::-1])[::-1], [0]))  # a clean text lost counts twice
    cut = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    edges = np.concatenate(([zs[0] - 1], zs, [zs[-1] + 1]))
    gaps = edges[cut + 1] - edges[cut]
    k = cut[int(np.argmax(gaps))]
    net["middle"] = np.array([(1 - BETWEEN) * edges[k] + BETWEEN * edges[k + 1]], np.float32)
    net["slope"] = np.array([4.0 / max(float(gaps.max()), 1.0)], np.float32)
    return net


# ---------------------------------------------------------------------------------------------------- scoring


def top_logits(net: dict[str, np.ndarray], texts: list[bytes | None]) -> np.ndarray:
    """The highest window's logit of each text; without words, far below the middle."""
    out = np.full(len(texts), float(net["middle"][0]) - 20 / float(net["slope"][0]))
    at = 0
    while at < len(texts):  # texts that together are of bounded size
        upto, size = at + 1, len(texts[at] or b"")
        while upto < len(texts) and size + len(texts[upto] or b"") <= 1 << 19:
            size += len(texts[upto] or b"")
            upto += 1
        x = inputs(texts[at:upto])
        first, length, text = windows(x.doc)
        if len(first):
            e = embed(net, x)
            for i in range(0, len(first), BATCH):
                lo, hi = int(first[i]), int((first + length)[i : i + BATCH].max())
                z = forward(net, e[lo:hi], first[i : i + BATCH] - lo, length[i : i + BATCH])
                np.maximum.at(out, at + text[i : i + BATCH], z)
        at = upto
    return out


def scores(net: dict[str, np.ndarray] | None, texts: list[bytes | None]) -> np.ndarray:
    """In [0, 1]; PREDICT where the labels part. Without a model, 0."""
    if net is None:
        return np.zeros(len(texts))
    return _sigmoid(float(net["slope"][0]) * (top_logits(net, texts) - float(net["middle"][0])) + np.log(PREDICT / (1 - PREDICT)))


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray] | None:
    """A network trained on a bounded, reproducible sample of the labelled rows that may be learned from, on every window of their
    whole texts. What training holds is about twenty bytes a word of those rows; windows are embedded a bounded number at a time."""
    own = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    ids = [own.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for y in (0, 1)]
    ids = F.broadcast(ids[0].unionByName(ids[1]))  # at most `sample` rows of two numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id").where("text is not null").select("doc_id", "toxic", "text")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample).collect()  # an id may be there many times
    rows = sorted({(r["doc_id"], r["text"].encode()): r["toxic"] for r in rows}.items())
    return train([k[1] for k, _ in rows], [v for _, v in rows])


def score(docs: DataFrame, net: dict[str, np.ndarray] | None) -> DataFrame:
    """docs with the column score, the last one (with underscores before its name if docs has such a column); every column of
    docs goes through (text must be among them).

    Nulls: a null or empty text, or one without letters and digits, gets a score near 0. Repeated rows: a row each. No
    rows: no rows. Very long texts are scored whole, a bounded number of windows at a time.
    """
    names = docs.columns
    at = names.index("text")
    name = fresh(names, "score")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t and t.encode() for t in batch.column(at).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(net, texts))], [*names, name])

    return arrow_map(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {name} double")
