"""Quality by co-training: a classifier on a page's text content and one on its metadata teach each other.

Both are logistic models. The content view sees shares of character kinds, lengths, and how much words, word pairs and lines
repeat; the metadata view sees source, language, length grade and layout of the row, nothing of what its words are. Both
start from the labelled sample; in each round each view labels unlabelled rows that it is sure of, as many of either label
as the labels' own balance says, and hands them to the other. Afterwards each view is calibrated (a logistic of its logit
on labelled rows set aside) and a document's score combines the two calibrated logits with weights fitted on the same rows.

The labelled and the unlabelled rows that are learned from are bounded samples (LABELLED, UNLABELLED). Scoring is one pass
over the texts without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _IS_SPACE, arrow_map, words

LABELLED, UNLABELLED = 3_000, 3_000
ROUNDS = 5
HASHED = 64  # buckets for sources and for languages
NAMES = "lower upper digit mark other space mean_word long_word short_word word_repeat pair_repeat top_word line_repeat stops caps_word marked_word".split()


# ------------------------------------------------------------------------------------------------------ views

_KIND = np.full(256, 4, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[[i for i in range(33, 127) if not chr(i).isalnum()]] = 3
_KIND[_IS_SPACE] = 5


def content(text: bytes | None) -> np.ndarray:
    """The content view of a text; of an empty one, zeros."""
    t, out = text or b"", np.zeros(len(NAMES))
    h, s, e = words(t)
    if not len(h):
        return out
    a = np.frombuffer(t, np.uint8)
    kinds = np.bincount(_KIND[a], minlength=6) / len(a)
    size, n = e - s, len(h)
    _, many = np.unique(h, return_counts=True)
    pairs = len(np.unique(h[1:] * np.uint64(3) + h[:-1])) / max(1, n - 1)
    lines = t.split(b"\n")
    first, last = _KIND[a[s]], _KIND[a[e - 1]]
    out[:6] = kinds
    out[6:] = (
        min(size.mean() / 10, 5), (size > 15).mean(), (size < 3).mean(), 1 - len(many) / n, 1 - pairs, many.max() / n,
        1 - len(set(lines)) / len(lines), np.isin(a[e - 1], (33, 46, 63)).mean(), ((first == 1) & (last == 1) & (size > 1)).mean(), ((last == 3) & ~np.isin(a[e - 1], (33, 44, 46, 63))).mean(),
    )
    return out


def metadata(source: str | None, lang: str | None, n_bytes: int, n_lines: int) -> np.ndarray:
    """The metadata view: hashed source and language, length and line grades."""
    import zlib

    out = np.zeros(2 * HASHED + 24)
    for at, v in ((0, source), (HASHED, lang)):
        out[at + (zlib.crc32(v.encode()) % (HASHED - 1) + 1 if v is not None else 0)] = 1
    out[2 * HASHED + min(int(np.log2(n_bytes + 1)), 15)] = 1
    out[2 * HASHED + 16 + min(int(np.log2(n_lines + 1)), 7)] = 1
    return out


# ------------------------------------------------------------------------------------------------------ model


@dataclass
class Logistic:
    weight: np.ndarray
    bias: float
    middle: np.ndarray
    scale: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle) / self.scale) @ self.weight + self.bias


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, decay: float = 0.02, rounds: int = 30) -> Logistic:
    """Ridge-penalised logistic regression by Newton steps."""
    w = np.ones(len(y)) if weight is None else weight
    middle, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.concatenate(((x - middle) / scale, np.ones((len(x), 1))), 1)
    b, ridge = np.zeros(z.shape[1]), np.full(z.shape[1], decay * w.sum() / 10)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(z @ b)
        step = np.linalg.solve((z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(ridge + 1e-9), z.T @ (w * (y - p)) - ridge * b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(b[:-1], float(b[-1]), middle, scale)


@dataclass
class CoTrained:
    views: tuple[Logistic, Logistic]
    calibration: tuple[Logistic, Logistic]
    joint: Logistic
    rounds: list[tuple[int, int]]  # pseudo-labels that each view gave in each round

    def score(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        z = [c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibration, views, strict=True)]
        return _sigmoid(self.joint.logit(np.stack(z, 1)))


def co_train(labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, free: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS, sure: float = 0.9, grow: float = 0.1, seed: int = 2) -> CoTrained | None:
    """Two views (content, metadata) of labelled rows and of rows without labels -> a model; None without both labels."""
    if len(y) == 0 or y.min() == y.max():
        return None
    aside = np.random.default_rng(seed).permutation(len(y)) % 4 == 0
    if y[aside].min() == y[aside].max() if aside.any() else True:
        aside = np.zeros(len(y), bool)
    own, calm = ~aside, aside if aside.any() else ~aside
    given = [dict(), dict()]  # to each view: row of free -> label
    log = []

    def fitted(v: int) -> Logistic:
        rows = np.array(list(given[v]), int)
        x, t = labelled[v][own], y[own]
        weight = np.ones(len(t))
        if len(rows):
            x, t = np.concatenate((x, free[v][rows])), np.concatenate((t, np.array([given[v][i] for i in rows])))
            weight = np.concatenate((weight, np.full(len(rows), 0.5)))  # another's guess weighs half
        return fit_logistic(x, t, weight)

    views = [fitted(0), fitted(1)]
    share = y[own].mean()
    for _ in range(rounds if len(free[0]) else 0):
        told = []
        for v in (0, 1):
            p = _sigmoid(views[v].logit(free[v]))
            n = 0
            for label, q, part in ((1.0, p, share), (0.0, 1 - p, 1 - share)):
                most = max(1, int(grow * part * len(p)))
                best = np.argsort(-q, kind="stable")
                take = [i for i in best[q[best] >= sure].tolist() if i not in given[1 - v]][:most]
                given[1 - v] |= dict.fromkeys(take, label)
                n += len(take)
            told.append(n)
        log.append(tuple(told))
        views = [fitted(0), fitted(1)]
        if not any(told):
            break
    logits = [m.logit(x[calm]) for m, x in zip(views, labelled, strict=True)]
    calibration = tuple(fit_logistic(z[:, None], y[calm], decay=1e-3) for z in logits)
    z = np.stack([c.logit(l[:, None]) for c, l in zip(calibration, logits, strict=True)], 1)
    return CoTrained(tuple(views), calibration, fit_logistic(z, y[calm], decay=1e-2), log)


# ------------------------------------------------------------------------------------------------------ Spark


def _views(texts, sources, langs) -> tuple[np.ndarray, np.ndarray]:
    return np.array([content(t) for t in texts]).reshape(-1, len(NAMES)), np.array([metadata(s, g, len(t or b""), (t or b"").count(b"\n")) for t, s, g in zip(texts, sources, langs, strict=True)]).reshape(-1, 2 * HASHED + 24)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> CoTrained | None:
    """Learns from bounded, reproducible samples; never from the labels of rows whose crc32(doc_id) mod 3 is 1."""
    by_hash = lambda d: d.orderBy(F.xxhash64("doc_id"), "doc_id")
    own = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    parts = [by_hash(own.where(F.col("quality") == q)).limit(labelled // 2) for q in (0, 1)]
    free = by_hash(docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").join(labels.select("doc_id"), "doc_id", "left_anti")).limit(unlabelled).withColumn("quality", F.lit(None).cast("int"))
    ids = F.broadcast(parts[0].unionByName(parts[1]).unionByName(free))  # bounded: labelled + unlabelled rows of two numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang").join(ids, "doc_id")
    seen = arrow_map(rows.select("doc_id", F.col("text").cast("binary"), "source", "lang", "quality"), _sample_views, "doc_id long, content array<double>, metadata array<double>, quality int")
    seen = by_hash(seen).limit(labelled + unlabelled).collect()  # an id may be there many times
    seen.sort(key=lambda r: r["doc_id"])
    known, rest = [r for r in seen if r["quality"] is not None], [r for r in seen if r["quality"] is None]
    both = lambda rs: (np.array([r["content"] for r in rs]).reshape(-1, len(NAMES)), np.array([r["metadata"] for r in rs]).reshape(-1, 2 * HASHED + 24))
    return co_train(both(known), np.array([r["quality"] for r in known], float), both(rest))


def _sample_views(batch: pa.RecordBatch) -> pa.RecordBatch:
    c, m = _views(*(batch.column(i).to_pylist() for i in (1, 2, 3)))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(c), pa.list_(pa.float64())), pa.array(list(m), pa.list_(pa.float64())), batch.column(4)], ["doc_id", "content", "metadata", "quality"])


def score(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """(doc_id, score, predicted) for each row of docs (doc_id, text, source, lang); score is P(quality = 1).

    Nulls: a null text counts as empty and is scored on its metadata and an all-zero content view; a null source or
    language is a value of its own. Very long texts are scored whole. Without a model (labels of one kind only) every score is 0.5. Repeated rows: a row
    each. No rows: no rows. Other columns are ignored.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = model.score(_views(*(batch.column(i).to_pylist() for i in (1, 2, 3)))) if model else np.full(batch.num_rows, 0.5)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), F.col("source").cast("string"), F.col("lang").cast("string")), run, "doc_id long, score double, predicted int")
