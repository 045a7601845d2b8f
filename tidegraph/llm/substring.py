"""Exact substring deduplication by relative Lempel-Ziv parsing.

A word goes if a window of `window` consecutive words covers it whose word sequence also starts in a document of smaller
id. Reference blocks are stretches of such documents, each block indexed by its windows. A document is parsed greedily
against every block that can hold a window of its own: at a word whose window the block has, the longest match becomes a
factor and parsing goes on behind it; words that no window leads from are literals. Factors are duplicate spans. The
windows that begin in the last words of a factor and end behind it are not part of it; they are looked up one by one, the
boundary check. Windows inside a factor are never looked up: the factor itself says that they are duplicates.

Which blocks can hold a window? Every window has an anchor: the least hash among its runs of four words, runs of short,
common words last. Equal windows have equal anchors, so a window can only repeat in documents that have its anchor, and
the block of an anchor is the text of the smallest id that has it. A window that its block does not hold may still be
shared by two later documents; those left-over windows, few after parsing, are grouped by a 96-bit hash, which finishes
the job exactly: all documents that hold such a window have the same anchor, so the same block, and none found it there,
so all send it.

Scale: anchors are a fifth of the words, as (hash, id), aggregated before the shuffle. Equal texts are one document from
the start. What moves to a block are only the stretches of a document whose anchors lead there, each window to one block,
so a document moves a small multiple of its length however many blocks it meets, and a block moves once, not once for
each document. A block that very many documents ask for (a line that a third of them carry) is dealt to several tasks,
SHARE anchors or its own number each, with a copy of the block to each, so copies never outweigh what is asked. A task
holds the index of one block and streams the stretches past it. Nothing is kept that is longer than a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, discard, grams, joined, list_array, materialize, mix, parts, ship, signed, words

WINDOW = 13
ANCHOR = 4
PLAIN = 20  # bytes; shorter runs are mostly of common words and become anchors only where there is no other
SHARE = 512  # anchors that one task is asked for, unless its block has more itself
PIECE = 1 << 16  # windows in one stretch
AHEAD = 64  # windows of literals that are looked up together


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of `width`."""
    have, m = 1, h
    while have < width:
        step = min(have, width - have)
        m = np.minimum(m[: len(m) - step], m[step:])
        have += step
    return m


def anchors(h: np.ndarray, size: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The anchor of each window of the words with hashes h and lengths size."""
    if len(h) < window:
        return np.empty(0, np.uint64)
    total = np.concatenate(([0], np.cumsum(size)))
    common = (total[ANCHOR:] - total[:-ANCHOR] < PLAIN).astype(np.uint64)
    return _least(grams(h, ANCHOR) >> np.uint64(1) | common << np.uint64(63), window - ANCHOR + 1)


def _text_key(h: np.ndarray) -> tuple[int, int]:
    at = np.arange(len(h), dtype=np.uint64)
    return tuple(int(np.add.reduce(mix(h + mix(at + np.uint64(s)))).view(np.int64)) if len(h) else 0 for s in (11, 1 << 40))


FACTS = "doc_id long, row_key long, n_words long, same1 long, same2 long, sha string, anchors array<long>"


def _facts(window: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2).to_pylist()
        buf, starts = joined(texts)
        h, s, e = words(buf)
        first = np.searchsorted(s, starts)
        n, same, sha, al = [], ([], []), [], []
        for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            al.append(np.unique(anchors(h[a:b], (e - s)[a:b], window)))
            for x, y in zip(same, _text_key(h[a:b]), strict=True):
                x.append(y)
            n.append(b - a)
            sha.append(hashlib.sha256(b" ".join((texts[i] or b"").split())).hexdigest())
        off = np.concatenate(([0], np.cumsum([len(x) for x in al])))
        cols = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), *[pa.array(x, pa.int64()) for x in same], pa.array(sha), list_array(signed(np.concatenate(al)), off)]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "row_key", "n_words", "same1", "same2", "sha", "anchors"])

    return run


class Block:
    """Reference stretches indexed by their windows. A stretch ends with a word that equals no other."""

    def __init__(self, texts: list[bytes], window: int):
        buf, starts = joined(texts)
        h, s, _ = words(buf)
        self.h = _fenced(h, np.searchsorted(s, starts[1:-1]), 1)
        self.window = window
        w = grams(self.h, window)
        self.at = np.argsort(w, kind="stable")
        self.keys = w[self.at]
        self.sums: tuple[np.ndarray, np.ndarray] | None = None

    def find(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For window hashes w: first and end of the index range of equal windows."""
        return np.searchsorted(self.keys, w), np.searchsorted(self.keys, w, side="right")

    def longest(self, h: np.ndarray, i: int, places: np.ndarray, sums: list) -> tuple[int, int]:
        """(place, length) of the longest match of h[i:] among `places`, which all match a window."""
        done = self.window
        if len(places) == 1:
            p, step = int(places[0]), 32
            while (room := min(step, len(h) - i - done, len(self.h) - p - done)) > 0:
                differ = np.flatnonzero(self.h[p + done : p + done + room] != h[i + done : i + done + room])
                if len(differ):
                    return p, done + int(differ[0])
                done, step = done + room, step * 2
            return p, done
        # many places: all are extended at once, by halves, on hashes of whole stretches
        if self.sums is None:
            self.sums = _sums(self.h)
        if not sums:
            sums.extend(_sums(h))
        n = np.full(len(places), done)
        room = np.minimum(len(h) - i, len(self.h) - places)
        step = 1 << int(room.max()).bit_length()
        while step:
            try_ = np.flatnonzero(n + step <= room)
            a, b = i + n[try_], places[try_] + n[try_]
            n[try_[_stretch(sums, a, a + step) == _stretch(self.sums, b, b + step)]] += step
            step >>= 1
        best = int(n.argmax())
        return int(places[best]), int(n[best])

    def parse(self, h: np.ndarray) -> list[tuple[int, int, int]]:
        """The factors (start, place in the block, length) of h; what lies between them are literals."""
        w = grams(h, self.window)
        out, i, upto, hits, sums = [], 0, 0, np.empty(0, np.int64), []
        while i < len(w):
            if i >= upto:  # the next windows, in case they are literals
                lo, hi = self.find(w[i : i + AHEAD])
                base, upto, hits = i, i + len(lo), np.flatnonzero(lo < hi) + i
            k = int(np.searchsorted(hits, i))
            if k == len(hits):
                i = upto
                continue
            i = int(hits[k])
            place, n = self.longest(h, i, self.at[lo[i - base] : hi[i - base]], sums)
            out.append((i, place, n))
            i += n
        return out

    def duplicates(self, h: np.ndarray) -> np.ndarray:
        """Which windows of h the block holds: those in factors, and those over a factor's end that pass the check."""
        held = np.zeros(max(len(h) - self.window + 1, 0), bool)
        found = self.parse(h)
        if found:
            start, _, n = np.array(found).T
            cover = np.zeros(len(held) + 1, np.int32)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + n - self.window + 1, -1)
            held = np.cumsum(cover)[:-1] > 0
            edge = ((start + n)[:, None] - np.arange(1, self.window)[None, :]).ravel()
            edge = edge[(edge >= 0) & (edge < len(held))]
            lo, hi = self.find(grams_at(h, edge, self.window))
            held[edge[lo < hi]] = True
        return held


def grams_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """What grams() gives at places `at`."""
    return grams(h[at[:, None] + np.arange(k)].ravel(), k)[::k] if len(at) else np.empty(0, np.uint64)


def _fenced(h: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """h with a word before each of the places `at` that equals no other word."""
    return np.insert(h, at, mix(np.arange(len(at), dtype=np.uint64) + np.uint64(seed << 60 | 0x5DEECE66D)))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _sums(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of h times powers, and the powers of the inverse: hashes of any stretch by two lookups."""
    power, back = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(h), b, np.uint64))), dtype=np.uint64) for b in (_BASE, _BACK))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h) * power[:-1], dtype=np.uint64))), back


def _stretch(sums: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (sums[0][b] - sums[0][a]) * sums[1][a]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    s = np.flatnonzero(d == 1)
    return s, np.flatnonzero(d == -1) - s


def window_keys(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of each window: enough to tell a corpus's windows apart."""
    return signed(grams(h, window)), (grams(h, window, seed=1) >> np.uint64(32)).astype(np.uint32).view(np.int32)


STRETCH = "block long, block_key long, shares int, is_block boolean, more boolean, doc_id long, row_key long, start int, text binary"


def _stretches(window: int):
    """Cuts a document into the stretches that its blocks are asked for, and those that it is itself a block of."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = tuple([] for _ in range(9))
        for i, (doc, row, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
            h, s, e = words(text)
            routes = batch.column(3)[i].values
            field = lambda name: np.asarray(routes.field(name).fill_null(0))  # noqa: E731, B023
            keys = field("anchor").view(np.uint64)
            order = np.argsort(keys)
            a = anchors(h, e - s, window)
            at = np.minimum(np.searchsorted(keys[order], a), len(keys) - 1)
            led = keys[order][at] == a  # windows whose anchor others have too
            block, key, shares = field("block")[order], field("block_key")[order], field("shares")[order]
            more = np.asarray(routes.field("more").cast(pa.int8()))[order]
            turn = np.concatenate(([True], (led[1:] != led[:-1]) | (block[at][1:] != block[at][:-1]) | (key[at][1:] != key[at][:-1])))
            first = np.flatnonzero(turn)
            last = np.concatenate((first[1:], [len(a)]))
            for x, y in zip(first[led[first]].tolist(), last[led[first]].tolist(), strict=True):
                own = (int(block[at[x]]), int(key[at[x]]))
                for p in range(x, y, PIECE):
                    q = min(p + PIECE, y)
                    values = (*own, int(shares[at[x]]), own == (doc, row), bool(more[at[p:q]].any()), doc, row, p, text[s[p] : e[q + window - 2]])
                    for o, v in zip(out, values, strict=True):
                        o.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds, strict=True)], [x.split()[0] for x in STRETCH.split(", ")])

    return run


MARK = "doc_id long, row_key long, start array<int>, n array<int>, at array<int>, h1 array<long>, h2 array<int>"


def _met(window: int):
    """Streams stretches, sorted by block with the block's own first, past the block's index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for whole in batches:
            for batch in parts(whole, 2_000, 1 << 20):
                keys = list(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True))
                own, more, doc, row, start, text = (batch.column(c).to_pylist() for c in range(3, 9))
                out: tuple[list, ...] = tuple([] for _ in range(7))
                i = 0
                while i < len(keys):
                    if keys[i] != now:
                        now, held, block = keys[i], [], None
                    if own[i]:
                        held.append(text[i])
                        i += 1
                        continue
                    j = i
                    while j < len(keys) and keys[j] == now:
                        j += 1
                    if block is None:
                        block, held = Block(held, window), []
                    buf, starts = joined(text[i:j])
                    h, s, _ = words(buf)
                    cut = np.searchsorted(s, starts)
                    fenced = _fenced(h, cut[1:-1], 2)
                    found = block.duplicates(fenced)
                    hashes: tuple = ()
                    for k in range(i, j):
                        a, b = int(cut[k - i]) + k - i, int(cut[k - i + 1]) + k - i - window + 1
                        known = found[a:b]
                        # rows of the block's own id repeat nothing there, but nobody need look for those windows elsewhere
                        r, n = _runs(known) if doc[k] != now[0] else (np.empty(0, np.int64), np.empty(0, np.int64))
                        left = np.flatnonzero(~known) if more[k] else np.empty(0, np.int64)
                        if len(r) or len(left):
                            hashes = hashes or (window_keys(fenced, window) if len(left) else ())
                            values = (doc[k], row[k], (r + start[k]).astype(np.int32), n.astype(np.int32), (left + start[k]).astype(np.int32), *([x[left + a] for x in hashes] if len(left) else [np.empty(0, np.int64), np.empty(0, np.int32)]))
                            for o, v in zip(out, values, strict=True):
                                o.append(v)
                    i = j
                if out[0]:
                    lists = [list_array(np.concatenate(o), np.concatenate(([0], np.cumsum([len(x) for x in o])))) for o in out[2:]]
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), *lists], [x.split()[0] for x in MARK.split(", ")])

    return run


def spans(facts: DataFrame, texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, row_key, spans): runs (start, n) of windows that also start in smaller ids, for the texts that have any.

    facts: what _facts gives; texts: (doc_id, row_key, text), text in bytes; both with one row a text, ids not null.
    """
    found = facts.select("doc_id", "row_key", F.explode("anchors").alias("anchor"))
    led = found.groupBy("anchor").agg(F.min("doc_id").alias("block"), F.min_by("row_key", "doc_id").alias("block_key"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    led = materialize(led.where("block < last").drop("last"), "anchors")
    asked = led.groupBy("block", "block_key").agg(F.sum("n").alias("asked"), F.count(F.lit(1)).alias("own"))
    asked = materialize(asked.select("block", "block_key", F.ceil(F.col("asked") / F.greatest(F.lit(SHARE), F.col("own"))).cast("int").alias("shares")).where("shares > 1"), "asked")
    wide = led.join(asked, ["block", "block_key"], "left").select("anchor", "block", "block_key", F.coalesce("shares", F.lit(1)).alias("shares"), (F.col("n") > 2).alias("more"))
    routes = found.join(wide, "anchor").groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("anchor", "block", "block_key", "shares", "more")).alias("routes"))
    routes = materialize(routes, "routes")
    discard(led, asked)
    pieces = arrow_map(texts.join(routes.hint("shuffle_hash"), ["doc_id", "row_key"]).select("doc_id", "row_key", "text", "routes"), _stretches(window), STRETCH, 200)
    share = F.when(F.col("is_block"), F.sequence(F.lit(0), F.col("shares") - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc_id", "row_key", "start"), F.col("shares")).cast("int")))
    pieces = pieces.select("block", "block_key", F.explode(share).alias("share"), "is_block", "more", "doc_id", "row_key", "start", "text")
    key = ["block", "block_key", "share"]
    marks = materialize(pieces.repartition(*key).sortWithinPartitions(*key, F.desc("is_block")).mapInArrow(_met(window), MARK), "marks")
    discard(routes)
    left = marks.select("doc_id", "row_key", F.explode(F.arrays_zip("at", "h1", "h2")).alias("w")).select("doc_id", "row_key", "w.at", "w.h1", "w.h2")
    shared = materialize(left.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least < last").select("h1", "h2", "least"), "left-over")
    more = left.join(shared, ["h1", "h2"]).where("doc_id > least").select("doc_id", "row_key", F.array("at").alias("start"), F.array(F.lit(1)).alias("n"))
    whole = marks.where(F.size("start") > 0).select("doc_id", "row_key", "start", "n").unionByName(more)
    out = materialize(whole.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "n")).alias("spans")), "spans")
    discard(marks, shared)
    return out


def _cut(window: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [])
        for i, (doc, row, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
            parts_ = text.split()
            gone = np.zeros(len(parts_) + 1, np.int32)
            found = batch.column(3)[i].values
            s, n = (np.asarray(found.field(name).flatten()) for name in ("start", "n"))
            np.add.at(gone, s, 1)
            np.add.at(gone, s + n + window - 1, -1)
            gone = np.cumsum(gone)[:-1] > 0
            kept = b" ".join([w for w, g in zip(parts_, gone.tolist(), strict=True) if not g])
            for o, v in zip(out, (doc, row, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                o.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds, strict=True)], ["doc_id", "row_key", "n_cut", "cut_sha", "kept"])

    return run


EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row a row of docs (doc_id, text): doc_id, row_key, n_words, n_removed, kept_sha256, kept_text.

    kept_text holds the words that stay, joined by one space, and is null where nothing was removed (the text as it was).
    row_key is xxhash64 of the text: with doc_id it finds the row again. Nulls: a null or empty text has no words; a row
    with a null id repeats nothing and is no block. Repeated rows of one id do not remove each other, their id is not
    smaller. Texts of under `window` words have no window. Very long texts are cut into stretches of bounded length. No
    rows: no rows. Other columns are ignored.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), F.col("text").cast("binary").alias("text"))
    facts = materialize(arrow_map(texts, _facts(window), FACTS, 200), "facts")
    texts = texts.where("doc_id is not null")
    real = facts.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    id_ = ["doc_id", "row_key"]
    if not real.groupBy(*id_).count().where("count > 1").isEmpty():  # rows that are there twice; else nothing needs to move for it
        real, texts = real.dropDuplicates(id_), texts.dropDuplicates(id_)
    same = ["same1", "same2", "n_words"]
    classes = real.groupBy(*same).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least < last").select(*same, "least")
    classes = materialize(classes, "classes")
    copies = materialize(real.select(*id_, *same).join(classes, same).where("doc_id > least").select(*id_), "copies")
    own = real.join(copies, id_, "left_anti").select(*id_, "anchors")
    found = spans(own, texts, window)
    cut = arrow_map(texts.join(found.hint("shuffle_hash"), id_).select(*id_, "text", "spans"), _cut(window), "doc_id long, row_key long, n_cut long, cut_sha string, kept binary", 200)
    cut = cut.withColumn("kept", F.col("kept").cast("string"))
    out = facts.select(*id_, "n_words", "sha").join(copies.withColumn("copy", F.lit(True)), id_, "left").join(cut, id_, "left")
    copy = F.coalesce("copy", F.lit(False))
    return out.select(
        "doc_id", "row_key", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept_text"),
    )


def cut_rows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the repeated passages cut out of text, and n_chars (where there is such a column) following it; a row whose
    text loses nothing is left as it was. Every column goes through, whatever its name. No rows: no rows."""
    names = docs.columns
    cut = dedup(docs.select("doc_id", "text"), window).where("kept_text is not null").select("doc_id", "row_key", "kept_text").dropDuplicates(["doc_id", "row_key"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"))  # no name can clash
    out = rows.join(cut.hint("shuffle_hash"), ["doc_id", "row_key"], "left")
    was = lambda c: F.col("row").getField(c)
    new = {"text": F.coalesce("kept_text", was("text"))}
    if "n_chars" in names:
        new["n_chars"] = F.when(F.col("kept_text").isNotNull(), F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(was("n_chars"))
    return out.select(*[new.get(c, was(c)).alias(c) for c in names])
