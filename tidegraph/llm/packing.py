"""Packing documents into sequences of a fixed length by bounded-space online best fit.

Documents are tokenised, closed with one id, and only those that are longer than a sequence are cut. A full piece is a
sequence of its own. The rest arrive one by one at a packer with a fixed number of open bins in a bitset keyed by free
space: a piece goes to the open bin with the least free space that still holds it (the lowest set bit at or above its
length); if none does, a bin is opened, and where that makes too many, the fullest closes first.

Scale: tokenising is one pass over the texts without a shuffle. What is packed is one narrow row a piece; pieces are dealt
by a hash to packers of about PACKER_ROWS rows each, so no task grows with the input. When a packer has seen its rows,
its open bins are not closed: their pieces go on to a next round with FAN_IN times fewer packers, until one is left, which
sees a bounded number of rows. Only its open bins end unfilled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashes, joined, materialize, parts, ship, words

SEQUENCE = 4096
END_ID = 1
OPEN_BINS = 64
PACKER_ROWS = 50_000
FAN_IN = 16
CACHED_WORDS = 400_000  # a generation

# ---------------------------------------------------------------------------------------------------- tokens


class _Table:
    """Word hash -> its ids, in an open-addressing table that is probed for many words at once."""

    def __init__(self, words: int):
        self.mask = np.uint64((1 << int(2 * words - 1).bit_length()) - 1)
        self.keys = np.zeros(int(self.mask) + 1, np.uint64)
        self.row = np.full(int(self.mask) + 1, -1, np.int32)
        self.first, self.count = np.zeros(words, np.int64), np.zeros(words, np.int32)
        self.ids = np.zeros(4 * words, "<u4")
        self.n = self.used = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 for the unknown."""
        at, out = h & self.mask, np.full(len(h), -1, np.int32)
        todo = np.arange(len(h))
        while len(todo):
            r = self.row[at]
            hit = (r >= 0) & (self.keys[at] == h[todo])
            out[todo[hit]] = r[hit]
            on = (r >= 0) & ~hit
            todo, at = todo[on], (at[on] + np.uint64(1)) & self.mask
        return out

    def add(self, h: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        """New words, all different."""
        n, rows = len(h), np.arange(self.n, self.n + len(h), dtype=np.int32)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(ids)), "<u4")))
        self.ids[self.used : self.used + len(ids)] = ids
        self.count[rows] = count
        self.first[rows] = self.used + np.concatenate(([0], np.cumsum(count)[:-1]))
        self.n, self.used = self.n + n, self.used + len(ids)
        todo, at = np.arange(n), h & self.mask
        while len(todo):
            free = self.row[at] < 0
            self.row[at[free]] = rows[todo[free]]  # of several for one place, one gets it
            mine = free & (self.row[at] == rows[todo])
            self.keys[at[mine]] = h[todo[mine]]
            todo, at = todo[~mine], (at[~mine] + np.uint64(1)) & self.mask

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the rows' words end to end, and how many of each."""
        count = self.count[rows]
        ends = np.cumsum(count)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[rows] - ends + count, count)], count


class WordIds:
    """Texts -> ids as little-endian unsigned 32-bit integers, by words that are tokenised once.

    The tokenizer splits at white space, and between a letter and a following stop or comma, before it merges, and it
    lower-cases; so a text's ids are those of its words in turn. Words repeat far more than texts do: each is tokenised
    once while it stays in the cache, which is looked up for a whole batch at once. The cache has two generations of
    bounded size: when the younger is full it becomes the older, and a word found there moves back, so frequent words stay.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.mark = max((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, default="")
        self.mark_id = self.tokenizer.token_to_id(self.mark) if self.mark else -1
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.young, self.old = _Table(cached), _Table(1)

    def _run(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Many words in one call. Words of letters alone end with their only end-of-word token; others are told apart by a
        special token between them (none holds one itself)."""
        out: list[np.ndarray | None] = [None] * len(words)
        letters, others = [], []
        for i, w in enumerate(words):
            t = w.decode("utf-8", "replace")
            (letters if t.isalpha() else others).append((i, t))
        for at in range(0, len(letters), 2_000):
            part = letters[at : at + 2_000]
            ids = self._run(" ".join([t for _, t in part]))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):
                for (i, _), x in zip(part, np.split(ids, cuts[:-1]), strict=True):
                    out[i] = x
            else:
                others.extend(part)
        for at in range(0, len(others), 2_000 if self.mark else 1):
            part = others[at : at + (2_000 if self.mark else 1)]
            ids = self._run(self.mark.join([t for _, t in part]))
            cuts = np.flatnonzero(ids == self.mark_id) if self.mark else np.empty(0, int)
            for (i, _), a, b in zip(part, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True):
                out[i] = ids[a:b]
        return out

    def _rows(self, buf: bytes, h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Rows of the younger generation for every word of buf."""
        rows = self.young.find(h)
        miss = np.flatnonzero(rows < 0)
        if not len(miss):
            return rows
        new, at = np.unique(h[miss], return_index=True)
        if self.young.n + len(new) > self.cached:
            self.old, self.young = self.young, _Table(max(self.cached, len(h)))
            return self._rows(buf, h, s, e)
        before = self.old.find(new)
        known = np.flatnonzero(before >= 0)
        if len(known):
            ids, count = self.old.take(before[known])
            self.young.add(new[known], count, ids)
        fresh = np.flatnonzero(before < 0)
        if len(fresh):
            where = miss[at[fresh]]
            found = self._encode([buf[a:b] for a, b in zip(s[where].tolist(), e[where].tolist(), strict=True)])
            self.young.add(new[fresh], np.array([len(x) for x in found], np.int32), np.concatenate(found))
        rows[miss] = self.young.find(h[miss])
        return rows

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        odd = {i for i, t in enumerate(texts) if b"<|" in t}  # may hold a special token, which is told by its case
        buf, starts = joined([b"" if i in odd else t for i, t in enumerate(texts)])
        buf = buf.lower()
        h, s, e = words(buf)
        if len(h):
            b = np.frombuffer(buf, np.uint8)
            last, prior = b[e - 1], b[np.maximum(e - 2, 0)]
            tail = np.flatnonzero(((last == 44) | (last == 46)) & (e - s > 1) & (prior >= 97) & (prior <= 122))
            if len(tail):  # stops and commas become words of their own
                e = e.copy()
                e[tail] -= 1
                order = np.argsort(np.concatenate((s, e[tail])), kind="stable")
                s, e = np.concatenate((s, e[tail]))[order], np.concatenate((e, e[tail] + 1))[order]
                h = hashes(buf, s, e)
        rows = self._rows(buf, h, s, e)
        ids, count = self.young.take(rows)
        upto = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(s, starts)]
        flat = ids.tobytes()
        return [self._run(t.decode("utf-8", "replace")).tobytes() if i in odd else flat[4 * x : 4 * y] for i, (t, x, y) in enumerate(zip(texts, upto[:-1].tolist(), upto[1:].tolist(), strict=True))]


_held: dict[str, WordIds] = {}


def tokenise(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, row, piece, start, length, ids) for each piece; row tells rows of the input apart, ids is binary (<u4)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, part, n = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 33, 0
        for batch in (part for whole in batches for part in parts(whole)):
            if tokenizer not in _held:
                _held[tokenizer] = WordIds(tokenizer)
            known, out = _held[tokenizer], {k: [] for k in ("doc_id", "row", "piece", "start", "length", "ids")}
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):  # texts of bounded size together
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size + len(texts[upto]) <= 1 << 19):
                    size += len(texts[upto])
                    upto += 1
                for i, ids in enumerate(known.texts(texts[at:upto]), at):
                    ids += end
                    for k, s in enumerate(range(0, len(ids), 4 * length)):
                        p = ids[s : s + 4 * length]
                        for name, v in zip(out, (batch.column(0)[i].as_py(), part + n, k, s // 4, len(p) // 4, p), strict=True):
                            out[name].append(v)
                    n += 1
                at = upto
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], list(out))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, row long, piece int, start long, length long, ids binary")


# ----------------------------------------------------------------------------------------------------- bins


class Packer:
    """Online best fit with at most `open_bins` open bins."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.most = size, open_bins
        self.free = 0  # bit f is set if an open bin has f units free
        self.by_free: dict[int, list[int]] = {}
        self.bins: list[list[int]] = []
        self.n_open = 0

    def _take(self, f: int) -> int:
        b = self.by_free[f].pop()
        if not self.by_free[f]:
            del self.by_free[f]
            self.free &= ~(1 << f)
        self.n_open -= 1
        return b

    def _put(self, f: int, b: int) -> None:
        if f == 0:  # full: closed
            return
        self.by_free.setdefault(f, []).append(b)
        self.free |= 1 << f
        self.n_open += 1

    def add(self, item: int, n: int) -> None:
        fits = self.free >> n
        if fits:
            f = n + (fits & -fits).bit_length() - 1
            b = self._take(f)
            self.bins[b].append(item)
            self._put(f - n, b)
            return
        self.bins.append([item])
        self._put(self.size - n, len(self.bins) - 1)
        if self.n_open > self.most:
            self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes

    def open(self) -> list[int]:
        return sorted(b for bs in self.by_free.values() for b in bs)


def _round(pieces: DataFrame, packers: int, last: bool, k: int, size: int, open_bins: int) -> DataFrame:
    """pieces with sequence_id and offset where a bin closed, null where it stays open for the next round."""
    names = [*pieces.columns, "sequence_id", "offset"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [x for x in frames if len(x)]
        if not rows:
            return
        d = pd.concat(rows).sort_values(["order", "doc_id", "row", "piece"], kind="stable").reset_index(drop=True)
        packer, lengths = Packer(size, open_bins), d["length"].to_numpy()
        for i, n in enumerate(lengths.tolist()):
            packer.add(i, n)
        still = set() if last else set(packer.open())
        sequence, place = np.full(len(d), -1, np.int64), np.zeros(len(d), np.int64)
        base = (k << 58) | (TaskContext.get().partitionId() << 30)
        for b, items in enumerate(packer.bins):
            if b not in still:
                sequence[items] = base + b
                place[items] = np.concatenate(([0], np.cumsum(lengths[items])[:-1]))
        d["sequence_id"] = pd.array(np.where(sequence < 0, 0, sequence), "Int64")
        d.loc[sequence < 0, "sequence_id"] = pd.NA
        d["offset"] = place
        yield d[names]

    dealt = pieces.repartition(packers, F.xxhash64("order", F.lit(k))) if packers > 1 else pieces.coalesce(1)
    return dealt.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long")


def pack(pieces: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, packer_rows: int = PACKER_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """pieces (doc_id, row, piece, length, any others) with sequence_id and offset: no sequence holds over `size` units,
    each is gapless from 0, every piece lies in exactly one. The same rows in the same files give the same packing: each
    packer first sorts what it was dealt, so a task that is run again gives the same bins."""
    full = pieces.where(F.col("length") >= size)
    done = [full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))]
    rest = pieces.where(F.col("length") < size).withColumn("order", F.xxhash64("doc_id", "row", "piece"))
    rows, k = rest.count(), 0
    packers = max(1, -(-rows // packer_rows))
    while rows:
        out = materialize(_round(rest, packers, packers == 1, k, size, open_bins), "packed")
        done.append(out.where("sequence_id is not null").drop("order"))
        if packers == 1:
            break
        rest, packers, k = out.where("sequence_id is null").drop("sequence_id", "offset"), -(-packers // fan_in), k + 1
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = True, **how) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids (binary, <u4) if with_ids.

    Nulls: a null or empty text is one piece that holds the end id; a null id stays null. Repeated rows are packed each.
    Words longer than any cache still tokenise; a very long text becomes many pieces. No rows: no rows. Columns other
    than doc_id and text are ignored. Special tokens written out in a text are taken as the tokenizer takes them.
    """
    pieces = tokenise(docs, tokenizer, length, end_id).withColumn("ids_crc32", F.crc32("ids"))
    pieces = materialize(pieces if with_ids else pieces.drop("ids"), "pieces")
    out = pack(pieces.drop("ids"), length, **how)
    if with_ids:
        out = out.join(pieces.select("row", "piece", "ids"), ["row", "piece"])
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)
