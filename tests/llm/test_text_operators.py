"""Mixing, substring and near-duplicate operators against brute force, and on odd tables."""

import collections
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidegraph.llm import minhash, mixing, queries, sql, substring

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BASE = [f"w{i}" for i in range(60)]


def brute_near(rows, percent=85):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").encode().lower())
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    lead = {d: d for d in sets}

    def root(x):
        while lead[x] != x:
            x = lead[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                lead[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def brute_cut(rows, k=13):
    split = [(d, WORD.findall((t or "").encode())) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone[i : i + k] = [True] * k
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


def hard_rows():
    """Copies, near copies at and about the threshold, chains, shared passages of about a window, repetition."""
    rows = [(0, " ".join(BASE)), (1, " ".join(BASE)), (2, " ".join(BASE).upper()), (3, ""), (4, " \t\n"), (5, "one two"), (6, "One\ttwo"), (7, "a " * 400), (8, "a " * 401)]
    w = list(BASE)
    for i in range(9, 40):  # a chain: each differs from the one before in one word
        w[i % 60] = f"x{i}"
        rows.append((i, " ".join(w)))
    for i in range(40, 70):  # passages of 11 to 15 words within own words
        own = [f"d{i}_{j}" for j in range(30)]
        rows.append((i, " ".join(own[:15] + BASE[i % 40 : i % 40 + 11 + i % 5] + own[15:])))
    rows += [(i, " ".join([f"p{j}" for j in range(20)] + [f"q{i}_{j}" for j in range(i % 7 * 3)])) for i in range(70, 90)]
    return rows


def test_near_duplicates_match_brute_force(docs):
    rows = hard_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs([(d, t, None) for d, t in rows])).collect()}
    assert got == brute_near(rows)


def test_near_duplicates_of_odd_rows(docs):
    rows = [(None, "a b c d e f", None), (1, None, None), (1, "a b c d e f", None), (2, "a b c d e f", None), (2, "a b c d e f", None), (3, "k l m n o p", None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (1, 0, 1, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 2, 3, True)], key=str)


def test_substring_matches_brute_force(docs):
    rows = hard_rows()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup(docs([(d, t, None) for d, t in rows])).collect()}
    assert got == brute_cut(rows)


def test_substring_text_and_odd_rows(docs):
    long = " ".join(BASE)
    out = substring.dedup(docs([(None, long, None), (1, long, None), (1, long, None), (1, "short", None), (2, long + " tail", None), (3, None, None)])).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out), key=str)
    assert got == sorted([(None, 60, 0, None), (1, 60, 0, None), (1, 60, 0, None), (1, 1, 0, None), (2, 61, 60, "tail"), (3, 0, 0, None)], key=str)


def test_factors_are_greedy_and_boundaries_are_checked():
    import numpy as np

    ref = " ".join([f"a{i}" for i in range(30)] + [f"b{i}" for i in range(30)] + [f"a{i}" for i in range(20, 30)] + [f"b{i}" for i in range(10)])
    doc = " ".join(f"a{i}" for i in range(30)) + " " + " ".join(f"b{i}" for i in range(30))
    block, h = substring.Block([ref.encode()], 13), substring.words(doc.encode())[0]
    assert block.parse(h) == [(0, 0, 60)] and block.duplicates(h).all()
    block = substring.Block([("x " + " ".join(f"a{i}" for i in range(20)) + " y " + " ".join(f"a{i}" for i in range(15, 40))).encode()], 13)
    h = substring.words(" ".join(f"a{i}" for i in range(40)).encode())[0]
    assert [f[2] for f in block.parse(h)] == [20, 20] and np.flatnonzero(~block.duplicates(h)).tolist() == [8, 9, 10, 11, 12, 13, 14]
    block.parse = lambda h: []  # the parse decides: without factors nothing is a duplicate
    assert not block.duplicates(h).any()


def test_parse_finds_exactly_the_windows_of_the_block():
    import random

    r = random.Random(1)
    for _ in range(300):
        some = [f"w{i}" for i in range(r.choice([2, 3, 40]))]
        pieces, doc = [[r.choice(some) for _ in range(r.randint(0, 80))] for _ in range(r.randint(1, 3))], [r.choice(some) for _ in range(r.randint(0, 90))]
        block = substring.Block([" ".join(x).encode() for x in pieces], 4)
        has = {tuple(x[i : i + 4]) for x in pieces for i in range(len(x) - 3)}
        assert block.duplicates(substring.words(" ".join(doc).encode())[0]).tolist() == [tuple(doc[i : i + 4]) in has for i in range(max(len(doc) - 3, 0))]
    assert substring.Block([b"a " * 300_000], 13).parse(substring.words(b"a " * 200_000)[0]) == [(0, 0, 200_000)]


def test_substring_of_repeated_ids_and_very_long_texts(docs):
    import random

    r = random.Random(5)
    stock = [[f"s{i}_{j}" for j in range(r.randint(10, 60))] for i in range(12)]
    rows = []
    for _ in range(150):
        text = [w for _ in range(r.randint(1, 4)) for w in (r.choice(stock) if r.random() < 0.7 else [f"u{r.random()}" for _ in range(20)])]
        rows.append((r.randint(1, 60), " ".join(text)))
    rows += r.sample(rows, 20)
    unique = [f"v{i}" for i in range(1_000_000)]
    rows += [(500, " ".join(unique)), (501, " ".join(unique[:400_000] + ["x"] + unique[400_000:])), (502, " ".join(unique[999_980:]))]
    split = [(d, WORD.findall(t.encode())) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - 12):
            key = hash(tuple(w[i : i + 13]))
            first[key] = min(first.get(key, d), d)
    want = []
    for d, w in split:
        gone = bytearray(len(w))
        for i in range(len(w) - 12):
            if first[hash(tuple(w[i : i + 13]))] < d:
                gone[i : i + 13] = b"\1" * 13
        want.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    got = [(x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in substring.dedup(docs([(d, t, None) for d, t in rows])).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert sorted(got) == sorted(want)
    assert {d: n for d, _, n, _ in got if d > 500} == {501: 1_000_000, 502: 20}


def test_hot_blocks_are_shared(docs, monkeypatch):
    monkeypatch.setattr(substring, "SHARE", 8)
    monkeypatch.setattr(substring, "PIECE", 5)
    rows = hard_rows()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup(docs([(d, t, None) for d, t in rows])).collect()}
    assert got == brute_cut(rows)


def test_near_duplicates_of_repeated_ids(docs):
    import random

    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    text = lambda w, *more: " ".join([*w, *more])
    rows = [(1, text(a)), (1, text(b)), (5, text(a, "x")), (6, text(b, "y"))]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs([(d, t, None) for d, t in rows])).collect()}
        assert got == {(1, 1), (5, 1), (6, 1)}
    r = random.Random(9)
    stock = [[f"t{i}_{j}" for j in range(60)] for i in range(25)]
    rows = []
    for _ in range(200):
        w = list(r.choice(stock))
        for _ in range(r.randint(0, 2)):
            w[r.randrange(60)] = f"z{r.random()}"
        rows.append((r.randint(1, 90), " ".join(w) if r.random() < 0.9 else ""))
    rows += r.sample(rows, 30)
    sets = [(d, {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}) for d, t in rows]
    lead = {d: d for d, _ in rows}

    def root(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for i, (d, x) in enumerate(sets):
        for e, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                lead[max(root(d), root(e))] = min(root(d), root(e))
    got = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in minhash.near_duplicates(docs([(d, t, None) for d, t in rows])).collect())
    assert got == sorted((d, len(x), root(d), root(d) == d) for d, x in sets)


def test_columns_of_any_name_go_through(docs):
    long = " ".join(BASE)
    names = ["row_key", "kept_text", "cut_text", "toxic_score", "size", "kept", "row", "n_chars"]
    d = docs([(1, long, "a"), (2, long + " tail", "a"), (None, None, None)])
    for n in names:
        d = d.withColumn(n, F.lit(7))
    out = substring.cut_rows(d)
    assert out.columns == d.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[2].text == "tail" and rows[2].n_chars == 4 and rows[1].text == long and rows[1].n_chars == 7
    assert all(r[n] == 7 for r in rows.values() for n in names[:-1])
    emitted = mixing.emit(d)
    assert emitted.columns == d.columns and all(r[n] == 7 for r in emitted.collect() for n in names)


def test_mixing_matches_sql(spark, small):
    got = queries.op2_mix_sources(spark, small).collect()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{small}/documents.parquet'")
    want = con.sql(sql.OP2).fetchall()
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6), r[4])
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_mixing_targets_and_caps(docs):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3] if i % 10 else None) for i in range(3000)] + [(3000 + i, "w", "d") for i in range(5)] + [(9000, None, "e"), (9001, "", "e")]
    d = docs(rows)
    out = mixing.mix(d).collect()
    assert len(out) == len(rows) and all(0 <= r.copies <= 3 and r.taken == r.copies * r["size"] for r in out)
    by = collections.defaultdict(lambda: [0, 0, 0.0])
    for r in out:
        x = by[r.source]
        x[0] += r["size"]
        x[1] += r.taken
        x[2] = r.target
    total = sum(x[0] for x in by.values())
    assert abs(sum(x[2] for x in by.values()) - total) < 1e-6
    weights = dict(zip(["a", "b", "c", "d", "e", None], [5, 2, 1, 5, 2, 1]))
    assert by["d"][2] == 15 and by["e"][2] == 0
    level = {s: by[s][2] / weights[s] for s in ("a", "b", "c", None)}
    assert max(level.values()) - min(level.values()) < 1e-6 or any(abs(by[s][2] - 3 * by[s][0]) < 1e-6 for s in level)
    for s in ("a", "b", "c", None):
        assert abs(by[s][1] - by[s][2]) <= 0.02 * by[s][2] + 10
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mix(d.repartition(7)).collect()), key=str)
    emitted = mixing.emit(d)
    assert emitted.columns == d.columns and emitted.count() == sum(r.copies for r in out)


@pytest.mark.parametrize("op", [minhash.near_duplicates, substring.dedup, mixing.mix, mixing.emit])
def test_empty_tables(docs, op):
    assert op(docs([])).collect() == []
