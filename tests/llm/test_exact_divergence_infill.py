"""Exact dedup, source divergence and infilling against plain Python, and their edge cases."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidegraph.llm import divergence, exact, infill

KIND = "doc_id long, text string, source string, lang string"


@pytest.fixture()
def table(spark):
    """rows -> documents with columns of their own whose names clash with the operators'."""
    return lambda rows: spark.createDataFrame(rows, KIND).withColumns({c: F.lit("mine") for c in ("key", "sha", "owner", "n", "weight", "form", "output", "p", "term", "place", "batch")})


# ------------------------------------------------------------------------------------------------- exact dedup


def plain_dedup(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub("[ \t-\r]+", " ", t or "")
    for d, t in rows:
        groups[norm(t)].append(d)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for d, n in Counter(ids).items():
            for k in range(n):
                out.append((d, keep, len(ids), d == keep and k == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(5, "a b"), (2, "a  b"), (9, "a\t\n b"), (1, " a b"), (3, "a b "), (4, None), (7, ""), (None, ""), (8, "ä b"), (6, "A b"), (10, "a b"), (11, "a\x0bb"), (12, "x" * 300_000), (13, "x" * 300_000), (13, "x" * 300_000), (14, "x" * 299_999 + "y")]
ROWS += [(None, "only nulls"), (None, "only nulls"), (20, "twice"), (20, "twice"), (20, "other"), (21, "zz\x00"), (22, "zz")]
ROWS += [(100 + i, f"copies {i % 2}") for i in range(600)] + [(800 + i, f"single {i}") for i in range(200)]


@pytest.mark.parametrize("how", [{}, {"bits": 3}, {"bits": 1, "bytes_each": 500}, {"bytes_each": 2_000}, {"sent": 1}, {"sent": 1, "bytes_each": 300, "bits": 6}])
def test_dedup_equals_grouping(spark, table, how):
    """bits: keys collide, so chains hold many texts; bytes_each: buckets split and hot keys are paged; sent: all texts move."""
    got = exact.dedup(table([(d, t, "s", "l") for d, t in ROWS]), **how)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_dedup(ROWS)


def test_dedup_without_rows(table):
    assert exact.dedup(table([])).collect() == []
    one = exact.dedup(table([(1, "x", None, None)])).collect()
    assert [tuple(r) for r in one] == [(1, 1, 1, True, hashlib.sha256(b"x").hexdigest())]


def test_directory_doubles_and_buckets_split(spark, table):
    rows = [(i, f"text {i // 2} " + "w " * (i % 50)) for i in range(0, 4_000)] + [(9_000 + i, f"text {i} " + "w " * (2 * i % 50)) for i in range(2_000)]
    index = exact.build(table([(d, t, "s", "l") for d, t in rows]), bytes_each=20_000)
    slots = {r["slot"]: r for r in index.directory.collect()}
    assert index.depth_bits > 3 and sorted(slots) == list(range(1 << index.depth_bits))
    depths = {r["depth"] for r in slots.values()}
    assert len(depths) > 1 and max(depths) == index.depth_bits  # not every bucket needed the last doubling
    for s, r in slots.items():
        assert r["bucket"] == s >> (index.depth_bits - r["depth"]) << (index.depth_bits - r["depth"])
        assert r["owner"] >= slots[max(s - 1, 0)]["owner"]  # owners hold ranges of keys
    held = Counter()
    for r in index.rows.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("weight")).alias("w")).where("n > 1").collect():
        slot = (r["key"] % (1 << 64)) >> (64 - index.depth_bits)
        held[slots[slot]["bucket"]] += r["w"] if r["w"] * exact.HOT_PART <= 20_000 else 0
    assert max(held.values()) <= 20_000 < 2 * max(held.values())
    owners = {(r["key"], r["owner"]) for r in index.entries.collect()}
    assert len(owners) == len({k for k, _ in owners})


def test_a_hot_key_is_paged(spark, table):
    """Copies of one text are dealt to many owners and are one entry in the end."""
    rows = [(i, "hot " * 20, "s", "l") for i in range(2_000)] + [(5_000 + i, f"cold {i % 300}", "s", "l") for i in range(600)]
    index = exact.build(table(rows), bytes_each=10_000)
    entries = {r["keep_id"]: r["group_size"] for r in index.entries.collect()}
    assert entries[0] == 2_000 and len(entries) == 301


# ------------------------------------------------------------------------------------------- source divergence


def plain_audit(rows, least=10, top=10):
    docs = [(g or "", s or "", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t, s, g in rows]
    found = [(g, s, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)) for g, s, t in docs]
    out = []
    for g in {d[0] for d in found}:
        own = [d for d in found if d[0] == g]
        held = Counter(w for d in own for w in set(d[2]))
        kept = {w for w, n in held.items() if n >= least}
        sources = sorted({d[1] for d in own}, key=lambda s: s.encode())
        c = {s: Counter(w for d in own if d[1] == s for w in d[2] if w in kept) for s in sources}
        whole = sum(c.values(), Counter())
        share = lambda k, n: 1 + 1_000_000_000 * (k + 2) // (n + 2 * len(kept))
        p = {s: {w: share(c[s][w], sum(c[s].values())) for w in kept} for s in sources}
        q = {w: share(whole[w], sum(whole.values())) for w in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        rank = lambda items: sorted(items, key=lambda x: (-x[1], x[0].encode()))
        for s in sources:
            pairs = rank([(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in sources if o != s])
            words = rank([(w, f(p[s][w], q[w])) for w in kept if c[s][w] and p[s][w] > q[w]])[:top]
            out += [(g, s, part, i, v, k) for part, items in (("pair", pairs), ("term", words)) for k, (i, v) in enumerate(items, 1)]
    return sorted(out)


def corpus(n=400):
    words = ["Wind", "wind", "sea", "Étoile", "étoile", "ÉTOILE", "straße", "x1y", "don't", "日本", "ζ", "rare"] + [f"w{chr(97 + i)}" for i in range(12)]
    rows = []
    for i in range(n):
        pick = [words[(i * 7 + j * j * (1 + i % 3)) % (len(words) - (i % 5 > 0))] for j in range(i % 30)]
        rows.append((i, None if i % 97 == 0 else " ".join(pick) + "." * (i % 2), [None, "a", "b", "", "ä", "A", "big"][min(i % 9, 6)], [None, "en", "de"][i % 3]))
    return rows + [(9_000, "", "quiet", "en"), (9_001, "nothing kept", "solo", "tiny"), (9_002, None, "other", "tiny"), (9_003, "x", "lone", "single")]


def test_audit_equals_plain_counts(table):
    rows = corpus()
    rows += [rows[5]] * 3  # rows that repeat are documents
    got = divergence.audit(table(rows))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows)


def test_audit_of_little(table):
    assert divergence.audit(table([])).collect() == []
    assert divergence.audit(table([(1, "word", "s", "l")])).collect() == []
    two = divergence.audit(table([(1, "word", "s", "l"), (2, None, "t", "l")])).collect()
    assert sorted(map(tuple, two)) == [("l", "s", "pair", "t", 0, 1), ("l", "t", "pair", "s", 0, 1)]
    long = [(i, "word Word " * 50_000 if i == 0 else "word other", f"s{i % 2}", "l") for i in range(12)]
    assert sorted(map(tuple, divergence.audit(table(long)).collect())) == plain_audit(long)


def test_share_of_huge_counts(spark):
    values = [(0, 1, 1), (5 * 10**15, 6 * 10**15, 10**6), (10**12, 10**15, 3), (7, 8 * 10**15, 12345)]
    got = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, c long, n long, v long").select("i", divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    assert {r["i"]: r["p"] for r in got} == {i: 1 + 10**9 * (c + 2) // (n + 2 * v) for i, (c, n, v) in enumerate(values)}


# --------------------------------------------------------------------------------------------------- infilling


def plain_infill(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    form = "plain" if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(units), form, None if form == "plain" else len(p), None if form == "plain" else len(m), sha(out), sha(text), out)


TEXTS = ["", None, "a", "ab cd", "日本 x\n\r\ty", "<P>", "a<S>b", "x <M", "<", "<P<S", "S><", "M>", "éé", "\U0001f600\U0001f600a", "'\"\\", "a\x00b", "<p>", "P>a<", "﻿q", "1 2", " " * 50]


def test_infill_equals_plain(spark, table):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(1_500)] + [(None, "null id"), (-7, "minus"), (3, "again"), (3, "again"), (10**18, "ab " * 200_000), (9_999, "é" * 300_000)]
    t = table([(d, x, "s", "l") for d, x in rows])
    got = infill.transform(t)
    want = sorted((plain_infill(*r) for r in rows), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    short = infill.transform(t, with_output=False)
    assert short.columns == got.columns[:-1] and sorted((tuple(r) for r in short.collect()), key=str) == [w[:-1] for w in want]
    back = infill.restore(got.select("doc_id", "form", "output"))
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(((d, x or "") for d, x in rows), key=str)


def test_infill_of_nothing(spark, table):
    assert infill.transform(table([])).collect() == []
    odd = spark.createDataFrame([(1, None, "x"), (2, "psm", None)], "doc_id long, form string, output string")
    assert [r["text"] for r in infill.restore(odd).orderBy("doc_id").collect()] == [None, None]


def test_pairs_are_mirrored(table):
    got = {(r["lang"], r["source"], r["item"]): r["value"] for r in divergence.audit(table(corpus())).where("part = 'pair'").collect()}
    assert all(v == got[g, o, s] for (g, s, o), v in got.items())
    assert {(g, s, o) for g in ("en",) for s, o in permutations(["", "a", "b", "ä", "A", "big", "quiet"], 2) if (g, s, o) in got}
