import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegraph.llm import embedding, quality, queries, topk, toxicity


def vectors(spark, rows):
    rows = [(i, x and [c if c is None else float(c) for c in x], *more) for i, x, *more in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links string, label int")


def brute_links(x, ids, least=0.95):
    ok = [i for i, v in enumerate(x) if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    near = {i: set() for i in range(len(x))}
    for a in ok:
        for b in ok:
            if a != b and len(x[a]) == len(x[b]):
                p, q = np.array(x[a], np.float32).astype(float), np.array(x[b], np.float32).astype(float)
                if p @ q / math.sqrt(p @ p) / math.sqrt(q @ q) >= least:
                    near[a].add(b)
    out = {}
    for i in range(len(x)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[ids[i]] = (len(near[i]), min(ids[j] for j in seen))
    return out


def test_embedding_links(spark):
    r = np.random.default_rng(0)
    base = r.normal(size=(30, 64))
    x = [list(b) for b in base]
    for k in range(120):
        b = base[k % 10] / np.linalg.norm(base[k % 10])
        x.append(list(b * r.uniform(0.1, 9) + r.normal(size=64) * r.choice([0, 0.01, 0.02, 0.03, 0.04]) * np.linalg.norm(b)))
    x += [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0], list(base[0]), list(base[0])]
    ids = [3 * i + 1 for i in range(len(x))]
    order = r.permutation(len(x))
    got = embedding.near_duplicates(vectors(spark, [(ids[i], x[i], "q", 1) for i in order] + [(None, x[0], "q", 1)])).collect()
    want = brute_links(x, ids)
    assert {v.vec_id: (v.n_links, v.component_id) for v in got if v.vec_id is not None} == want
    assert all(v.kept == (v.vec_id == v.component_id) for v in got if v.vec_id is not None) and len(got) == len(x) + 1


def test_code_bound_holds(spark):
    """The upper bound lies above the true inner product for all but a few in ten thousand pairs."""
    import pyarrow as pa

    r = np.random.default_rng(5)
    x = r.normal(size=(400, 64))
    x[200:] = x[:200] + r.normal(size=(200, 64)) * 0.2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(list(x), pa.list_(pa.float64()))], ["id", "v"])
    t = embedding._codes(16, 50)(batch).to_pydict()
    code = [c[0] & (1 << 64) - 1 for c in t["code"]]
    planes = [[p & (1 << 64) - 1 for p in v] for v in t["planes"]]
    below = errors = 0
    for a in range(200):
        for b in range(200, 400):
            s = sum((1 << j) * (code[a] & planes[b][j]).bit_count() for j in range(4))
            f = {k: (t[k][a], t[k][b]) for k in embedding.FACTS}
            total, ones = sum((1 << j) * planes[b][j].bit_count() for j in range(4)), code[a].bit_count()
            dot = (2 * (f["width"][1] * s + f["low"][1] * ones) - (f["width"][1] * total + f["low"][1] * 64)) / 8
            est = dot / f["align"][0]
            spread = math.sqrt((1 - f["align"][0] ** 2) / f["align"][0] ** 2 / 63)
            errors += est - x[a] @ x[b]
            below += est + 4 * (spread + f["width"][1] / f["align"][0] / 2) < x[a] @ x[b]
    assert below <= 4 and abs(errors / 40_000) < 0.01


def brute_top(rows, every, k):
    v = {i: np.floor(256 * np.array(x, np.float32).astype(float)) for i, x in rows if x is not None and i is not None and all(c is not None and math.isfinite(c) for c in x)}
    out = set()
    for q in v:
        if q % every == 0:
            s = sorted(((-int(v[q] @ v[j]), j) for j in v if j != q))[:k]
            out |= {(q, n + 1, j, -x) for n, (x, j) in enumerate(s)}
    return out


@pytest.mark.parametrize("n", [0, 1, 3, 700])
def test_top_k(spark, n):
    r = np.random.default_rng(n)
    rows = [(i, [float(c) for c in (r.normal(size=8) * r.uniform(0.1, 3) if i % 3 else np.ones(8) * (i % 5))]) for i in range(n)]
    bad = [(10_000, None), (10_050, [float("inf")] * 8), (10_100, [None] * 8), (None, [1.0] * 8)] if n else []
    got = topk.top_k(vectors(spark, [(i, x, "s", 0) for i, x in rows + bad]), every=50, ring=10, pivots=6, sample=100, block=60).collect()
    assert {tuple(x) for x in got} == brute_top(rows, 50, 5) and len(got) == len({tuple(x) for x in got})


def test_top_k_of_each_length(spark):
    r = np.random.default_rng(8)
    rows = {d: [(i, [float(c) for c in r.normal(size=d)]) for i in ids] for d, ids in ((8, range(0, 400)), (5, range(400, 520)), (3, [550, 551]), (2, [600]), (4, [701, 702]))}
    got = topk.top_k(vectors(spark, [(i, x, "s", 0) for part in rows.values() for i, x in part]), every=50, ring=10, pivots=6, sample=100, block=60).collect()
    assert {tuple(x) for x in got} == set().union(*(brute_top(part, 50, 5) for part in rows.values())) and len(got) == 8 * 5 + 3 * 5 + 1


def test_top_k_of_repeated_ids(spark):
    r = np.random.default_rng(3)
    rows = [(int(i), [float(c) for c in r.normal(size=6)]) for i in r.integers(0, 120, 400)]
    rows += rows[:50]
    v = [(i, np.floor(256 * np.array(x, np.float32).astype(float))) for i, x in rows]
    want = set()
    for q in {i for i, _ in v if i % 50 == 0}:
        score = {}
        for i, x in v:
            if i != q:
                score[i] = max(score.get(i, -math.inf), max(int(x @ y) for j, y in v if j == q))
        best = sorted((-s, i) for i, s in score.items())[:5]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    got = topk.top_k(vectors(spark, [(i, x, "s", 0) for i, x in rows]), every=50, ring=5, pivots=6, sample=100, block=30).collect()
    assert {tuple(x) for x in got} == want and len(got) == len(want)


def test_top_k_shares_annuli_among_tasks(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows = [(i, [float(c) for c in (r.normal(size=8) + 3 * np.eye(8)[i % 8])]) for i in range(900)]
    monkeypatch.setattr(topk, "CELLS", 64)
    got = topk.top_k(vectors(spark, [(i, x, "s", 0) for i, x in rows]), every=2, ring=20, pivots=8, sample=200, block=100).collect()
    assert {tuple(x) for x in got} == brute_top(rows, 2, 5)


def test_little_of_a_clustered_table_is_scored(spark):
    """Where vectors lie in clusters the bounds leave a small part of the table; where their directions are independent, most of it."""
    r = np.random.default_rng(5)
    centre = r.normal(size=(60, 24))
    near = vectors(spark, [(i, [float(c) for c in centre[i % 60] + 0.05 * r.normal(size=24)], "s", 0) for i in range(3_000)])
    assert topk.share_reached(near) < 0.2
    rows = [(x["vec_id"], list(x["embedding"])) for x in near.collect()]
    got = topk.top_k(near).collect()
    assert {tuple(x) for x in got} == brute_top(rows, 50, 5)
    far = vectors(spark, [(i, [float(c) for c in r.normal(size=24)], "s", 0) for i in range(1_000)])
    assert 0.2 < topk.share_reached(far) <= 1


def test_embedding_recall_on_planted_pairs(spark):
    """Of 3,000 vectors with pairs just above the threshold, found against brute force."""
    r = np.random.default_rng(7)
    x = r.normal(size=(3_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(1_000):
        d = r.normal(size=64)
        d -= (d @ x[i]) * x[i]
        c = r.uniform(0.951, 0.975)
        x[1_000 + i] = c * x[i] + math.sqrt(1 - c * c) * d / np.linalg.norm(d)
    f = x.astype(np.float32).astype(float)
    f /= np.linalg.norm(f, axis=1, keepdims=True)
    n = (f @ f.T >= 0.95).sum(1) - 1
    got = embedding.near_duplicates(vectors(spark, [(i, list(v), "q", 1) for i, v in enumerate(x)])).collect()
    assert n.sum() >= 1_990 and sum(min(g.n_links, n[g.vec_id]) for g in got) >= 0.999 * n.sum()
    assert all(g.n_links <= n[g.vec_id] for g in got)


def test_embedding_of_repeated_ids(spark):
    a, b, c = ([1.0 if i == k else 0.0 for i in range(8)] for k in range(3))
    near = lambda v, k: [x + (0.1 if i == k else 0.0) for i, x in enumerate(v)]
    rows = [(1, a, "s", 0), (1, b, "s", 0), (1, a, "s", 0), (5, near(a, 6), "s", 0), (6, near(b, 7), "s", 0), (7, c, "s", 0)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding.near_duplicates(vectors(spark, rows)).collect())
    assert got == [(1, 1, 1)] * 3 + [(5, 1, 1), (6, 1, 1), (7, 0, 7)]
    close = [(1, a, "s", 0), (1, near(a, 6), "s", 0), (2, near(a, 7), "s", 0)]  # each has the other two, whatever their ids
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding.near_duplicates(vectors(spark, close)).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_bands_miss_few_pairs():
    for n in (10, 10_000, 50_000, 10**9):
        bits, bands = embedding.bands_for(n, 0.95)
        assert (1 - (1 - math.acos(0.95) / math.pi) ** bits) ** bands <= embedding.MISS and bands < 1 << 10 and n * bands / 2**bits < 300


def test_embedding_queries_recall(spark, small):
    got = {tuple(r) for r in queries.op10_pivot_top_k(spark, small).collect()}
    rows = duckdb.sql(f"select vec_id, embedding from '{small}/embeddings.parquet'").fetchall()
    assert got == brute_top(rows, 50, 5)


def test_gradients():
    """Backward agrees with differences of forward."""
    r = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in toxicity.new_network(3).items()}
    x, first, length = r.normal(size=(60, 2 * toxicity.DIM)), np.array([0, 20, 50]), np.array([20, 32, 1])
    tape = {}
    toxicity.forward(net, x, first, length, tape)
    up = np.array([1.0, -0.5, 2.0])
    g, _ = toxicity.backward(net, tape, up)
    for k in ("w", "a", "Uf", "Ub", "Wf", "cb"):
        at = tuple(r.integers(0, s) for s in net[k].shape)
        kept = net[k][at]
        net[k][at] = kept + 1e-3
        hi = up @ toxicity.forward(net, x, first, length, {})
        net[k][at] = kept - 1e-3
        lo = up @ toxicity.forward(net, x, first, length, {})
        net[k][at] = kept
        assert abs((hi - lo) / 2e-3 - g[k][at]) < 2e-2 * max(1, abs(g[k][at]))


def test_gradients_reach_the_tables():
    r = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in toxicity.new_network(3).items()}
    net |= {k: r.normal(0, 0.3, net[k].shape) for k in ("word", "char")}
    x = toxicity.inputs([b"some idiotic words here and more of them some idiot words", b"x yz another set of little words"])
    first, length, _ = toxicity.windows(x.doc)
    up = np.array([1.0, -0.5])

    def embedded():
        out = np.zeros((len(x.word), 2 * toxicity.DIM))
        out[:, : toxicity.DIM] = net["word"][x.word]
        some = np.flatnonzero(np.diff(x.offsets))
        out[some, toxicity.DIM :] = np.add.reduceat(net["char"][x.runs], x.offsets[some])
        return out

    tape = {}
    toxicity.forward(net, embedded(), first, length, tape)
    for k, (rows, g) in toxicity.scatter(x, first, length, toxicity.backward(net, tape, up)[1]).items():
        for i in r.integers(0, len(rows), 8):
            at = rows[i], int(r.integers(toxicity.DIM))
            kept, side = net[k][at], []
            for d in (1e-4, -1e-4):
                net[k][at] = kept + d
                side.append(up @ toxicity.forward(net, embedded(), first, length, {}))
            net[k][at] = kept
            assert abs((side[0] - side[1]) / 2e-4 - g[i, at[1]]) < 1e-3 * max(1, abs(g[i, at[1]]))


def test_training_moves_every_column_of_the_tables():
    rows = toxic_rows(200, 3)
    start, net = toxicity.new_network(1), toxicity.train([t for t, _ in rows], [y for _, y in rows])
    assert all((net[k] != start[k]).any(0).all() for k in ("word", "char"))


def test_training_on_very_long_texts(spark):
    rows = [(i, t.decode(), y) for i, (t, y) in enumerate(toxic_rows(120, 6))]
    rows += [(200 + i, "word zorkle wyvxxab " * 20_000, 1) for i in range(3)] + [(300 + i, f"plain{i} text " * 20_000, 0) for i in range(3)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert toxicity.fit(d.select("doc_id", "text"), d.select("doc_id", "toxic")) is not None


def test_no_setting_outlives_an_operator(spark, small):
    before = dict(spark.conf.getAll)
    for op in (queries.op5_embedding_near_dedup, queries.op6_warc_salvage, queries.op8_html_main_text):
        op(spark, small).collect()
    assert dict(spark.conf.getAll) == before


def toxic_rows(n, seed):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        w = ["".join(r.choice(list("abcdefghi"), 6)) for _ in range(int(r.integers(5, 200)))]
        bad = i % 4 == 0
        if bad:
            for at in r.integers(0, len(w), 2):
                w[at] = r.choice(["zorkle", "wyvxx" + "".join(r.choice(list("abc"), 3))])
        out.append((" ".join(w).encode(), int(bad)))
    return out


def test_toxicity_learns_words_and_stems():
    rows = toxic_rows(400, 1)
    net = toxicity.train([t for t, _ in rows], [y for _, y in rows])
    new = toxic_rows(200, 2)
    p = toxicity.scores(net, [t for t, _ in new])
    assert ((p >= toxicity.PREDICT) == np.array([y == 1 for _, y in new])).mean() > 0.97
    long = b"abcdef ghiabc " * 40_000
    low, high = toxicity.scores(net, [long, long + b"zorkle zorkle wyvxxabc"])
    assert low < toxicity.PREDICT <= high
    assert (toxicity.scores(net, [None, b"", b" ?!"]) < 0.01).all()


def test_windows_cover_everything():
    first, length, text = toxicity.windows(np.array([0, 0, 5, 100, 232]))
    for t, (a, b) in enumerate([(0, 0), (0, 5), (5, 100), (100, 232)]):
        covered = set()
        for f, n, of in zip(first, length, text):
            if of == t:
                covered |= set(range(f, f + n))
        assert covered == set(range(a, b))


def test_models_without_labels(spark):
    d = spark.createDataFrame([(1, "a b", "s", "en", "x"), (2, None, None, None, "x"), (None, "", "s", "en", "x")], "doc_id long, text string, source string, lang string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert toxicity.fit(d, none) is None and quality.fit(d, none) is None
    scored = toxicity.score(d.withColumns({"toxic_score": F.lit(1), "_score": F.lit(2)}), None)
    assert scored.columns[-1] == "__score" and [(r["__score"], r["toxic_score"], r["_score"]) for r in scored.collect()] == [(0.0, 1, 2)] * 3
    assert [r.score for r in quality.score(d, None).collect()] == [0.5] * 3
    assert toxicity.score(d.limit(0), None).collect() == [] and quality.score(d.limit(0), None).collect() == []


def test_co_training_uses_both_views():
    r = np.random.default_rng(0)
    y = (r.random(600) < 0.5).astype(float)
    a, b = y[:, None] * 1.5 + r.normal(size=(600, 3)), y[:, None] * 1.5 + r.normal(size=(600, 2))
    m = quality.co_train((a[:100], b[:100]), y[:100], (a[100:400], b[100:400]))
    joint = ((m.score((a[400:], b[400:])) >= 0.5) == y[400:]).mean()
    single = max(((v.logit(x[400:]) >= 0) == y[400:]).mean() for v, x in zip(m.views, (a, b)))
    assert m.rounds and sum(map(sum, m.rounds)) > 0 and joint > 0.85 and joint >= single - 0.02


def test_held_out_accuracy(spark, small):
    base = small.replace("sf0.001", "sf0.01")
    for op, label, least in ((queries.op1_quality_co_training, "quality", 0.95), (queries.op4_toxicity, "toxic", 0.85)):
        got = {r.doc_id: r for r in op(spark, base).collect()}
        labels = duckdb.sql(f"select doc_id, {label} from '{base}/labels.parquet'").fetchall()
        held = [(got[d].predicted, y) for d, y in labels if got[d].held_out]
        assert all(0 <= r.score <= 1 for r in got.values()) and sum(p == y for p, y in held) / len(held) >= least
