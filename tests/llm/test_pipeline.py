"""The pipeline's stages against brute force, each on its own input."""

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import brute_cut, brute_near
from tidegraph.llm.common import materialize, table


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    names = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = materialize(stage(spark, docs, small), name)
        assert docs.columns == names, name
        rows[name] = ([(r.doc_id, r.text) for r in before.collect()], [(r.doc_id, r.text) for r in docs.collect()])
    near = brute_near(rows["near_dedup"][0])
    assert sorted(d for d, _ in rows["near_dedup"][1]) == sorted(d for d, (_, c) in near.items() if c == d)
    cut = brute_cut(rows["substring"][0])
    assert {d: len((t or "").split()) for d, t in rows["substring"][1]} == {d: n - gone for d, (n, gone, _) in cut.items()}
    assert len(rows["substring"][0]) == len(rows["substring"][1])
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{small}/labels.parquet'").fetchall())
    gone = {d for d, _ in rows["toxicity"][0]} - {d for d, _ in rows["toxicity"][1]}
    clean = [d for d, y in labels.items() if y == 0]
    assert len(gone & set(clean)) <= 0.05 * len(clean)
    packed = corpus_pipeline.pack(spark, docs, small).collect()
    assert len({r.doc_id for r in packed}) == len({d for d, _ in rows["mixing"][1]})
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring", "mixing", "packing"]


def test_registered():
    import __spark_entry__ as e

    ops = sorted(int(q[2:].split("_")[0]) for q in e.queries() if q.startswith("op"))
    assert ops == list(range(1, 14)) and "pipeline" in e.queries()


def test_stages_on_columns_of_any_name(spark, small):
    names = ["row_key", "kept_text", "toxic_score", "score", "_score", "size", "kept", "row", "copies", "node", "key"]
    docs = table(spark, small, "documents").withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, small), name)
        assert docs.columns[-len(names) :] == names, name
        assert docs.where(" or ".join(f"{n} <> concat('{n}', doc_id)" for n in names)).count() == 0, name
    assert docs.count() > 0 and corpus_pipeline.pack(spark, docs, small).count() > 0


def test_stages_on_no_rows_and_on_odd_ones(spark, small):
    docs = table(spark, small, "documents")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), small).count() == 0, name
    odd = spark.createDataFrame([(None, "a b c", None, None, 5), (1, None, "en", "s", None), (1, None, "en", "s", None), (2, "", None, "s", 0), (2, "", None, "s", 0)], docs.schema)
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, odd, small)
        assert out.columns == odd.columns and {(r.doc_id, r.text) for r in out.collect()} == {(None, "a b c"), (1, None), (2, "")}, name
    for _, stage in corpus_pipeline.STAGES[3:]:
        stage(spark, odd, small).collect()


def test_rows_that_near_dedup_keeps(spark):
    """Null ids and texts all stay; of an id and text that repeat one row does, whichever way the rows are dealt."""
    kind = "doc_id long, text string, source string"
    rows = [(None, "a b c", "x"), (None, "a b c", "y"), (None, "a b c", "x"), (5, None, "x"), (5, None, "x"), (5, None, "z"), (7, "one two", "p"), (7, "one two", "q"), (7, "one two", "q"), (7, "three", "q"), (8, "four", "r"), (8, "four", "r")]
    out = [corpus_pipeline.near_dedup(spark, spark.createDataFrame(r, kind).repartition(n), "").collect() for r, n in ((rows, 1), (rows[::-1], 5))]
    got = [sorted(map(tuple, o), key=str) for o in out]
    assert got[0] == got[1]
    left = [tuple(r) for r in got[0] if r[0] not in (7, 8)]
    assert left == sorted(rows[:6], key=str)
    assert [r[:2] for r in got[0] if r[0] in (7, 8)] == [(7, "one two"), (7, "three"), (8, "four")]


def test_scoring_of_very_long_texts_and_clashing_columns(spark, small):
    from tidegraph.llm import quality

    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    model = quality.fit(docs, labels)
    long = spark.createDataFrame([(1, "some plain words of prose. " * 100_000, "en", "web", "x", 0)], "doc_id long, text string, lang string, source string, predicted string, content int")
    [r] = quality.score(long, model).collect()
    assert 0 <= r.score <= 1
