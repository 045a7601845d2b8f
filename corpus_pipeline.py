"""Documents from raw rows to packed sequences: each stage applies one corpus operator to all that the stage before it kept.

toxicity      rows that the classifier rejects go
near_dedup    of each group of near-duplicate documents the one with the smallest id stays
substring     words of passages that begin in a document of smaller id as well are cut; n_chars follows the text
mixing        rows are repeated or left out as the sources' target weights say
packing       the last: one row a piece, with its place in a sequence

All but the last return the columns of their input. Stages are written as Parquet in the shared folder and read back, so a
stage's work is not done again for the next one and a lost executor costs a stage at most.

Every stage takes documents with columns of any other names beside doc_id, text and source, which go through, and gives no
rows for an empty table. Rows with a null id or text are kept by the first three stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm import minhash, mixing, packing, substring, toxicity
from tidegraph.llm.common import materialize, table
from tidegraph.llm.queries import tokenizer_path

#: The training labels do not change along the pipeline, so they are joined to the documents of the input folder.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what scores below the classifier's mark. Rows without text are kept."""
    net = toxicity.fit(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, net)
    return scored.where(F.col(f"`{scored.columns[-1]}`") < toxicity.PREDICT).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group. Of rows that share an id and a text, neither of them null, one stays: the one whose other
    columns have the smallest hash, so that reruns agree. Rows with a null id or text all stay."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    gone = minhash.near_duplicates(docs.select("doc_id", "text")).where(~F.col("kept")).select("doc_id").distinct()
    out = docs.join(gone, "doc_id", "left_anti").select(*names)
    real = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    again = real.groupBy(F.col("doc_id").alias("of"), F.xxhash64("text").alias("of_text")).agg(F.count(F.lit(1)).alias("rows"), F.min(F.xxhash64(*names)).alias("least"), F.lit(True).alias("again")).where("rows > 1")
    if again.isEmpty():  # narrow; most corpora have no such row
        return out
    rows = out.select(F.struct(*names).alias("row"), F.col("doc_id").alias("id"), F.col("text").isNotNull().alias("said"), F.xxhash64("text").alias("text_key"), F.xxhash64(*names).alias("key"))
    rows = rows.join(again, (F.col("id") == F.col("of")) & (F.col("text_key") == F.col("of_text")) & F.col("said"), "left")
    single = rows.where("again is null").select("row.*")
    return single.unionByName(rows.where("again AND key = least").dropDuplicates(["id", "text_key", "key"]).select("row.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages; a row whose text loses nothing is left as it was."""
    return substring.cut_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out rows so that the sources' words come near their targets."""
    return mixing.emit(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack_documents(docs.select("doc_id", "text"), tokenizer_path(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("substring", substring_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Tokenising and the classifier are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
