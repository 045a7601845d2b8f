"""Fill-in-the-middle documents: DuckDB inside mapInArrow, a batch at a time.

Each Arrow batch is registered as a table and one SQL statement cuts its texts into units, chooses the two cuts and the form from a
hash of the id, puts the parts together, takes them apart again and digests both; the result goes back as Arrow. No row is handled in
Python and nothing is shuffled. Batches are cut by rows and bytes, so a task holds one slice, or one long text; DuckDB runs in one thread.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship
from .common import parts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SLICE_ROWS, SLICE_BYTES = 2048, 1 << 20  # a unit of a character takes 16 bytes in a list
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

# Each mark is there once in an output that is not plain, because texts that hold a mark stay plain and no mark can arise
# over an edge: it would have to begin or end inside another.
RESTORE = f"""CASE form WHEN 'plain' THEN output
  WHEN 'psm' THEN split_part(substr(output, 4), '{SUFFIX}', 1) || split_part(output, '{MIDDLE}', 2) || split_part(split_part(output, '{SUFFIX}', 2), '{MIDDLE}', 1)
  ELSE split_part(split_part(output, '{PREFIX}', 2), '{MIDDLE}', 1) || split_part(output, '{MIDDLE}', 2) || split_part(substr(output, 4), '{PREFIX}', 1) END"""

TRANSFORM = f"""
WITH units AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, sha256('{{seed}}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM batch)
), drawn AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM units
), cut AS (
  SELECT doc_id, text, n, form, CASE WHEN form = 'plain' THEN NULL ELSE coalesce(array_to_string(list_slice(u, 1, least(c1, c2)), ''), '') END AS prefix,
    CASE WHEN form = 'plain' THEN NULL ELSE coalesce(array_to_string(list_slice(u, least(c1, c2) + 1, greatest(c1, c2)), ''), '') END AS middle
  FROM drawn
), made AS (
  SELECT doc_id, n, form, CAST(length(prefix) AS BIGINT) AS prefix_chars, CAST(length(middle) AS BIGINT) AS middle_chars,
    CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || substr(text, length(prefix) + length(middle) + 1) || '{MIDDLE}' || middle
      ELSE '{SUFFIX}' || substr(text, length(prefix) + length(middle) + 1) || '{PREFIX}' || prefix || '{MIDDLE}' || middle END AS output
  FROM cut
)
SELECT doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256, sha256({RESTORE}) AS restored_sha256{{output}} FROM made
"""


def _run(df: DataFrame, sql: str, schema: str) -> DataFrame:
    """sql over each slice of df, which it knows as batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    fields = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(":memory:", config={"threads": 1, "temp_directory": ""}) as db:
            for batch in batches:
                for part in parts(batch, SLICE_ROWS, SLICE_BYTES):
                    db.register("batch", pa.Table.from_batches([part]))
                    out = db.sql(sql).to_arrow_table()
                    db.unregister("batch")
                    yield from out.select(fields.names).cast(fields).to_batches()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def transform(docs: DataFrame, seed: int = 1, with_output: bool = True) -> DataFrame:
    """One row a document: doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (null where plain), output_sha256,
    restored_sha256 (of the text rebuilt from output and form), and the output itself unless with_output is false.

    A unit is a run of A-Z and a-z or one other code point. Nulls: a null text is empty and stays plain; a null id draws as an empty one.
    Repeated rows get the same cuts. A text that holds a mark stays plain. Very long texts are one unit list each: about forty bytes
    a character at worst. No rows: no rows. Columns other than doc_id and text are ignored, whatever their names. Same id and text, same result.
    """
    rows = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    return _run(rows, TRANSFORM.format(seed=seed, output=", output" if with_output else ""), SCHEMA + (", output string" if with_output else ""))


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id and text, from doc_id, form and output. A null form or output gives a null text."""
    sql = f"SELECT doc_id, CASE WHEN form IS NULL THEN NULL ELSE {RESTORE} END AS text FROM batch"
    return _run(outputs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "form", "output"), sql, "doc_id long, text string")
