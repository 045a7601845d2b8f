"""WARC archives: a writer of one compressed member a record, and a reader that salvages damaged ones.

Writing goes through Spark's text sink, so it works on any store that Spark writes to, and its commit protocol covers lost
executors and tasks that run again. The sink ends every row with a separator, which cannot be empty. A gzip member ends
with its length in four bytes, the last of them zero for anything under 16 MB: rows are members less that byte, and the
separator is the zero byte. A longer record is followed by an empty member, which ends with a zero byte too and inflates
to nothing. Files hold RECORDS records at most, each begins with a warcinfo record. The sink parts files by rows, not by
bytes: where a file has grown to ARCHIVE_BYTES before its rows are full, empty members fill it up, so no archive grows past
what a reader can hold.

Reading checks each member: it must inflate with the right CRC to a version line, headers, a block of the stated length
and a matching block digest, or to several such records (an archive compressed as one). When a check fails, the reader
searches for the next place where a member (or in an uncompressed archive a version line) passes all checks, goes
on from there, and logs the gap; each place is looked at once, so damage costs no more than what it damaged. Within a member that
holds several records the search goes on behind a damaged one, and of a member that breaks off the records before the
break are kept. Nothing raises.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, parts, shared_dir, ship, writing

VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
LEAST_REVISIT = 100  # bytes; shorter payloads are never revisits
RECORDS = 1_000  # a file
ARCHIVE_BYTES = 256 << 20  # after which no more records are put in a file
_EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()


# --------------------------------------------------------------------------------------------------- records


def _clean(value: str | None) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]+", "%20", value or "urn:x-unknown")


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 6) -> bytes:
    """A gzip member (no name, no time: the same bytes each time) whose last byte is zero."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = c.compress(raw) + c.flush()
    return out if out[-1] == 0 else out + _EMPTY_MEMBER


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """response with the payload as an HTTP message, or revisit without it if refers_to is set."""
    fields = [("WARC-Record-ID", f"<urn:x-page:{page_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", _clean(url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        return record("response", fields, head + payload)
    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
    return record("revisit", fields, head)


# --------------------------------------------------------------------------------------------------- reading


@dataclass
class Record:
    kind: str
    headers: dict[str, str]
    block: bytes
    offset: int


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_MAGIC = b"\x1f\x8b\x08"
MOST_HEADERS = 1 << 18  # bytes of a record's headers; more are damage


def _parse(raw: bytes, at: int) -> tuple[Record, int] | str:
    """The record at `at` of raw and where it ends, or what is wrong."""
    if not (m := _LINE.match(raw, at)):
        return "no version line"
    end = raw.find(b"\r\n\r\n", m.end() - 2, m.end() + MOST_HEADERS)
    if end < 0:
        return "headers do not end"
    headers: dict[str, str] = {}
    for line in raw[m.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            return "bad header line"
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", length):
        return "no content length"
    begin, stop = end + 4, end + 4 + int(length)
    if raw[stop : stop + 4] != b"\r\n\r\n":
        return "block does not end where it says"
    block = raw[begin:stop]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:].lower():
        return "block digest differs"
    return Record(headers.get("warc-type", ""), headers, block, at), stop + 4


def _inflate(data: memoryview, at: int, step: int = 1 << 15) -> tuple[bytes, int, str]:
    """The member at `at`, where it ends, and what is wrong with it ('' for nothing; then what comes before the damage);
    fed bit by bit, so that what follows is not copied each time."""
    d, parts, fed = zlib.decompressobj(31), [], at
    try:
        while not d.eof and fed < len(data):
            parts.append(d.decompress(data[fed : fed + step]))
            fed = min(fed + step, len(data))
    except zlib.error as e:
        return b"".join(parts), fed, f"gzip: {e}"
    return b"".join(parts), fed - len(d.unused_data), "" if d.eof else "gzip: cut short"


def _within(raw: bytes, offset: int) -> list[Record | Gap]:
    """The records of an inflated member and the gaps between them; those have the member's offset and inflated lengths."""
    out: list[Record | Gap] = []
    at, bad, why = 0, None, ""
    while at < len(raw):
        got = _parse(raw, at)
        if isinstance(got, str):
            if bad is None:
                bad, why = at, got
            line = _LINE.search(raw, at + 1)
            at = line.start() if line else len(raw)
            continue
        if bad is not None:
            out.append(Gap(offset, at - bad, f"within the member, from byte {bad}: {why}"))
            bad = None
        got[0].offset = offset
        out.append(got[0])
        at = got[1]
    if bad is not None:
        out.append(Gap(offset, len(raw) - bad, f"within the member, from byte {bad}: {why}"))
    return out


def read_archive(data: bytes) -> Iterator[Record | Gap]:
    """The records of an archive, compressed by record, as a whole or not at all, and the gaps between what could be read."""
    view, at, n = memoryview(data), 0, len(data)
    bad, why, line = None, "", 0  # line: no version line lies between what was searched and it
    while at < n:
        found: list[Record | Gap] = []
        after, wrong = at, ""
        if data[at : at + 3] == _MAGIC:
            raw, after, wrong = _inflate(view, at)
            if not wrong and raw:
                found = _within(raw, at)
                if not any(isinstance(x, Record) for x in found):
                    wrong = found[0].reason.partition(": ")[2]
            elif raw.count(b"WARC/1.") > 1:  # broken off among several records: the last one that begins is not whole
                found = [x for x in _within(raw[: raw.rfind(b"WARC/1.")], at) if isinstance(x, Record)]
        else:
            got = _parse(data, at)
            if isinstance(got, str):
                wrong = got
            else:
                found, after = [got[0]], got[1]
        if wrong:
            yield from found
            if bad is None:
                bad, why = at, wrong
            if line <= at:
                m = _LINE.search(data, at + 1)
                line = m.start() if m else n
            magic = data.find(_MAGIC, at + 1, line)
            at = magic if magic >= 0 else line
            continue
        if bad is not None:
            yield Gap(bad, at - bad, why)
            bad = None
        yield from found
        at = after
    if bad is not None:
        yield Gap(bad, n - bad, why)


# ----------------------------------------------------------------------------------------------------- Spark


def write(pages: DataFrame, path: str, least_revisit: int = LEAST_REVISIT, records: int = RECORDS, most: int = ARCHIVE_BYTES) -> None:
    """One record a row of pages (page_id, url, html) in .gz archives under path.

    A null html is an empty payload. Of equal payloads of least_revisit bytes or more the smallest page_id is written as
    response, the others as revisits of it; rows with the same smallest id are all responses, and rows without an id too.
    """
    ship(pages.sparkSession)
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    firsts = p.where(F.length("payload") >= least_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").select("digest", "first")
    p = p.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("refers_to"))
    info = member(record("warcinfo", [("WARC-Record-ID", "<urn:x-info:tidegraph>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"software: tidegraph\r\nformat: WARC File Format 1.1\r\n"))[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = size = 0
        for batch in (part for whole in batches for part in parts(whole, 200)):
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > most:
                    out += [_EMPTY_MEMBER[:-1]] * (-n % records)
                    n += -n % records
                if n % records == 0:
                    out.append(info)
                    n, size = n + 1, len(info)
                out.append(member(page_record(*row))[:-1])
                n, size = n + 1, size + len(out[-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = p.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    with writing(pages.sparkSession):
        rows.write.option("lineSep", "\x00").option("maxRecordsPerFile", records).mode("errorifexists").text(path)


RECORD = "archive string, offset long, kind string, record_id string, target_uri string, refers_to string, payload_digest string, payload binary, gap_length long, gap_reason string"


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row a record or gap (kind 'gap') of the archives under path; payload is the HTTP message's body, null for revisits."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.binary(), pa.int64(), pa.string()]
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size = [], 0
                for x in read_archive(data):
                    if isinstance(x, Gap):
                        rows.append((archive, x.offset, "gap", None, None, None, None, None, x.length, x.reason))
                    else:
                        h = x.headers
                        body = x.block.partition(b"\r\n\r\n")[2] if x.kind == "response" else None
                        rows.append((archive, x.offset, x.kind, h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"), h.get("warc-payload-digest"), body, None, None))
                        size += len(x.block)
                    if size > 8 << 20 or len(rows) >= 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, RECORD)


def quarantine(records: DataFrame) -> DataFrame:
    """The log of byte gaps: archive, offset, length, reason."""
    return records.where("kind = 'gap'").select("archive", "offset", F.col("gap_length").alias("length"), F.col("gap_reason").alias("reason"))


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes pages, reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    What a revisit refers to gives its payload's length; its digest is in its own header. Length and digest of a response
    are taken from the payload that was read. Nulls and repeated rows: see write(). No rows: no rows. Very long pages are
    records of their own size; archives stay bounded. Columns other than page_id, url and html are ignored.
    """
    spark = pages.sparkSession
    if path is None:
        import uuid

        path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:x-page:(-?[0-9]+)>', 1) AS long)")
    got = read(spark, path).where("kind IN ('response', 'revisit')")
    got = got.select(page("record_id").alias("page_id"), F.col("kind").alias("record_type"), page("refers_to").alias("refers_to"), F.length("payload").cast("long").alias("size"), F.coalesce(F.sha2("payload", 256), F.substring("payload_digest", 8, 64)).alias("payload_digest"))
    got = materialize(got, "records")
    sizes = got.where("record_type = 'response'").select(F.col("page_id").alias("of"), F.col("payload_digest").alias("of_digest"), F.col("size").alias("of_size")).distinct()
    out = got.join(sizes, (F.col("refers_to") == F.col("of")) & (F.col("payload_digest") == F.col("of_digest")), "left")
    return out.select("page_id", F.coalesce("size", "of_size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
