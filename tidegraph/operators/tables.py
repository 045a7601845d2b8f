"""Tables written between the steps of iterative operators, and keyed hashes that do not depend on the engine."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared(spark: SparkSession, fallback: str) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, one in the warehouse. A warehouse on the local disk will not do on a
    cluster, where each executor would write to its own: that raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    base, master = spark.conf.get("spark.sql.warehouse.dir").rstrip("/"), spark.sparkContext.master
    if master != "local" and not master.startswith("local[") and _located(spark, base)[0].getUri().getScheme() == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base}/{fallback}"


def scratch(spark: SparkSession, tag: str) -> str:
    """A path of its own in the shared() folder. What is written there goes when the application ends."""
    base = shared(spark, "_tables")
    path = f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """df through a Parquet table in a scratch path: cuts the lineage."""
    spark: SparkSession = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables that written() gave and that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_table", None):
            spark = df.sparkSession
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            fs.delete(p, True)
            fs.cancelDeleteOnExit(p)


def _located(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file whole, or leaves the one that there is and gives False: of several who try at once, one succeeds.

    The text is written beside it first; then the name is taken, by a hard link on a local disk, else by a rename, which must refuse to
    replace (as HDFS does).
    """
    jvm, (fs, p) = spark.sparkContext._jvm, _located(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return bool(fs.rename(draft, p))
        file = lambda x: jvm.java.io.File(x.toUri().getPath()).toPath()
        jvm.java.nio.file.Files.createLink(file(p), file(draft))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        return False
    finally:
        fs.delete(draft, False)


def published(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files that were published in a folder, in order."""
    fs, p = _located(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(n for n in (f.getPath().getName() for f in fs.listStatus(p)) if not n.endswith((".tmp", ".crc")))


def text_of(spark: SparkSession, path: str) -> str:
    fs, p = _located(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def keyed_hash(*parts: Column | int | str) -> Column:
    """32 bits of the MD5 of the parts as text, joined by '|': any engine gives the same."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
