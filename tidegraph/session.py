"""Session helper for tests, benchmarks and scripts; the operators only ever use the session they are given."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "tidegraph") -> SparkSession:
    """A local session in UTC with adaptive execution; on a cluster, build the session from the cluster's own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEGRAPH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers once per application, unless they find it by their own path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    app = spark.sparkContext.applicationId
    if app in _shipped or root in os.environ.get("PYTHONPATH", "").split(":"):
        return spark
    folder = tempfile.mkdtemp(prefix="tidegraph-ship-")
    path = f"{folder}/tidegraph_src.zip"
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(os.path.join(root, "tidegraph")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
    return spark
