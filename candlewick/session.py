"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Timestamps are read and shown in UTC; AQE sizes shuffles and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "candlewick", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, a warehouse in a store that all
    machines reach holds it. Only a session whose executors are this very machine (tests, a laptop) gets a
    local folder, which goes when the process ends; any other session has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir", "")
    if re.match("[A-Za-z][A-Za-z0-9+.-]+://", warehouse) and not warehouse.startswith("file:"):
        named = f"{warehouse.rstrip('/')}/_intermediate"
    elif re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        named = tempfile.mkdtemp(prefix="candlewick-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data; one that is not there is no error."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
