"""Driver parquet tables (``{sf_dir}/{name}.parquet``)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

def fingerprint(spark: SparkSession, path: str) -> str:
    """Change detector for a file or folder: total length, file count and
    modification time (Hadoop FS; a constant number of calls)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    cs = fs.getContentSummary(p)
    st = fs.getFileStatus(p)
    raw = f"{path}|{cs.getLength()}|{cs.getFileCount()}|{st.getModificationTime()}"
    return hashlib.sha1(raw.encode()).hexdigest()[:20]


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of the given path; Catalyst prunes columns and pushes filters into it.

    The (lazy, immutable) scan is reused within a session; a changed source changes
    the fingerprint and therefore the key."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path, fingerprint(spark, path))
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


_SCANS: dict = {}
_SPLITS: dict = {}


def spread(spark: SparkSession, sf_dir: str, name: str, columns: list[str], *keys: str) -> DataFrame:
    """``columns`` of a table for work that is dear per row: dealt over all cores (by ``keys``
    if given) when the table has fewer row groups than there are cores, else as scanned.

    Splits are planned by bytes, but a row group is read by one task.  Only a table planned
    in few splits is looked at; its rows per split come from the file footers."""
    df, cores = table(spark, sf_dir, name).select(*columns), spark.sparkContext.defaultParallelism
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path, fingerprint(spark, path))
    if key not in _SPLITS:
        n = df.rdd.getNumPartitions()
        if n < 2 * cores:
            n = spark.read.parquet(path).groupBy(F.spark_partition_id()).count().count()
        _SPLITS[key] = n
    return df if _SPLITS[key] >= cores else df.repartition(cores, *keys)
