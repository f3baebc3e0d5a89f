"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veridq.session import new_path, setting

_SHIPPED: set[str] = set()

#: Rows handed from one Python task function to the JVM are cut at about this size.
SLICE_CHARS = 4_000_000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="veridq-ship-"), "veridq_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.join("veridq", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read from its own path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts the lineage,
    survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Removes a query's shuffle files when it ends, not when the JVM collects its plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tidy(spark: SparkSession) -> AbstractContextManager:
    """The shuffle files of queries inside are gone when each is done."""
    return setting(spark, CLEANUP, "true")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like :func:`materialise`, with the folder; leaves no shuffle files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`written` made and nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def arrow_map(df: DataFrame, make: Callable[[], Callable], schema: str, *cols: str) -> DataFrame:
    """``mapInArrow`` over the named columns.  ``make()`` runs once per task and
    returns ``f(columns as Python lists) -> dict of output columns``; the input batch
    is cut into slices so that one output batch stays small whatever the text length."""
    ship(df.sparkSession)
    names = list(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            lists = [batch.column(n) for n in names]
            for lo, hi in slices(batch):
                out = fn(*[c.slice(lo, hi - lo).to_pylist() for c in lists])
                if out is not None:
                    yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pydict(out, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)
    return df.select(*cols).mapInArrow(run, kind)


def slices(batch: pa.RecordBatch, chars: int = SLICE_CHARS) -> list[tuple[int, int]]:
    """Row ranges of about ``chars`` bytes each, one row at least."""
    n = batch.num_rows
    if not n:
        return []
    step = max(1, int(n * chars / max(batch.nbytes, 1)))
    return [(i, min(i + step, n)) for i in range(0, n, step)]


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
