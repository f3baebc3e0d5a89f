"""Session helpers: local session for tests / bench, shared work folder lookup."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Wide rule sets fuse into one whole-stage-codegen method larger than HotSpot's
# 8 KB JIT limit; without this flag that method runs interpreted (2x slower here).
JIT_OPTS = "-XX:-DontCompileHugeMethods"

# Settings this library relies on; cluster deployments set the sizes themselves
# (and pass JIT_OPTS to executors through spark.executor.extraJavaOptions).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.extraJavaOptions": JIT_OPTS,
    "spark.executor.extraJavaOptions": JIT_OPTS,
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "veridq", extra=None) -> SparkSession:
    """Local session (tests, bench).  UI off: no server is started."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting for the queries run inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint folder already set
    on the context).  Only when neither exists (local tests) a private scratch
    folder is created and registered with ``setCheckpointDir`` — the config key
    itself is static and cannot be changed at runtime."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = getattr(spark.sparkContext, "master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="veridq-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared work folder."""
    import uuid

    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["local_session", "work_dir", "new_path", "setting", "RECOMMENDED_CONF", "JIT_OPTS"]
