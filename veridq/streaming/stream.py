"""X6 — micro-batch validation, masking, dedupe and event-quality windows.

* Masking is a plain ``readStream → transformations → writeStream``: each micro-batch is
  planned like the batch job.
* Validation writes the row-local failures and the ids of each micro-batch; a read adds
  the uniqueness rule over the ids of all batches.
* Keep-first dedupe, repeated ids and PII counts per window are keyed state in Spark's state
  store: a micro-batch touches the state of its own keys and never reads the history.  The
  groups it changed are written to a folder named by ``batchId`` with overwrite, so a
  replayed batch replaces its output; a read takes the last state of each group.
* PII tags are a projection of each message.
* Event quality per day: every micro-batch writes its own counts per day, which a read
  sums; events may arrive in any order and none is dropped as late.

Checkpoints and outputs live under the shared work folder
(``spark.checkpoint.dir``), never a machine-local path on a cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veridq import spec
from veridq.functions import exprs as X
from veridq.operators import extend as XT
from veridq.operators import mask as MK
from veridq.operators import pii as D
from veridq.operators import validate as V
from veridq.session import new_path
from veridq.sources.messy import messy_from_orders
from veridq.sources.tables import is_folder


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1) -> DataFrame:
    """A driver table, one file or a folder of files, as a file stream (``max_files`` per micro-batch)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return stream.parquet(path)
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)  # a stream's path is a folder


def _run(df: DataFrame, out: str, ck: str, mode: str = "append") -> None:
    q = (
        df.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", ck)
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()


def validate_batch(out: str, as_of=spec.GOLDEN_AS_OF):
    """foreachBatch function: the batch's row-local failures, and the ids that the
    uniqueness rule needs, in folders of the batch id (a replay replaces them)."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        local = V._local(batch, list(V.RULE_SETS), as_of)
        local.write.mode("overwrite").parquet(f"{out}/local/_batch={batch_id}")
        batch.select("row_num", "customer_id").write.mode("overwrite").parquet(f"{out}/ids/_batch={batch_id}")

    return fn


def stream_failures(spark: SparkSession, out: str) -> DataFrame:
    """All failures of the batches so far.  Uniqueness (V1d) is taken over the ids of all
    batches, so that rows may arrive in any order."""
    local = spark.read.parquet(f"{out}/local").drop("_batch")
    return local.unionByName(V.duplicate_failures(spark.read.parquet(f"{out}/ids").drop("_batch")))


def validate_stream(spark: SparkSession, sf_dir: str, as_of=spec.GOLDEN_AS_OF) -> DataFrame:
    out, ck = new_path(spark, "stream-validate"), new_path(spark, "ck-validate")
    s = messy_from_orders(stream_table(spark, sf_dir, "orders").select("o_orderkey"))
    q = (
        s.writeStream.foreachBatch(validate_batch(out, as_of)).option("checkpointLocation", ck)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return stream_failures(spark, out)


def mask_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = new_path(spark, "stream-mask"), new_path(spark, "ck-mask")
    s = messy_from_orders(stream_table(spark, sf_dir, "orders").select("o_orderkey"))
    _run(MK.mask(s), out, ck)
    return spark.read.parquet(out)


# Keyed state --------------------------------------------------------------------

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_state(df: DataFrame, out: str, ck: str):
    """Start a streaming aggregate in update mode: the groups that a micro-batch changed go to
    a folder of the batch id (a replay replaces it).  The state is on disk (RocksDB) and in
    the checkpoint; each batch reads and writes the state of its own groups only, whatever
    the history."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

    conf, key = df.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, ROCKSDB)  # read when the query starts
    try:
        return (
            df.writeStream.outputMode("update").foreachBatch(fn).option("checkpointLocation", ck)
            .trigger(availableNow=True).start()
        )
    finally:
        conf.set(key, before)


def keep_state(df: DataFrame, out: str, ck: str) -> None:
    start_state(df, out, ck).awaitTermination()


def read_state(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The last state of each group: its row of the latest batch that changed it.  Null keys
    are a group."""
    rows = spark.read.parquet(out)
    rest = [c for c in rows.columns if c not in (*keys, "_batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_last"))
    return last.select(*keys, *[F.col("_last").getField(c).alias(c) for c in rest])


def in_files(spark: SparkSession, sf_dir: str, name: str, columns: list[str], n: int = 3) -> DataFrame:
    """``columns`` of a driver table as a stream of ``n`` micro-batches.  A batch is as many
    files as there are cores: a file of one row group is read by one task."""
    cores = spark.sparkContext.defaultParallelism
    path = new_path(spark, f"files-{name}")
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)
    rows.repartition(n * cores).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", cores).parquet(path)


def first_rows(rows: DataFrame, key: str = "customer_id", order: str = "row_num") -> DataFrame:
    """Keep-first (C6) as a streaming aggregate: per key the row with the lowest ``order`` so
    far.  A lower row that arrives later takes the place, so the result is that of the batch
    operator in whatever order rows arrive."""
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*rows.columns), order).alias("_row")).select("_key", "_row.*")


def kept_rows(spark: SparkSession, out: str) -> DataFrame:
    return read_state(spark, out, ["_key"]).drop("_key")


def dedupe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = new_path(spark, "stream-dedupe"), new_path(spark, "ck-dedupe")
    keep_state(first_rows(messy_from_orders(in_files(spark, sf_dir, "orders", ["o_orderkey"]))), out, ck)
    return kept_rows(spark, out)


def key_counts(rows: DataFrame, key: str = "customer_id") -> DataFrame:
    """Valid ids as a streaming aggregate: first row and number of rows so far (V1d)."""
    p = V.id_parts(key)
    ids = V.derive(rows.select("row_num", key), [key]).where(p["valid"]).select("row_num", p["key"].alias("_key"))
    return ids.groupBy("_key").agg(F.min("row_num").alias("first_row"), F.count(F.lit(1)).alias("n"))


def duplicate_ids_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1d over a stream: rows that repeat an id.  The keys' counts are state; the ids of the
    batches are appended and joined with the few repeated keys when read."""
    out, ids = new_path(spark, "stream-keys"), new_path(spark, "stream-ids")
    rows = messy_from_orders(in_files(spark, sf_dir, "orders", ["o_orderkey"])).select("row_num", "customer_id")
    keep_state(key_counts(rows), out, new_path(spark, "ck-keys"))
    _run(rows, ids, new_path(spark, "ck-ids"))
    return repeated_ids(spark.read.parquet(ids), read_state(spark, out, ["_key"]))


def repeated_ids(rows: DataFrame, keys: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """V1d failures of ``rows`` by the state of their keys."""
    p = V.id_parts(id_col)
    each = V.derive(rows.select("row_num", id_col), [id_col]).where(p["valid"]).select("row_num", p["key"].alias("_key"), F.col(id_col).alias("value"))
    pre, post = spec.MSG_ID_DUPLICATE.split("{}")
    message = F.concat(F.lit(pre), F.col("first_row").cast("string"), F.lit(post))
    met = each.join(keys.where("n > 1"), "_key").where("row_num > first_row")
    return met.select("row_num", F.lit(id_col).alias("column"), F.lit(f"{id_col}.duplicate").alias("rule_id"), message.alias("rule"), "value")


# PII ----------------------------------------------------------------------------


def pii_tags(messages: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    """One row per message with its matches per detector and whether it has any: a projection,
    so a micro-batch needs nothing but its own messages."""
    n = {k: sum((F.regexp_count(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(p)) for c in text_cols), F.lit(0)) for k, p in D.DETECTORS.items()}
    tags = F.array_compact(F.array(*[F.when(F.col(f"n_{k}") > 0, F.lit(k)) for k in n]))
    return messages.select(id_col, *[v.cast("bigint").alias(f"n_{k}") for k, v in n.items()]).select("*", F.array_join(tags, ",").alias("pii"))


def pii_conversations_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of every message of ``conversations``, batch by batch."""
    out = new_path(spark, "stream-pii")
    rows = in_files(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    _run(pii_tags(rows.withColumn("msg_id", F.concat_ws(":", "conv_id", "turn")), "msg_id", ["text"]), out, new_path(spark, "ck-pii"))
    return spark.read.parquet(out)


def pii_windows(rows: DataFrame, event_date: Column) -> DataFrame:
    """Rows with personal data per detector and month of their event date, as a streaming
    aggregate.

    Lateness: no row is late.  A row adds to its month whenever it arrives; the state is a
    row per month and detector.  Rows without a date count under the null month."""
    flags = D.detector_flags()
    month = F.date_format(F.trunc(event_date, "month"), "yyyy-MM")
    each = F.array(*[F.struct(F.lit(k).alias("detector"), v.alias("hit")) for k, v in flags.items()])
    hits = rows.select(month.alias("month"), F.inline(each))
    return hits.groupBy("month", "detector").agg(F.count_if("hit").alias("n_rows"), F.count(F.lit(1)).alias("total"))


def pii_windows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "stream-pii-windows")
    rows = messy_from_orders(in_files(spark, sf_dir, "orders", ["o_orderkey"]))
    date = X.parse_date(X.ustrip("created_date"), spec.VALIDATE_DATE_FORMATS)
    keep_state(pii_windows(rows, date), out, new_path(spark, "ck-pii-windows"))
    return read_state(spark, out, ["month", "detector"])


def _count_days(out: str):
    """foreachBatch: counts per day of this batch, in a folder of its own, so that a
    replayed batch replaces its output."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
         .agg(F.count(F.lit(1)).alias("n_events"), F.count_if(XT.event_failure(batch)).alias("n_failed"))
         .write.mode("overwrite").parquet(f"{out}/_batch={batch_id}"))

    return fn


def event_quality_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-day event counts and failures (days of the session time zone).

    What is kept is a row per day and batch; a late event adds to its day."""
    out, ck = new_path(spark, "stream-events"), new_path(spark, "ck-events")
    ev = stream_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    q = (
        ev.writeStream.foreachBatch(_count_days(out))
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.parquet(out).groupBy("day").agg(F.sum("n_events").alias("n_events"), F.sum("n_failed").alias("n_failed"))
