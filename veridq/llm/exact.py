"""Exact duplicates through an extendible-hash index on shared files.

1. ``combine`` runs over the input partitions: equal texts met in one partition are
   collapsed to one entry (key, bytes, count, largest id), so a text that a third of
   all rows share leaves each partition once.
2. The index directory starts with one bucket and doubles: a bucket with more entries
   than ``capacity`` is split by the next bit of its keys until it fits or its keys are
   all the same.  Only counts by key prefix reach the driver.
3. Owner tasks each take whole buckets (key ranges), read their entries in key order,
   chain entries with the same 64-bit key and compare bytes; they write the index
   files, one folder per bucket, to the shared work folder.
4. Counts and the row to keep are aggregated by class, then go back to the rows.

Texts are equal when identical after lower-casing A-Z.  Edge cases: null counts as
empty; of equal texts the row with the largest id stays, a null id is the smallest,
and of repeated rows with that id one stays; an empty table gives no rows; further
columns of the input are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.taskcontext import TaskContext

from veridq.llm.common import free_name, materialise, ship, slices
from veridq.session import new_path

CAPACITY = 16_384  # entries in a bucket
STEP_BITS = 8  # key bits counted at a time
HELD_BYTES = 24 << 20  # texts held by one task while combining

ROWS = "entry boolean, row long, doc_id long, key long, sha binary, rep long, n long, top_id long, top_row long, text binary"


class Held:
    """Entries of one input partition that can still grow."""

    def __init__(self):
        self.by_key: dict[int, list[list]] = {}
        self.size = 0

    def add(self, row: int, doc_id: int | None, key: int, text: bytes) -> int:
        """The representative row of ``text``."""
        for e in self.by_key.get(key, ()):
            if e[4] == text:
                e[1] += 1
                if (doc_id is not None, doc_id or 0, row) > (e[2] is not None, e[2] or 0, e[3]):
                    e[2], e[3] = doc_id, row
                return e[0]
        self.by_key.setdefault(key, []).append([row, 1, doc_id, row, text])
        self.size += len(text) + 200
        return row

    def drain(self) -> list[tuple]:
        out = [(True, None, None, key, None, rep, n, top, top_row, text) for key, chain in self.by_key.items() for rep, n, top, top_row, text in chain]
        self.by_key, self.size = {}, 0
        return out


def key_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def combine(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Rows (entry false) with their local representative, and entries (entry true).
    ``row``: a column of ``docs`` that numbers its rows; made here if not given."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(docs.sparkSession)
    kind = StructType.fromDDL(ROWS)
    arrow = to_arrow_schema(kind)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    def run(batches):
        held, part = Held(), TaskContext.get().partitionId() << 33
        count = 0
        for batch in batches:
            for lo, hi in slices(batch):
                out = []
                cols = [batch.column(c).slice(lo, hi - lo).to_pylist() for c in range(batch.num_columns)]
                for i, (d, t) in enumerate(zip(cols[0], cols[1], strict=True)):
                    r = cols[2][i] if len(cols) > 2 else part + count
                    count += 1
                    norm = (t or "").encode().lower()
                    sha = hashlib.sha256(norm).digest()
                    key = key_of(sha)
                    out.append((False, r, d, key, sha, held.add(r, d, key, norm), None, None, None, None))
                yield batch_of(out)
                if held.size > HELD_BYTES:
                    yield from parts(held.drain())
        yield from parts(held.drain())

    def parts(rows: list[tuple]):
        for i in range(0, len(rows), 1024):
            yield batch_of(rows[i : i + 1024])

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")] + ([F.col(row).alias("row")] if row else [])
    return docs.select(*cols).mapInArrow(run, kind)


def directory(keys: DataFrame, capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """(prefix, depth, entries) of each bucket, by doubling from one bucket of depth 0.

    Counts by prefix are read ``STEP_BITS`` bits at a time and only below overfull
    prefixes, so what reaches the driver is bounded by the number of buckets."""
    done: list[tuple[int, int, int]] = []
    full: list[int] | None = None  # overfull prefixes of the last depth; None: all keys
    depth = 0
    while full is None or full:
        below = keys if full is None else keys.where(F.shiftrightunsigned("key", 64 - depth).isin(full))
        deeper = depth + STEP_BITS
        counts = {r.p: r.n for r in below.groupBy(F.shiftrightunsigned("key", 64 - deeper).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        nxt: list[int] = []
        for root in [0] if full is None else full:
            todo = [(root, depth)]
            while todo:
                prefix, d = todo.pop()
                lo, hi = prefix << (deeper - d), (prefix + 1) << (deeper - d)
                n = sum(counts.get(p, 0) for p in range(lo, hi))
                if n <= capacity or d == 56:
                    done.append((prefix, d, n))
                elif d == deeper:
                    nxt.append(prefix)
                else:
                    todo += [(2 * prefix, d + 1), (2 * prefix + 1, d + 1)]
        full, depth = nxt, deeper
    return sorted(done, key=lambda b: b[0] << (64 - b[1]))


def bucketed(entries: DataFrame, buckets: list[tuple[int, int, int]]) -> DataFrame:
    """``entries`` with their bucket: the directory has one slot per prefix of the
    global depth, and slots of a shallower bucket point to the same one."""
    depth = max(d for _, d, _ in buckets)
    slots = [(s, b) for b, (p, d, _) in enumerate(buckets) for s in range(p << (depth - d), (p + 1) << (depth - d))]
    spark = entries.sparkSession
    table = spark.createDataFrame(slots, "slot long, bucket long")
    slot = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    return entries.withColumn("slot", slot).join(table, "slot").drop("slot")


def chain(entries: DataFrame) -> DataFrame:
    """Entries in key order with the class they belong to: the representative of the
    first entry of the same key with the same bytes."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = StructType.fromDDL("bucket long, key long, rep long, class long")
    arrow = to_arrow_schema(kind)

    def run(batches):
        last, links = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("bucket", "key", "rep")]
            texts = batch.column("text")
            classes = []
            for i, (key, rep) in enumerate(zip(cols[1], cols[2], strict=True)):
                if key != last:
                    last, links = key, []
                text = texts[i].as_py()
                found = next((c for c, t in links if t == text), None)
                if found is None:
                    links.append((rep, text))
                    found = rep
                classes.append(found)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(classes, pa.int64())], schema=arrow)

    return entries.select("bucket", "key", "rep", "text").mapInArrow(run, kind)


def dedup(docs: DataFrame, capacity: int = CAPACITY, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row."""
    spark = docs.sparkSession
    at = new_path(spark, "exact")
    combine(docs, row).write.partitionBy("entry").parquet(f"{at}/combined")
    both = spark.read.schema(ROWS).option("basePath", f"{at}/combined").parquet(f"{at}/combined")
    rows, entries = both.where(~F.col("entry")), both.where("entry")
    buckets = directory(entries.select("key"), capacity)
    met = bucketed(entries.select("key", "rep", "text"), buckets)
    again = entries.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1").drop("met")
    owners = met.join(again, "key", "left_semi").repartition("bucket").sortWithinPartitions("bucket", "key", "rep")
    alone = met.join(again, "key", "left_anti").select("bucket", "key", "rep", F.col("rep").alias("class"))
    ship(spark)
    chain(owners).unionByName(alone).write.partitionBy("bucket").parquet(f"{at}/index")
    index = spark.read.schema("key long, rep long, class long, bucket long").parquet(f"{at}/index").select("rep", "class")
    stats = entries.select("rep", "n", "top_id", "top_row").join(index, "rep")
    top = F.max(F.struct(F.col("top_id").isNotNull().alias("real"), "top_id", "top_row")).alias("top")
    classes = stats.groupBy("class").agg(F.sum("n").alias("group_size"), top)
    by_rep = stats.select("rep", "class").join(classes, "class").select("rep", "group_size", "top")
    return rows.select("row", "doc_id", "sha", "rep").join(by_rep, "rep").select(
        "doc_id",
        F.col("top.top_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.top_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "row",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps.  The rows are numbered and
    written once: a number made twice could fall on another row when splits or executors
    change."""
    row = free_name(docs, "row")
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "exact-numbered")
    kept = dedup(numbered, row=row).where("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)
