from pyspark.sql import functions as F

from tests.conftest import SF001
from veridq.operators import validate as V
from veridq.sources.messy import messy
from veridq.streaming import stream as S


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_validate_equals_batch(spark):
    batch = V.failures(messy(spark, SF001))
    cols = ["row_num", "column", "rule_id", "rule", "value"]
    assert _rows(S.validate_stream(spark, SF001).select(*cols)) == _rows(batch.select(*cols))


def test_stream_validate_finds_repeats_across_batches(spark, tmp_path):
    """The same id in three batches, the first row last, and a replayed batch."""
    m = messy(spark, SF001).where("row_num between 2 and 4").withColumn("customer_id", F.lit("17"))
    fn, out = S.validate_batch(str(tmp_path)), str(tmp_path)
    for i, n in enumerate([4, 3, 2]):
        fn(m.where(F.col("row_num") == n), i)
    fn(m.where("row_num = 2"), 2)
    got = S.stream_failures(spark, out).where("rule_id = 'customer_id.duplicate'")
    assert sorted(r.row_num for r in got.collect()) == [3, 4]
    assert _rows(S.stream_failures(spark, out)) == _rows(V.failures(m))


def test_stream_dedupe_keeps_first(spark):
    got = S.dedupe_stream(spark, SF001)
    m = messy(spark, SF001)
    assert got.count() == m.select("customer_id").distinct().count()
    # every kept row is the lowest row of its id
    firsts = m.groupBy("customer_id").agg(F.min("row_num").alias("row_num"))
    assert got.join(firsts, ["row_num"], "left_anti").count() == 0


ROWS = "row_num long, customer_id string"
IDS = [[(4, "1"), (3, "2"), (5, "1")],     # id 1 twice, and again with a lower row in a later batch
       [(6, "2"), (7, "3"), (8, None)],    # id 2 seen before, null id
       [(9, None), (2, "1"), (10, "4")]]   # null seen before, the first row of id 1


def _files(spark, src, batches, first=0):
    for i, rows in enumerate(batches, first):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{src}/f{i}.parquet")


def _stream(spark, src):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)


def test_state_keeps_first_rows_over_batches_and_restarts(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    _files(spark, src, IDS[:2])
    S.keep_state(S.first_rows(_stream(spark, src)), out, ck)
    assert _rows(S.kept_rows(spark, out).select("row_num", "customer_id").na.fill("-")) == [(3, "2"), (4, "1"), (7, "3"), (8, "-")]
    _files(spark, src, IDS[2:], 2)  # the query stops and starts again from its checkpoint
    S.keep_state(S.first_rows(_stream(spark, src)), out, ck)
    want = [(2, "1"), (3, "2"), (7, "3"), (8, "-"), (10, "4")]
    assert _rows(S.kept_rows(spark, out).select("row_num", "customer_id").na.fill("-")) == want
    # a batch writes only the groups that it changed, and its replay replaces them
    last = spark.read.parquet(out).where("_batch = 2").drop("_batch")
    assert {"1", "4"} <= {r.customer_id for r in last.collect()} <= {"1", "4", None}
    rows = last.collect()
    spark.createDataFrame(rows, last.schema).write.mode("overwrite").parquet(f"{out}/_batch=2")
    assert _rows(S.kept_rows(spark, out).select("row_num", "customer_id").na.fill("-")) == want


def test_repeated_ids_from_state(spark, tmp_path):
    src, out, ids, ck = (str(tmp_path / n) for n in ("src", "out", "ids", "ck"))
    _files(spark, src, IDS)
    S.keep_state(S.key_counts(_stream(spark, src)), out, ck)
    S._run(_stream(spark, src), ids, ck + "-ids")
    got = S.repeated_ids(spark.read.parquet(ids), S.read_state(spark, out, ["_key"]))
    every = spark.createDataFrame([r for b in IDS for r in b], ROWS)
    assert _rows(got) == _rows(V.duplicate_failures(every)) and got.count() == 3


def test_pii_tags_and_windows(spark, tmp_path):
    rows = [("a", "mail me@x.org or you@y.com"), ("b", "call (555) 123-4567 on 2024-05-06"), ("c", ""), ("d", None), ("e", "x" * 100_000)]
    df = spark.createDataFrame(rows, "id string, text string")
    got = {r.id: (r.n_email, r.n_phone, r.n_date, r.pii) for r in S.pii_tags(df, "id", ["text"]).collect()}
    assert got == {"a": (2, 0, 0, "email"), "b": (0, 1, 1, "phone,date"), "c": (0, 0, 0, ""), "d": (0, 0, 0, ""), "e": (0, 0, 0, "")}
    m = messy(spark, SF001)
    date = S.X.parse_date(S.X.ustrip("created_date"), S.spec.VALIDATE_DATE_FORMATS)
    batch = S.pii_windows(m, date).select("month", "detector", "n_rows", "total").na.fill("-")
    streamed = S.pii_windows_stream(spark, SF001).select("month", "detector", "n_rows", "total").na.fill("-")
    assert _rows(streamed) == _rows(batch)
