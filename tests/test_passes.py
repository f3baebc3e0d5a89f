"""How often the data is read and the rules are run (findings of round 3)."""

import os

from pyspark.sql import functions as F

from veridq import spec
from veridq.functions import exprs as X
from veridq.operators import clean as C
from veridq.operators import gate as G
from veridq.operators import lineage as L
from veridq.operators import mask as MK
from veridq.operators import validate as V
from veridq.plans.pipeline import run_pipeline
from veridq.sources.messy import messy_from_orders
from veridq.streaming import stream as S


def rows(spark, path, n=400):
    """Messy rows, some of them twice, one without a number, stored."""
    keys = spark.range(n).select(F.when(F.col("id") != 7, F.col("id")).alias("o_orderkey"))
    messy_from_orders(keys.unionByName(keys.where("o_orderkey % 50 = 0"))).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().replace(spec.PY_WHITESPACE, "")


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def test_rules_run_once_for_all_outputs(spark, tmp_path):
    df = rows(spark, str(tmp_path / "rows"))
    V.check(df).write.parquet(str(tmp_path / "checked"))
    got = V.checked(spark.read.parquet(str(tmp_path / "checked")))
    assert got.failures.count() > 0 and same(got.failures, V.failures(df))
    assert same(got.row_status, V.row_status(df)) and same(got.column_summary, V.column_summary(df))
    assert same(got.overall, V.overall(df))


def test_pipeline_stores_a_given_table_once(spark, tmp_path):
    df = rows(spark, str(tmp_path / "rows"))
    res = run_pipeline(spark, df, out_dir=str(tmp_path / "run"))
    assert res.status == "SUCCESS"
    assert os.path.isdir(tmp_path / "run" / "_input") and os.path.isdir(tmp_path / "run" / "_checked")
    assert same(spark.read.parquet(str(tmp_path / "run" / "_input")), df)


def test_gate_counts_the_failures_that_validation_found(spark, tmp_path, monkeypatch):
    df = rows(spark, str(tmp_path / "rows"))
    want = G.stage(df, str(tmp_path / "alone"), "b", max_failure_rate=1.0)

    def again(*a, **k):
        raise AssertionError("the rules run a second time")

    with monkeypatch.context() as m:
        m.setattr(V, "with_failures", again)
        res = run_pipeline(spark, df, out_dir=str(tmp_path / "run"), publish_dir=str(tmp_path / "store"), max_failure_rate=1.0)
    assert res.status == "SUCCESS"
    (got,) = G.batches(spark, str(tmp_path / "store")).collect()
    assert (got.n_rows, got.n_failed, got.gate) == (want.n_rows, want.n_failed, want.gate) and got.n_failed > 0
    for view in (G.published, G.quarantined):
        assert same(view(spark, str(tmp_path / "store")).drop("batch"), view(spark, str(tmp_path / "alone")).drop("batch"))

    with monkeypatch.context() as m:  # a failed validation takes nothing from the gate
        m.setattr(V, "check", again)
        held = run_pipeline(spark, df, out_dir=str(tmp_path / "held"), publish_dir=str(tmp_path / "other"))
    assert held.status == "HELD" and [s[2] for s in held.stages if s[1] in ("validate", "gate")] == ["FAILED", "HELD"]


def test_audit_reads_the_rows_twice(spark, tmp_path):
    df = rows(spark, str(tmp_path / "rows"))
    assert plan(C.audit(df)).count("Relation") == 2  # first rows per key, and the entries


def test_lineage_reads_the_audit_once(spark, tmp_path):
    df = rows(spark, str(tmp_path / "rows"))
    C.audit(df).write.parquet(str(tmp_path / "audit"))
    got = L.replay(df, spark.read.parquet(str(tmp_path / "audit")))
    assert plan(got).count("Relation") == 2
    # of rows with one number the audit drops none, so they are compared as a set
    assert same(C.clean(df.where("row_num is not null")).distinct(), got.where("row_num is not null").distinct())


def test_masking_strips_each_value_once(spark, tmp_path):
    df = rows(spark, str(tmp_path / "rows"))
    assert plan(MK.mask(df)).count("trim(") == 6


def test_plain_values_take_the_cheap_path_with_the_same_result(spark):
    values = ["2024-02-29", "2023-02-29", "0000-01-01", "2024-1-5", " 2024-01-05 ", "01/02/2024", "25/12/1990", "2024-01-05x", "", None, "x"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [str(r[0]) for r in df.select(X.parse_date("v", spec.VALIDATE_DATE_FORMATS)).collect()]
    assert got == ["2024-02-29", "None", "None", "2024-01-05", "2024-01-05", "2024-01-02", "1990-12-25", "None", "None", "None", "None"]
    assert "cast(" in plan(df.select(X.parse_date("v", spec.VALIDATE_DATE_FORMATS).alias("d"))).lower()


def test_a_micro_batch_is_as_many_files_as_cores(spark, tmp_path, monkeypatch):
    spark.range(1000).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(S, "new_path", lambda spark, name: str(tmp_path / name))
    stream, seen = S.in_files(spark, str(tmp_path), "orders", ["o_orderkey"]), []
    cores = spark.sparkContext.defaultParallelism
    assert sum(f.endswith(".parquet") for f in os.listdir(tmp_path / "files-orders")) == 3 * cores
    q = stream.writeStream.foreachBatch(lambda b, i: seen.append(b.count())).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert len(seen) == 3 and sum(seen) == 1000
