"""Inputs that once could stop or stall a task, or lose rows."""

import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from veridq.functions import exprs as X
from veridq.operators import pii as D
from veridq.plans.pipeline import run_pipeline
from veridq.sources import csv as CSV
from veridq.streaming import stream as S


def test_numbers_of_any_length(spark):
    cells = ["1" * 100_000, "1_" * 50_000 + "1", "+nan", "-NaN", "-inf", "+Infinity", "1_000", "1__0", "_1", "1_", "1_.5", "1.5f", ".5", "5.", "1e5", "1e", " 7 ", "."]
    got = [r.v for r in spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string").orderBy("i").select(X.parse_number("c").alias("v")).collect()]

    def python(c):
        try:
            return float(c)
        except ValueError:
            return None

    for c, v in zip(cells, got, strict=True):
        want = python(c)
        assert (v is None) == (want is None), c[:20]
        assert v is None or v == want or v != v and want != want


def test_long_quoted_field_and_line_breaks(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('a,b,c\n1,"x\ny",z\n2,"' + "q" * 100_000 + '",w\n3,"' + '""' * 2000 + '",w,extra\n')
    df = CSV.read_strings(spark, str(p))
    rows = df.orderBy("a").collect()
    assert len(rows) == 3 and rows[0].b == "x\ny" and len(rows[1].b) == 100_000
    assert CSV.count_wide_rows(df.cache(), 3) == 1


def test_email_scan_is_linear_and_equal(spark):
    texts = ["a" * 1_000_000, "a.b@c.de,x@y.org;..z@q.com@w.net", "no mail", "a@b.cc@d.ee f%g+h@i-j.kk"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    plain = r"(?U)[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
    t0 = time.time()
    got = df.select(F.regexp_extract_all("t", F.lit(D.DETECTORS["email"]), 0).alias("m")).collect()
    assert time.time() - t0 < 10
    want = df.where("i > 0").select(F.regexp_extract_all("t", F.lit(plain), 0).alias("m")).collect()
    assert [r.m for r in got][1:] == [r.m for r in want] and got[0].m == []


def test_stream_reads_a_folder_and_late_events(spark, tmp_path):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    for i, part in enumerate([2, 0, 1]):  # out of order
        ev.where(F.dayofmonth("ts") % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
        time.sleep(0.01 * i)
    got = S.event_quality_stream(spark, str(tmp_path))
    assert got.agg(F.sum("n_events")).first()[0] == ev.count()
    assert got.count() == ev.select(F.to_date("ts")).distinct().count()


def test_unreadable_history_stops_dedupe(spark, tmp_path):
    target = tmp_path / "t"
    (target / "_batch=0").mkdir(parents=True)
    (target / "_batch=0" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        S.dedupe_batch(str(target))(spark.createDataFrame([(1, "1")], "row_num long, customer_id string"), 1)
    assert not (target / "_batch=1").exists()


def test_failed_mask_stops_the_run_and_leaves_a_log(spark, raw, tmp_path, monkeypatch):
    from veridq.plans import pipeline

    def broken(*a, **k):
        raise RuntimeError("x" * 900)

    monkeypatch.setattr(pipeline.MK, "mask", broken)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, raw, out_dir=str(tmp_path / "r"))
    log = {r.stage: r for r in spark.read.parquet(str(tmp_path / "r" / "run_log")).collect()}
    assert log["mask"].status == "FAILED" and len(log["mask"].detail) == 900 and log["run"].status == "PARTIAL"
