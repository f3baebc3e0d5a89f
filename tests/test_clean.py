from collections import Counter

from tests import golden
from veridq import spec
from veridq.operators import clean as C

COLS = golden.HEADER.split(",")


def test_cleaned_equals_golden(raw):
    got = [tuple(r[c] for c in COLS) for r in C.clean(raw).orderBy("row_num").collect()]
    assert got == golden.rows(golden.CLEANED_CSV)


def test_audit_counts_golden(raw):
    cnt = {(r.step, r.column, r.action): r.n_rows for r in C.audit_counts(C.audit(raw)).collect()}
    assert cnt == {
        ("phone_format", "phone", "change"): 6,
        ("date_format", "date_of_birth", "change"): 1,
        ("date_format", "date_of_birth", "null"): 2,
        ("name_case", "first_name", "change"): 2,
        ("name_case", "last_name", "change"): 1,
        ("fill_missing", "first_name", "fill"): 1,
        ("fill_missing", "last_name", "fill"): 1,
        ("fill_missing", "address", "fill"): 2,
        ("fill_missing", "income", "fill"): 1,
        ("fill_missing", "account_status", "fill"): 1,
        ("dedupe", "customer_id", "drop"): 1,
        ("negative_income", "income", "change"): 1,
        ("income_over_limit", "income", "flag"): 1,
        ("invalid_status", "account_status", "flag"): 2,
        ("future_created_date", "created_date", "flag"): 1,
        ("extreme_age", "date_of_birth", "null"): 1,
    }
    aud = {(r.row_num, r.step): r for r in C.audit(raw).collect()}
    assert aud[(16, "dedupe")].note == "duplicate of row 2"
    assert aud[(13, "extreme_age")].note == "(~176.2 years old)"
    assert aud[(11, "name_case")].note == "'jennifer' -> 'Jennifer'"


def test_summary_and_before_after(raw):
    s = C.summary(raw).first()
    assert (s.rows_in, s.rows_out, s.rows_dropped, s.dob_missing) == (15, 14, 1, 3)
    t = C.before_after_totals(raw).first()
    assert (t.before, t.after, t.improvement) == (14, 6, 8)


def test_idempotent_with_protected_placeholders(raw):
    pol = spec.CleanPolicy(protect_placeholders=True)
    once = C.clean(raw, policy=pol)
    twice = C.clean(once, policy=pol)
    a = sorted(tuple(r) for r in once.collect())
    b = sorted(tuple(r) for r in twice.collect())
    assert a == b


def test_review_mode_changes_nothing(raw):
    pol = spec.CleanPolicy(fix=False)
    assert sorted(tuple(r) for r in C.clean(raw, policy=pol).collect()) == sorted(tuple(r) for r in raw.collect())
    acts = Counter(r.action for r in C.audit(raw, policy=pol).collect())
    assert set(acts) == {"flag"}


def test_edge_titles(spark):
    from pyspark.sql import functions as F
    from veridq.functions import exprs as X

    vals = ["o'brien", "mary-jane", "3rd", "McDonald", "[UNKNOWN]", "R2D2"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.t for r in df.select(X.title_case(F.col("v")).alias("t")).collect()]
    assert got == [v.title() for v in vals]


def test_dense_renumber(raw, spark):
    got = {r.row_num: r.clean_row_num for r in C.dense_renumber(C.clean(raw)).collect()}
    assert got[15] == 15 and 16 not in got and got[2] == 2
    # small bucket width exercises the cross-bucket offsets
    df = spark.range(0, 5000).selectExpr("id * 3 + 7 AS row_num").where("row_num % 7 <> 0")
    out = sorted((r.row_num, r.clean_row_num) for r in C.dense_renumber(df, width=64).collect())
    assert [c for _, c in out] == list(range(2, 2 + len(out)))
