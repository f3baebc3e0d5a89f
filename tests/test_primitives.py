"""Edge-value tables for the scalar primitives (FIXTURES.md §4)."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from veridq import spec
from veridq.functions import exprs as X


def _one(spark, vals, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_strip_and_blank(spark):
    vals = ["\ta\t", "\xa0b\xa0", "\x1fc", "   ", None, "　d ", "e"]
    assert _one(spark, vals, X.ustrip) == [v.strip() if v is not None else None for v in vals]
    assert _one(spark, vals, X.is_blank) == [v is None or v.strip() == "" for v in vals]


def test_upper_lower(spark):
    vals = ["R2D2", "123", "A", "<NA>", "abc", "ǅx", "Éé"]
    assert _one(spark, vals, X.is_all_upper) == [v.isupper() for v in vals]
    assert _one(spark, vals, X.is_all_lower) == [v.islower() for v in vals]


def test_dates(spark):
    fmts = spec.VALIDATE_DATE_FORMATS
    vals = ["1/5/1975", "13/01/2020", "2024-02-30", "2024-01-10x", "12024-01-10", "24-01-10", "0000-01-10",
            "invalid_date", "INVALID_DATE", " 2024-01-10 ", "05/06/2000"]

    def py(v):
        for f in ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y"):
            try:
                return dt.datetime.strptime(v.strip(), f).date()
            except ValueError:
                pass
        return None

    assert _one(spark, vals, lambda c: X.parse_date(c, fmts)) == [py(v) for v in vals]


def _py_float(v):
    try:
        return float(v.strip())
    except ValueError:
        return None


def _same(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b


def test_number_edges(spark):
    vals = ["1e3", "+5", " 5 ", "1_000", "1.5f", "12d", "inf", "nan", "0x10", "abc", "-Infinity", ".5", "5.", "1__0"]
    got = _one(spark, vals, X.parse_number)
    assert all(_same(g, _py_float(v)) for g, v in zip(got, vals)), list(zip(vals, got))


def test_number_grammar_random(spark):
    rnd = random.Random(7)
    alphabet = "0123456789_.eE+-infatyxd "
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    got = _one(spark, vals, X.parse_number)
    bad = [(v, g, _py_float(v)) for g, v in zip(got, vals) if not _same(g, _py_float(v))]
    assert not bad, bad[:10]


def test_empty_table(spark):
    from veridq.operators import pii as D
    from veridq.operators import profile as P
    from veridq.operators import validate as V

    cols = ", ".join(f"{c} string" for c in spec.CUSTOMER_COLUMNS)
    empty = spark.createDataFrame([], f"row_num bigint, {cols}")
    comp = P.completeness(empty).collect()
    assert len(comp) == 10 and all(r.complete_pct is None for r in comp)  # no division by zero
    assert P.row_health(empty).first().problem_pct is None
    assert V.failures(empty).count() == 0
    assert all(r.pct is None for r in D.coverage(empty).collect())


def test_result_independent_of_partitioning(raw):
    from veridq.operators import clean as C
    from veridq.operators import validate as V

    a = sorted(tuple(r) for r in V.failures(raw).collect())
    b = sorted(tuple(r) for r in V.failures(raw.repartition(7)).collect())
    assert a == b
    c1 = sorted(tuple(r) for r in C.clean(raw).collect())
    c2 = sorted(tuple(r) for r in C.clean(raw.repartition(5, "email")).collect())
    assert c1 == c2
