"""Deterministic customer-shaped view over ``orders`` (FIXTURES.md §2).

Ten string columns with seeded defects plus ``row_num = o_orderkey + 2``.  It is a
pure projection of the ``orders`` scan (no shuffle), so it scales with the table and
every partition is generated independently.  Rules per column: first match wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def _case(rules: list, default: str) -> str:
    """``rules`` = [(modulus, remainder, SQL value)], first match wins."""
    whens = " ".join(f"WHEN k % {m} = {r} THEN {v}" for m, r, v in rules)
    return f"CASE {whens} ELSE {default} END"


def _lit(v: str) -> str:
    return "'" + v.replace("'", "\\'") + "'"


# Built as SQL expression text: one call to the JVM per column instead of one per
# expression node, which keeps driver-side planning short.
P3, P4 = "lpad(CAST(k % 1000 AS STRING), 3, '0')", "lpad(CAST(k % 10000 AS STRING), 4, '0')"
MM, DD = "lpad(CAST(1 + k % 12 AS STRING), 2, '0')", "lpad(CAST(1 + k % 28 AS STRING), 2, '0')"
YY = "CAST(1950 + k % 50 AS STRING)"
NULL = "CAST(NULL AS STRING)"

COLUMNS = {
    "row_num": "CAST(k + 2 AS BIGINT)",
    "customer_id": _case([(211, 7, NULL), (223, 9, _lit("abc")), (227, 11, _lit("-4")),
                          (97, 5, "CAST(k AS STRING)")], "CAST(k + 1 AS STRING)"),
    "first_name": _case([(29, 3, NULL), (53, 9, _lit("   ")), (31, 4, _lit("PATRICIA")), (37, 5, _lit("jennifer")),
                         (41, 6, _lit("J")), (43, 7, _lit("o'brien")), (47, 8, _lit("R2D2")),
                         (4, 0, _lit("John")), (4, 1, _lit("Mary")), (4, 2, _lit("McKay"))], _lit("Ann-Lee")),
    "last_name": _case([(34, 3, NULL), (38, 4, _lit("wilson")), (46, 5, _lit("MOORE")), (3, 0, _lit("Doe")),
                        (3, 1, _lit("Smith"))], _lit("Brown")),
    "email": _case([(59, 1, NULL), (61, 2, _lit("not-an-email")), (62, 3, _lit("a@b@example.com"))],
                   "concat('user.', CAST(k AS STRING), '@example.com')"),
    "phone": _case([(67, 3, NULL),
                    (7, 0, f"concat('(555) ', {P3}, '-', {P4})"),
                    (7, 1, f"concat('555.', {P3}, '.', {P4})"),
                    (7, 2, f"concat('555', {P3}, {P4})"),
                    (7, 3, f"concat('+1-555-', {P3}, '-', {P4})"),
                    (77, 4, f"concat({P3}, '-', {P4})")],
                   f"concat('555-', {P3}, '-', {P4})"),
    "date_of_birth": _case([(71, 6, NULL), (17, 3, _lit("invalid_date")), (23, 5, _lit("1850-01-01")),
                            (73, 7, _lit("2001-02-30")), (79, 8, _lit("25/12/1990")), (74, 9, _lit("1990/07/22")),
                            (109, 2, _lit("2099-01-01")), (19, 4, f"concat({MM}, '/', {DD}, '/', {YY})")],
                           f"concat({YY}, '-', {MM}, '-', {DD})"),
    "address": _case([(13, 2, NULL)], "concat(CAST(k AS STRING), ' Main St')"),
    "income": _case([(11, 3, NULL), (83, 4, _lit("-5000")), (89, 5, _lit("15000000")), (101, 6, _lit("abc"))],
                    "CAST(20000 + (k * 37) % 100000 AS STRING)"),
    "account_status": _case([(15, 4, NULL), (16, 5, _lit("unknown")), (18, 6, _lit("ACTIVE")),
                             (3, 0, _lit("active")), (3, 1, _lit("inactive"))], _lit("suspended")),
    "created_date": _case([(103, 5, _lit("2099-06-01")), (107, 6, _lit("invalid_date"))],
                          f"concat('2024-', {MM}, '-', {DD})"),
}


def messy_from_orders(orders: DataFrame) -> DataFrame:
    k = orders.select(F.col("o_orderkey").alias("k"))
    return k.selectExpr(*[f"{expr} AS {name}" for name, expr in COLUMNS.items()])


_VIEWS: dict = {}


def messy(spark: SparkSession, sf_dir: str, deal: bool = True) -> DataFrame:
    """The view over ``{sf_dir}/orders.parquet``.  The (lazy, immutable) DataFrame is
    reused within a session while the scanned files are unchanged.  ``deal``: spread the
    column of an under-split file over all cores; a query that shuffles first has no use for it."""
    from veridq.sources.tables import fingerprint

    path = f"{sf_dir.rstrip('/')}/orders.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path, fingerprint(spark, path), deal)
    if key not in _VIEWS:
        keys = spark.read.parquet(path).select("o_orderkey")
        cores = spark.sparkContext.defaultParallelism
        if deal and keys.rdd.getNumPartitions() < cores:  # few row groups: deal out the one narrow column
            keys = keys.repartition(cores)
        _VIEWS[key] = messy_from_orders(keys)
    return _VIEWS[key]
