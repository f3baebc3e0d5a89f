"""Profiling.

Shapes at scale:
* completeness / conformance / PII coverage: one hash aggregate with partial
  (map-side) combine → a one-row result, then ``inline`` to long form.
* format histograms: ``groupBy(format)`` (partial + final) for counts; examples come
  from a ``row_number() <= 2`` window that the planner prunes per task before the
  shuffle (``WindowGroupLimit``), so no group is ever collected whole.
* issues: one ``array(struct)`` projection + ``inline`` (no shuffle); the phone issue
  needs the first row of each phone value: a partial aggregate per value joined back
  (AQE broadcasts it when small and splits a skewed value otherwise).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veridq import spec
from veridq.functions import exprs as X

ISSUE_FIELDS = ["row_num", "column", "type", "severity", "value", "age_years"]


# ---------------------------------------------------------------------------
# P1 completeness, P2 type conformance
# ---------------------------------------------------------------------------

def _long(one_row: DataFrame, structs: list[Column], keep: list[str]) -> DataFrame:
    return one_row.select(*keep, F.inline(F.array(*structs)))


def completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """P1 — per column: total, missing (blank), complete_pct."""
    columns = columns or [c for c in df.columns if c != "row_num"]
    agg = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(X.is_blank(F.col(c).cast("string"))).alias(f"_m{i}") for i, c in enumerate(columns)],
    )
    structs = [
        F.struct(F.lit(i + 1).cast("bigint").alias("position"), F.lit(c).alias("column"),
                 F.col(f"_m{i}").alias("missing"))
        for i, c in enumerate(columns)
    ]
    out = _long(agg, structs, ["total"])
    return out.select(
        "position", "column", "total", "missing",
        X.pct(F.col("total") - F.col("missing"), F.col("total")).alias("complete_pct"),
    )


_FAMILY = {
    "INT": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "NUMERIC": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType),
    "DATE": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "STRING": (T.StringType,),
}


def _castable(c: str, logical: str) -> Column:
    """Whether the stripped value ``c`` parses."""
    v = F.col(c)
    if logical == "INT":
        n = X.parse_number(v, v)
        return n.isNotNull() & X.is_finite(n) & (n == F.floor(n))
    if logical == "NUMERIC":
        return X.parse_number(v, v).isNotNull()
    if logical == "DATE":
        return X.parse_date(v, spec.VALIDATE_DATE_FORMATS, v).isNotNull()
    return F.lit(True)


def type_conformance(df: DataFrame, logical_types: dict | None = None) -> DataFrame:
    """P2 — physical vs logical type, plus how many non-blank values parse as the
    logical type."""
    logical_types = logical_types or spec.LOGICAL_TYPES
    cols = [c for c in df.columns if c != "row_num"]
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(cols):
        lt = logical_types.get(c, "UNKNOWN")
        nb = F.col(c) != ""
        aggs += [F.count_if(nb).alias(f"_n{i}"), F.count_if(nb & ~_castable(c, lt)).alias(f"_u{i}")]
    stripped = df.select(*[X.ustrip(F.col(c).cast("string")).alias(c) for c in cols])
    agg = stripped.agg(*aggs)
    structs = []
    for i, c in enumerate(cols):
        lt = logical_types.get(c, "UNKNOWN")
        phys = fields[c]
        ok = isinstance(phys, _FAMILY.get(lt, (T.StringType,)))
        structs.append(F.struct(
            F.lit(i + 1).cast("bigint").alias("position"), F.lit(c).alias("column"),
            F.lit(phys.simpleString().upper()).alias("detected"), F.lit(lt).alias("expected"),
            F.lit("OK" if ok else "FAIL").alias("status"),
            F.col(f"_n{i}").alias("non_blank"), F.col(f"_u{i}").alias("unparseable"),
        ))
    return _long(agg, structs, [])


# ---------------------------------------------------------------------------
# P3 / P4 format histograms, P5 key uniqueness
# ---------------------------------------------------------------------------

def _histogram(vals: DataFrame, group: list[str]) -> DataFrame:
    """vals(row_num, value, *group) → group, n_rows, first_row, example_1, example_2."""
    counts = vals.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"), F.min("row_num").alias("first_row"))
    w = Window.partitionBy(*group).orderBy("row_num")
    top = vals.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2)
    ex = top.groupBy(*group).agg(
        F.max(F.when(F.col("_rn") == 1, F.col("value"))).alias("example_1"),
        F.max(F.when(F.col("_rn") == 2, F.col("value"))).alias("example_2"),
    )
    return counts.join(ex, group)


def phone_formats(df: DataFrame, c: str = "phone") -> DataFrame:
    """P3 — phone format histogram over non-blank values (first match wins)."""
    s = X.ustrip(c)
    vals = df.where(X.not_blank(c, s)).select("row_num", s.alias("value"), X.phone_format(s).alias("format"))
    return _histogram(vals, ["format"]).select("format", "n_rows", "first_row", "example_1", "example_2")


def date_formats(df: DataFrame, columns=spec.DATE_SHAPE_COLUMNS) -> DataFrame:
    """P4 — date-shape histogram per date column (one pass, columns stacked)."""
    stacked = df.select(
        "row_num",
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("raw")) for c in columns])),
    )
    s = X.ustrip("raw")
    vals = stacked.where(X.not_blank("raw", s)).select(
        "row_num", "column", s.alias("value"), X.date_shape(s).alias("format")
    )
    return _histogram(vals, ["column", "format"]).select(
        "column", "format", "n_rows", "first_row", "example_1", "example_2"
    )


def key_duplicates(df: DataFrame, keys: list[str], order_col: str | None = "row_num") -> DataFrame:
    """P5 — every key value held by more than one row (raw values; nulls equal).

    Partial + final aggregate: a hot key costs one row per map task in the shuffle."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if order_col:
        aggs.append(F.min(order_col).alias("first_row"))
    return df.groupBy(*keys).agg(*aggs).where(F.col("n_rows") > 1)


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """P5 summary — is_unique, rows in duplicate groups, duplicate keys, distinct keys."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.sum("n").cast("bigint").alias("total_rows"),
    ).select("*", (F.col("duplicate_keys") == 0).alias("is_unique"))


# ---------------------------------------------------------------------------
# P6–P10 issues
# ---------------------------------------------------------------------------

def _issue(pred: Column, column: str, itype: str, value: Column, age: Column | None = None) -> Column:
    return F.when(pred, F.struct(
        F.lit(column).alias("column"), F.lit(itype).alias("type"),
        F.lit(spec.ISSUE_SEVERITY[itype]).alias("severity"), value.alias("value"),
        (age if age is not None else F.lit(None).cast("double")).alias("age_years"),
    ))


ISSUE_COLUMNS = ("date_of_birth", "created_date", "income", "account_status", "first_name", "last_name")


@X.memo_columns
def _issue_derive_exprs(token, as_of) -> tuple[dict, dict]:
    """Token-rendered stripped values, then the parses that use them (computed once
    per row, shared by every issue predicate)."""
    first = {f"__t_{c}": X.ustrip(X.null_token(c, token)) for c in ISSUE_COLUMNS}
    first["__s_account_status"] = X.ustrip("account_status")
    t = lambda c: F.col(f"__t_{c}")
    second = {
        "__n_income": X.parse_number(t("income"), t("income")),
        "__age_dob": X.age_years(X.parse_date(t("date_of_birth"), spec.PROFILE_DOB_FORMATS, t("date_of_birth")), as_of),
        "__d_created": X.parse_date(t("created_date"), spec.PROFILE_CREATED_FORMATS, t("created_date")),
    }
    return first, second


def issue_derive(df: DataFrame, as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN) -> DataFrame:
    first, second = _issue_derive_exprs(token, as_of)
    return df.withColumns(first).withColumns(second)


def invalid_value_issues(as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN) -> list[Column]:
    """P6a–f in report order (date literals, income, extreme age, future created)."""
    t = lambda c: F.col(f"__t_{c}")
    out = []
    for c in spec.DATE_SHAPE_COLUMNS:
        out.append(_issue(F.lower(t(c)) == spec.INVALID_DATE_LITERAL, c, "invalid_date_string", F.col(c)))
    inc = F.col("income")
    s = t("income")
    nb = s.isNotNull() & (s != "")
    num = F.col("__n_income")
    notnan = ~F.isnan(num)
    out += [
        _issue(nb & num.isNull(), "income", "non_numeric_income", inc),
        _issue(nb & notnan & (num < 0), "income", "negative_income", inc),
        _issue(nb & notnan & (num > spec.INCOME_LIMIT), "income", "income_exceeds_10M", inc),
    ]
    s = t("date_of_birth")
    ok = (s != "") & (F.lower(s) != spec.INVALID_DATE_LITERAL)
    age = F.col("__age_dob")
    out.append(_issue(ok & (age > spec.AGE_LIMIT_YEARS), "date_of_birth", "extreme_age", F.col("date_of_birth"),
                      F.round(age, 1)))
    s = t("created_date")
    ok = (s != "") & (F.lower(s) != spec.INVALID_DATE_LITERAL)
    out.append(_issue(ok & (F.col("__d_created") > F.lit(as_of)), "created_date", "future_created_date",
                      F.col("created_date")))
    return out


def status_issues(c: str = "account_status") -> list[Column]:
    """P7 — non-blank and outside the domain."""
    raw = F.col(c)
    s = F.col(f"__s_{c}")
    return [_issue(X.not_blank(raw, s) & ~F.lower(s).isin(*spec.VALID_STATUSES), c, "invalid_account_status", raw)]


def name_casing_issues(columns=("first_name", "last_name"), token=spec.NULL_TOKEN) -> list[Column]:
    """P8 — all-caps / all-lower names longer than one character."""
    out = []
    for c in columns:
        s = F.col(f"__t_{c}")
        long_enough = F.char_length(s) > 1
        up = X.is_all_upper(s) & long_enough
        low = X.is_all_lower(s) & long_enough
        out += [_issue(up, c, "name_all_caps", F.col(c)), _issue(~up & low, c, "name_all_lower", F.col(c))]
    return out


@X.memo_columns
def local_issue_array(as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN, kinds=("invalid", "status", "names")) -> Column:
    """Issue structs of one row (null where a check did not fire); needs the
    columns added by :func:`issue_derive`."""
    exprs: list[Column] = []
    if "invalid" in kinds:
        exprs += invalid_value_issues(as_of, token)
    if "status" in kinds:
        exprs += status_issues()
    if "names" in kinds:
        exprs += name_casing_issues(token=token)
    return F.array(*exprs)


@X.memo_columns
def local_issue_count(as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN) -> Column:
    n = F.lit(0)
    for e in invalid_value_issues(as_of, token) + status_issues() + name_casing_issues(token=token):
        n = n + F.when(e.isNotNull(), 1).otherwise(0)
    return n


def local_issues(df: DataFrame, as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN, kinds=("invalid", "status", "names")) -> DataFrame:
    d = issue_derive(df, as_of, token)
    return d.select("row_num", F.inline(local_issue_array(as_of, token, tuple(kinds)))).where(F.col("type").isNotNull())


def _nonstandard_phones(df: DataFrame, c: str = "phone") -> DataFrame:
    s = X.ustrip(c)
    return df.where(X.not_blank(c, s) & (X.phone_format(s) != spec.PHONE_STANDARD)).select(
        "row_num", s.alias("value")
    )


def phone_issues(df: DataFrame, c: str = "phone") -> DataFrame:
    """P9 — one issue per non-standard phone cell, reported at the first row that
    holds the same stripped value."""
    rows = _nonstandard_phones(df, c)
    firsts = rows.groupBy("value").agg(F.min("row_num").alias("first_row"))
    return rows.join(firsts, "value").select(
        F.col("first_row").alias("row_num"), F.lit(c).alias("column"),
        F.lit("non_standard_phone_format").alias("type"),
        F.lit(spec.ISSUE_SEVERITY["non_standard_phone_format"]).alias("severity"),
        "value", F.lit(None).cast("double").alias("age_years"),
    )


def issues(df: DataFrame, as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN) -> DataFrame:
    """P10 — every issue (local ∪ phone)."""
    return local_issues(df, as_of, token).unionByName(phone_issues(df))


def issues_by_severity(df: DataFrame, as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN) -> DataFrame:
    """P11 — counts per severity level, levels without issues kept (0).

    The per-severity counts (at most one row per level) are folded into a map on a
    one-row aggregate and read back for every level, so no join is needed."""
    return severity_counts(issues(df, as_of, token))


def severity_counts(iss: DataFrame) -> DataFrame:
    """P11 of an issue table."""
    counts = iss.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    m = counts.agg(F.map_from_entries(F.collect_list(F.struct("severity", "n"))).alias("_m"))
    levels = F.array(*[
        F.struct(F.lit(i + 1).cast("bigint").alias("level"), F.lit(s).alias("severity"),
                 F.lit(spec.SEVERITY_DESCRIPTIONS[s]).alias("description"))
        for i, s in enumerate(spec.SEVERITIES)
    ])
    return m.select("_m", F.inline(levels)).select(
        "level", "severity", "description",
        F.coalesce(F.element_at("_m", F.col("severity")), F.lit(0)).cast("bigint").alias("n_issues"),
    )


def row_health(df: DataFrame, as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN) -> DataFrame:
    """P12 — rows with ≥1 issue or ≥1 blank cell; clean = total − problem rows.

    Issue rows are the rows the issues name: for phone issues that is the first row
    holding the value.  One pass, one shuffle: rows are grouped by their
    non-standard phone value (NULL for every other row, which partial aggregation
    collapses to one row per task); each group counts its flagged rows and, via
    ``min_by``, whether its first row is flagged — an unflagged first row of a
    non-standard value adds one problem row."""
    cols = [c for c in df.columns if c != "row_num"]
    any_blank = F.lit(False)
    for c in cols:
        any_blank = any_blank | X.is_blank(c)
    flagged = (local_issue_count(as_of, token) > 0) | any_blank
    s = X.ustrip("phone")
    nonstd = X.not_blank("phone", s) & (X.phone_format(s) != spec.PHONE_STANDARD)
    base = issue_derive(df, as_of, token).select("row_num", F.when(nonstd, s).alias("_v"), flagged.alias("_flag"))
    groups = base.groupBy("_v").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_flag").alias("_nf"),
        F.min_by("_flag", "row_num").alias("_first_flag"))
    tot = groups.agg(
        F.sum("_n").cast("bigint").alias("total_rows"), F.sum("_nf").alias("_flagged"),
        F.count_if(F.col("_v").isNotNull() & ~F.col("_first_flag")).alias("_extra"),
    )
    problem = (F.col("_flagged") + F.col("_extra")).cast("bigint")
    clean = F.greatest(F.col("total_rows") - problem, F.lit(0)).cast("bigint")
    return tot.select(
        "total_rows", F.lit(len(cols)).cast("bigint").alias("total_columns"),
        problem.alias("problem_rows"), X.pct(problem, F.col("total_rows")).alias("problem_pct"),
        clean.alias("clean_rows"), X.pct(clean, F.col("total_rows")).alias("clean_pct"),
    )


def issue_totals(df: DataFrame, as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN) -> DataFrame:
    """P13 — ``issues_core`` (without phone formats, as the run report counts) and ``issues_all``."""
    iss = issues(df, as_of, token)
    return iss.agg(
        F.count_if(F.col("type") != "non_standard_phone_format").alias("issues_core"),
        F.count(F.lit(1)).alias("issues_all"),
    )


@dataclass
class ProfileResult:
    completeness: DataFrame
    type_conformance: DataFrame
    phone_formats: DataFrame
    date_formats: DataFrame
    key_duplicates: DataFrame
    issues: DataFrame
    severity: DataFrame
    row_health: DataFrame
    totals: DataFrame


def profile(df: DataFrame, as_of=spec.GOLDEN_AS_OF, token=spec.NULL_TOKEN, key: str = "customer_id") -> ProfileResult:
    """P14 — lazy bundle of every profiling output."""
    return ProfileResult(
        completeness=completeness(df),
        type_conformance=type_conformance(df),
        phone_formats=phone_formats(df),
        date_formats=date_formats(df),
        key_duplicates=key_duplicates(df, [key]),
        issues=issues(df, as_of, token),
        severity=issues_by_severity(df, as_of, token),
        row_health=row_health(df, as_of, token),
        totals=issue_totals(df, as_of, token),
    )
