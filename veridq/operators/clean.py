"""Cleaning with a full audit trail.

Physical shape of ``cleaned``: every row-local step (phone, dates, names, fills,
negative income, age remediation) is computed in a short chain of projections over
named intermediate columns — each stripped value, digit string and parsed date is
computed once and shared by the value, the step predicates and the audit entries —
followed by keep-first dedupe as ``row_number() over (partition by id order by
row_num) = 1``.  The planner inserts ``WindowGroupLimit`` before the shuffle, so
each map task forwards at most one row per id: one exchange in total, and a hot id
(or the null id) stays cheap.

The audit is built beside the projection as an ``array<struct>`` of changes and
exploded only for the audit sink.  Steps after dedupe (C8–C12) are logged only for
surviving rows; whether a row survives comes from a partial aggregate of first rows
per id joined back on the narrow (row_num, id, entries) projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veridq import spec
from veridq.functions import exprs as X

AUDIT_FIELDS = ["row_num", "step", "column", "action", "old_value", "new_value", "note"]
DATE_COLUMNS = ["date_of_birth", "created_date"]
NAME_COLUMNS = ["first_name", "last_name"]
STR = "string"


def _entry(pred: Column, step: str, column: str, action: str, old: Column, new: Column | None,
           note: Column | None = None) -> Column:
    return F.when(pred, F.struct(
        F.lit(step).alias("step"), F.lit(column).alias("column"), F.lit(action).alias("action"),
        old.cast(STR).alias("old_value"),
        (new if new is not None else F.lit(None)).cast(STR).alias("new_value"),
        (note if note is not None else F.lit(None)).cast(STR).alias("note"),
    ))


def _c(name: str) -> Column:
    return F.col(name)


def _blank(v: str, s: str) -> Column:
    return _c(v).isNull() | (_c(s) == "")


def _fmt(template: str, *values: Column) -> Column:
    """Fill the ``{}`` slots of a fixed message with column values."""
    parts = template.split("{}")
    out = [F.lit(parts[0])]
    for v, tail in zip(values, parts[1:]):
        out += [v, F.lit(tail)]
    return F.concat(*out)


def _safe_float(num: Column) -> Column:
    """``float(v.strip())`` with default 0 on failure (blank handled by callers)."""
    return F.coalesce(num, F.lit(0.0))


@dataclass
class Staged:
    df: DataFrame           # input columns + intermediate "__" columns
    values: dict            # output column -> final value column name
    pre: list               # audit entries of C1–C4 (all rows)
    post: list              # audit entries of C8–C12 (surviving rows)


def staged(df: DataFrame, as_of=spec.GOLDEN_AS_OF, policy: spec.CleanPolicy = spec.CleanPolicy()) -> Staged:
    """All row-local cleaning steps as a chain of projections (C1–C4, C8–C12)."""
    stages, values, pre, post = _staged_exprs(tuple(df.columns), as_of, policy)
    for st in stages:
        df = df.withColumns(st)
    return Staged(df, values, pre, post)


@X.memo_columns
def _staged_exprs(columns: tuple, as_of, policy: spec.CleanPolicy):
    stages = []
    cols = set(columns)
    values = {c: c for c in columns}
    pre: list[Column] = []
    post: list[Column] = []
    has = lambda c: c in cols
    dates = [c for c in DATE_COLUMNS if has(c)]
    names = [c for c in NAME_COLUMNS if has(c)]
    fills = {c: v for c, v in policy.fills.items() if has(c)}

    # 1: stripped values and digits (read the raw columns only)
    s1 = {f"__s_{c}": X.ustrip(c) for c in set(dates) | set(names) | set(fills) | ({"phone"} & cols)}
    if has("phone"):
        s1["__ph_d0"] = X.digits(_c("phone"))
    stages.append(s1)
    # 2: parses, titles, 11 -> 10 digits
    s2 = {}
    for c in dates:
        s2[f"__d_{c}"] = X.parse_date(c, policy.date_formats, _c(f"__s_{c}"))
    for c in names:
        s2[f"__t_{c}"] = X.title_case(_c(f"__s_{c}"))
    if has("phone"):
        d0 = _c("__ph_d0")
        s2["__ph_d"] = F.when((F.char_length(d0) == 11) & d0.startswith("1"), F.substring(d0, 2, 10)).otherwise(d0)
    stages.append(s2)
    # 3: step predicates and step values (C1–C3)
    s3 = {}
    if has("phone"):
        d = _c("__ph_d")
        blank = _blank("phone", "__s_phone")
        ten = F.char_length(d) == 10
        s3["__ph_fmt"] = F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4))
        s3["__ph_chg"] = ~blank & ten
        s3["__ph_flag"] = ~blank & ~ten
    for c in dates:
        s, dt = _c(f"__s_{c}"), _c(f"__d_{c}")
        blank = _blank(c, f"__s_{c}")
        literal = ~blank & (F.lower(s) == spec.INVALID_DATE_LITERAL)
        s3[f"__lit_{c}"] = literal
        s3[f"__bad_{c}"] = ~blank & ~literal & dt.isNull()
        s3[f"__iso_{c}"] = F.date_format(dt, "yyyy-MM-dd")
    for c in names:
        chg = ~_blank(c, f"__s_{c}") & (_c(f"__t_{c}") != _c(f"__s_{c}"))
        if policy.protect_placeholders:
            chg = chg & ~_c(f"__s_{c}").isin(*set(spec.FILL_VALUES.values()))
        s3[f"__chg_{c}"] = chg
    stages.append(s3)
    s4 = {}
    if has("phone"):
        chg = _c("__ph_chg") & (_c("__ph_fmt") != _c("phone"))
        s4["__v_phone"] = F.when(chg, _c("__ph_fmt")).otherwise(_c("phone"))
        note = _fmt(spec.NOTE_PHONE_FLAG, F.char_length("__ph_d").cast(STR))
        pre += [_entry(chg, "phone_format", "phone", "change", _c("phone"), _c("__ph_fmt")),
                _entry(_c("__ph_flag"), "phone_format", "phone", "flag", _c("phone"), None, note)]
        values["phone"] = "__v_phone"
    for c in dates:
        raw, s, iso = _c(c), _c(f"__s_{c}"), _c(f"__iso_{c}")
        lit_, bad = _c(f"__lit_{c}"), _c(f"__bad_{c}")
        chg = _c(f"__d_{c}").isNotNull() & (iso != s) & ~lit_
        s4[f"__v_{c}"] = F.when(lit_ | bad, F.lit(None).cast(STR)).when(chg, iso).otherwise(raw)
        pre += [
            _entry(chg, "date_format", c, "change", raw, iso),
            _entry(lit_, "date_format", c, "null", raw, None, F.lit(spec.NOTE_DATE_LITERAL)),
            _entry(bad, "date_format", c, "null", raw, None, _fmt(spec.NOTE_DATE_UNPARSEABLE, s)),
        ]
        values[c] = f"__v_{c}"
    for c in names:
        raw, s, t, chg = _c(c), _c(f"__s_{c}"), _c(f"__t_{c}"), _c(f"__chg_{c}")
        s4[f"__v3_{c}"] = F.when(chg, t).otherwise(raw)
        note = _fmt(spec.NOTE_NAME_CHANGE, s, t)
        pre.append(_entry(chg, "name_case", c, "change", raw, t, note))
        values[c] = f"__v3_{c}"
    stages.append(s4)
    # 4: fills (C4); names are filled after title-casing (which leaves blanks alone)
    s5 = {}
    for c, fill in fills.items():
        cur = _c(values[c])
        b = _blank(c, f"__s_{c}")  # the steps above never turn a non-blank value blank
        s5[f"__f_{c}"] = F.when(b, F.lit(fill)).otherwise(cur)
        pre.append(_entry(b, "fill_missing", c, "fill", cur, F.lit(fill)))
        values[c] = f"__f_{c}"
    stages.append(s5)
    # 5: post-dedupe steps (C8–C12) on the filled / normalised values, stripped once
    stages.append({f"__p_{c}": X.ustrip(values[c]) for c in ("income", "account_status", "created_date", "date_of_birth") if has(c)})
    s6 = {}
    if has("income"):
        s6["__n_income"] = X.parse_number(_c(values["income"]), _c("__p_income"))
    if has("created_date"):
        s6["__fut"] = X.is_future(values["created_date"], as_of, spec.FUTURE_FLAG_FORMATS, _c("__p_created_date"))
    if has("date_of_birth"):
        s6["__age"] = X.age_years(X.parse_date(values["date_of_birth"], spec.AGE_FLAG_FORMATS, _c("__p_date_of_birth")), as_of)
    stages.append(s6)
    s7 = {}
    if has("income"):
        v = _c(values["income"])
        n = _safe_float(_c("__n_income"))
        nb = X.not_blank(v, _c("__p_income"))
        neg = nb & ~F.isnan(n) & (n < 0)
        s7["__v_income"] = F.when(neg, F.lit("0")).otherwise(v)
        n2 = F.when(neg, F.lit(0.0)).otherwise(n)
        hi = nb & ~F.isnan(n2) & (n2 > spec.INCOME_LIMIT)
        post += [_entry(neg, "negative_income", "income", "change", v, F.lit("0")),
                 _entry(hi, "income_over_limit", "income", "flag", F.col("__v_income"), None,
                        F.lit(spec.NOTE_FLAG_UNCHANGED))]
        values["income"] = "__v_income"
    if has("account_status"):
        v = _c(values["account_status"])
        sv = _c("__p_account_status")
        bad = X.not_blank(v, sv) & ~F.lower(sv).isin(*spec.VALID_STATUSES)
        post.append(_entry(bad, "invalid_status", "account_status", "flag", v, None, F.lit(spec.NOTE_FLAG)))
    if has("created_date"):
        v = _c(values["created_date"])
        post.append(_entry(_c("__fut"), "future_created_date", "created_date", "flag", v, None,
                           F.lit(spec.NOTE_FLAG_UNCHANGED)))
    if has("date_of_birth"):
        v = _c(values["date_of_birth"])
        old = X.not_blank(v, _c("__p_date_of_birth")) & (_c("__age") > spec.AGE_LIMIT_YEARS)
        s7["__v5_dob"] = F.when(old, F.lit(None).cast(STR)).otherwise(v)
        note = _fmt(spec.NOTE_AGE, F.format_string("%.1f", _c("__age")))
        post.append(_entry(old, "extreme_age", "date_of_birth", "null", v, None, note))
        values["date_of_birth"] = "__v5_dob"
    stages.append(s7)
    if not policy.fix:  # review mode: keep every value, report every change as a flag
        values = {c: c for c in values}
    return [st for st in stages if st], values, pre, post


def _arr(entries: list[Column]) -> Column:
    """Entries of steps that did not fire are null."""
    return F.array(*entries)


def cleaned_rows(df: DataFrame, as_of=spec.GOLDEN_AS_OF, policy: spec.CleanPolicy = spec.CleanPolicy(),
                 key: str = "customer_id") -> DataFrame:
    """All row-local steps, before dedupe."""
    st = staged(df, as_of, policy)
    return st.df.select(*[F.col(st.values[c]).alias(c) for c in df.columns])


def keep_first(df: DataFrame, key: str = "customer_id", order: str = "row_num") -> DataFrame:
    """C6 — keep the lowest-``order`` row per raw key (nulls form one key)."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def clean(df: DataFrame, as_of=spec.GOLDEN_AS_OF, policy: spec.CleanPolicy = spec.CleanPolicy(),
          key: str = "customer_id") -> DataFrame:
    """C15 — the cleaned table (original ``row_num`` kept for lineage).

    No step changes the key, so keep-first commutes with the row-local steps: it goes first,
    and the costly steps run on the rows that stay, spread by its exchange."""
    return cleaned_rows(keep_first(df, key) if policy.fix else df, as_of, policy, key)


def audit(df: DataFrame, as_of=spec.GOLDEN_AS_OF, policy: spec.CleanPolicy = spec.CleanPolicy(),
          key: str = "customer_id") -> DataFrame:
    """C14 — one row per change / fill / null / drop / flag."""
    st = staged(df, as_of, policy)
    pre, post = st.pre, st.post
    if not policy.fix:
        pre = [_as_flag(e) for e in pre]
        post = [_as_flag(e) for e in post]
    firsts = df.groupBy(key).agg(F.min("row_num").alias("_first"))
    # one pass: the entries of a row travel with its key, without those that did not fire
    narrow = st.df.select("row_num", F.col(key).alias("_k"), F.array_compact(_arr(pre)).alias("_pre"), F.array_compact(_arr(post)).alias("_post"))
    j = narrow.join(firsts, narrow["_k"].eqNullSafe(firsts[key]))
    dropped = F.col("row_num") > F.col("_first")
    drop = F.struct(
        F.lit("dedupe").alias("step"), F.lit(key).alias("column"),
        F.lit("flag" if not policy.fix else "drop").alias("action"),
        F.col("_k").cast(STR).alias("old_value"), F.lit(None).cast(STR).alias("new_value"),
        F.concat(F.lit("duplicate of row "), F.col("_first").cast(STR)).alias("note"),
    )
    # outer: else the optimizer tests the array's size below, at the price of making it twice
    entries = F.inline_outer(F.concat("_pre", F.when(dropped, F.array(drop)).otherwise(F.col("_post"))))
    return j.select("row_num", entries).where(F.col("step").isNotNull())


def _as_flag(e: Column) -> Column:
    return e.withField("action", F.lit("flag"))


def audit_counts(aud: DataFrame) -> DataFrame:
    """Per-step counts (the cleaning log's figures)."""
    return aud.groupBy("step", "column", "action").agg(F.count(F.lit(1)).alias("n_rows"))


def summary(df: DataFrame, as_of=spec.GOLDEN_AS_OF, policy: spec.CleanPolicy = spec.CleanPolicy(),
            key: str = "customer_id") -> DataFrame:
    """Rows in / out / dropped and C5: dates of birth missing after date
    normalisation (counted before dedupe and before age remediation).

    Rows out = number of distinct keys, from a partial aggregate — no second pass
    over the cleaned table."""
    st = staged(df, as_of, policy)
    dob = F.col("__v_date_of_birth") if "__v_date_of_birth" in st.df.columns else F.col("date_of_birth")
    per_key = st.df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.count_if(X.is_blank(dob)).alias("_dob"))
    agg = per_key.agg(
        F.sum("_n").cast("bigint").alias("rows_in"),
        F.count(F.lit(1)).alias("_keys"),
        F.sum("_dob").cast("bigint").alias("dob_missing"),
    )
    rows_out = F.col("_keys") if policy.fix else F.col("rows_in")
    return agg.select(
        "rows_in", rows_out.cast("bigint").alias("rows_out"), (F.col("rows_in") - rows_out).cast("bigint").alias("rows_dropped"),
        "dob_missing", F.lit(len([c for c in df.columns if c != "row_num"])).cast("bigint").alias("columns"),
    )


def fix_negative_numeric(df: DataFrame, id_col: str, c: str) -> DataFrame:
    """C8 on a numeric column (e.g. ``customer.c_acctbal``): the changed rows."""
    v = F.col(c)
    return df.where(~F.isnan(v) & (v < 0)).select(
        id_col, v.alias("old_value"), F.lit(0.0).alias("new_value")
    )


def before_after(df: DataFrame, as_of=spec.GOLDEN_AS_OF, policy: spec.CleanPolicy = spec.CleanPolicy()) -> DataFrame:
    """C13 — validation failures per column on the raw and on the cleaned table."""
    from veridq.operators import validate as V

    raw_f = V.failures(df, as_of).select(F.lit("before").alias("phase"), "column")
    cln_f = V.failures(clean(df, as_of, policy), as_of).select(F.lit("after").alias("phase"), "column")
    return raw_f.unionByName(cln_f).groupBy("phase", "column").agg(F.count(F.lit(1)).alias("n_failures"))


def before_after_totals(df: DataFrame, as_of=spec.GOLDEN_AS_OF, policy: spec.CleanPolicy = spec.CleanPolicy()) -> DataFrame:
    ba = before_after(df, as_of, policy)
    return ba.agg(
        F.coalesce(F.sum(F.when(F.col("phase") == "before", F.col("n_failures"))), F.lit(0)).cast("bigint").alias("before"),
        F.coalesce(F.sum(F.when(F.col("phase") == "after", F.col("n_failures"))), F.lit(0)).cast("bigint").alias("after"),
    ).select("before", "after", (F.col("before") - F.col("after")).alias("improvement"))


@dataclass
class CleanResult:
    cleaned: DataFrame
    audit: DataFrame
    audit_counts: DataFrame
    before_after: DataFrame
    summary: DataFrame


def run_clean(df: DataFrame, as_of=spec.GOLDEN_AS_OF, policy: spec.CleanPolicy = spec.CleanPolicy()) -> CleanResult:
    aud = audit(df, as_of, policy)
    return CleanResult(clean(df, as_of, policy), aud, audit_counts(aud), before_after(df, as_of, policy),
                       summary(df, as_of, policy))


def dense_renumber(df: DataFrame, order_col: str = "row_num", first: int = 2, width: int = 1 << 20,
                   out_col: str = "clean_row_num") -> DataFrame:
    """C7 — consecutive numbers in ``order_col`` order after rows were dropped
    (``reset_index`` parity), without a global sort.

    Rows are bucketed by ``floor(order_col / width)``; with unique integer keys a
    bucket holds at most ``width`` rows, so the per-bucket ``row_number`` window is
    bounded (no skew).  Bucket offsets are running sums over the per-bucket counts
    — one row per bucket, i.e. input rows / ``width`` — joined back by bucket."""
    b = F.floor(F.col(order_col) / F.lit(width)).cast("bigint")
    tagged = df.withColumn("_b", b)
    counts = tagged.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    w_all = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(w_all), F.lit(0)).alias("_off"))
    ranked = tagged.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(order_col)))
    n = (F.col("_off") + F.col("_r") - 1 + F.lit(first)).cast("bigint")
    return ranked.join(offsets, "_b").select(*df.columns, n.alias(out_col))
