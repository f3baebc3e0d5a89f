"""DuckDB oracle SQL for every registered query (driver correctness gate).

Each entry is an independent SQL formulation over the pre-registered driver views.
"""

from __future__ import annotations

from veridq import spec
from veridq.plans.sqlfrag import (
    AS_OF, age, blank, digits, messy_cte, nblank, pdate, pnum, q, rx, strip, title,
)

M = messy_cte()


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# Validation
# ---------------------------------------------------------------------------

def _id_valid(v="customer_id") -> str:
    n = pnum(v)
    return f"({nblank(v)} AND {n} IS NOT NULL AND isfinite({n}) AND {n} >= 1)"


def _rules() -> list[tuple[str, str, str, str]]:
    """(column, rule_id, predicate, message SQL) for the row-local rules."""
    r = []
    c = "customer_id"
    n = pnum(c)
    numeric = f"({n} IS NOT NULL AND isfinite({n}))"
    r += [(c, "missing", blank(c), q(spec.MSG_ID_MISSING)),
          (c, "not_numeric", f"{nblank(c)} AND NOT {numeric}", q(spec.MSG_ID_NOT_NUMERIC)),
          (c, "not_positive", f"{nblank(c)} AND {numeric} AND {n} < 1", q(spec.MSG_ID_NOT_POSITIVE))]
    for c in ("first_name", "last_name"):
        r += [(c, "empty", blank(c), q(spec.MSG_NON_EMPTY)),
              (c, "length", f"{nblank(c)} AND NOT length({strip(c)}) BETWEEN 2 AND 50", q(spec.MSG_NAME_LENGTH)),
              (c, "charset", f"{nblank(c)} AND NOT {rx(strip(c), spec.NAME_FULL)}", q(spec.MSG_NAME_CHARSET))]
    c = "email"
    r += [(c, "empty", blank(c), q(spec.MSG_NON_EMPTY)),
          (c, "format", f"{nblank(c)} AND NOT {rx(strip(c), spec.EMAIL_FULL)}", q(spec.MSG_EMAIL_FORMAT))]
    c = "phone"
    nd = f"length({digits(c)})"
    pre, post = spec.MSG_PHONE_DIGITS.split("{}")
    r += [(c, "empty", blank(c), q(spec.MSG_NON_EMPTY)),
          (c, "digits", f"{nblank(c)} AND NOT {nd} BETWEEN 10 AND 15", f"{q(pre)} || CAST({nd} AS VARCHAR) || {q(post)}")]
    for c in ("date_of_birth", "created_date"):
        lit = f"{nblank(c)} AND lower({strip(c)}) = 'invalid_date'"
        ok = f"{nblank(c)} AND lower({strip(c)}) <> 'invalid_date'"
        d = pdate(c, spec.VALIDATE_DATE_FORMATS)
        r += [(c, "literal", lit, q(spec.MSG_DATE_LITERAL)),
              (c, "unparseable", f"{ok} AND {d} IS NULL", q(spec.MSG_DATE_UNPARSEABLE)),
              (c, "future", f"{ok} AND {d} > {AS_OF}", q(spec.MSG_DATE_FUTURE))]
        if c == "date_of_birth":
            pre, post = spec.MSG_DOB_AGE.split("{}")
            r += [(c, "age_over_150", f"{ok} AND {age(d)} > 150", f"{q(pre)} || printf('%.1f', {age(d)}) || {q(post)}"),
                  (c, "born_in_future", f"{ok} AND {age(d)} < 0", q(spec.MSG_DOB_FUTURE))]
    c = "address"
    r += [(c, "empty", blank(c), q(spec.MSG_NON_EMPTY))]
    c = "income"
    n = pnum(c)
    r += [(c, "empty", blank(c), q(spec.MSG_INCOME_EMPTY)),
          (c, "not_numeric", f"{nblank(c)} AND {n} IS NULL", q(spec.MSG_INCOME_NOT_NUMERIC)),
          (c, "negative", f"{nblank(c)} AND NOT isnan({n}) AND {n} < 0", q(spec.MSG_INCOME_NEGATIVE)),
          (c, "over_limit", f"{nblank(c)} AND NOT isnan({n}) AND {n} > 10000000", q(spec.MSG_INCOME_OVER))]
    c = "account_status"
    pre, post = spec.MSG_STATUS_DOMAIN.split("{}")
    dom = ", ".join(q(s) for s in spec.VALID_STATUSES)
    r += [(c, "missing", blank(c), q(spec.MSG_STATUS_MISSING)),
          (c, "not_in_domain", f"{nblank(c)} AND lower({strip(c)}) NOT IN ({dom})", f"{q(pre)} || {c} || {q(post)}")]
    return r


def failures_sql(src: str = "messy", columns=None, rules=None) -> str:
    parts = []
    for c, rid, pred, msg in rules or _rules():
        if columns and c not in columns:
            continue
        parts.append(
            f"SELECT row_num, '{c}' AS \"column\", '{c}.{rid}' AS rule_id, {msg} AS rule, {c} AS value "
            f"FROM {src} WHERE {pred}"
        )
    if not columns or "customer_id" in columns:
        pre, post = spec.MSG_ID_DUPLICATE.split("{}")
        parts.append(
            f"SELECT row_num, 'customer_id', 'customer_id.duplicate', {q(pre)} || CAST(f AS VARCHAR) || {q(post)}, value "
            f"FROM (SELECT row_num, customer_id AS value, min(row_num) OVER (PARTITION BY {strip('customer_id')}) AS f "
            f"FROM {src} WHERE {_id_valid()}) WHERE row_num > f"
        )
    return "\nUNION ALL\n".join(parts)


def _row_failures_sql(src="messy") -> str:
    return f"""fails AS ({failures_sql(src)}),
per_row AS (SELECT row_num, count(*) AS n FROM fails GROUP BY row_num),
rs AS (SELECT m.row_num, CAST(coalesce(p.n, 0) AS BIGINT) AS n_failures,
              CASE WHEN coalesce(p.n, 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
       FROM {src} m LEFT JOIN per_row p USING (row_num))"""


VALIDATE_GROUPS = {
    "validate_customer_id": ["customer_id"],
    "validate_names": ["first_name", "last_name"],
    "validate_email": ["email"],
    "validate_phone": ["phone"],
    "validate_dates": ["date_of_birth", "created_date"],
    "validate_address": ["address"],
    "validate_income": ["income"],
    "validate_status": ["account_status"],
}


def validation_sql() -> dict[str, str]:
    out = {name: _with(M) + failures_sql("messy", cols) for name, cols in VALIDATE_GROUPS.items()}
    out["validate_all_failures"] = _with(M) + failures_sql("messy")
    cols = list(spec.RULE_DESCRIPTIONS)
    dim = " UNION ALL ".join(
        f"SELECT {i + 1} AS position, {q(c)} AS \"column\", {q(spec.RULE_DESCRIPTIONS[c])} AS rules_checked"
        for i, c in enumerate(cols)
    )
    out["validate_column_summary"] = _with(M, f"fails AS ({failures_sql('messy')})") + f"""
SELECT CAST(d.position AS BIGINT) AS position, d."column", d.rules_checked,
       CAST((SELECT count(*) FROM messy) - coalesce(f.n, 0) AS BIGINT) AS pass_count,
       CAST(coalesce(f.n, 0) AS BIGINT) AS fail_count,
       CAST(coalesce(f.r, 0) AS BIGINT) AS failed_rows
FROM ({dim}) d LEFT JOIN (SELECT "column", count(*) AS n, count(DISTINCT row_num) AS r FROM fails GROUP BY 1) f
  ON d."column" = f."column"
"""
    out["validate_row_status"] = _with(M, _row_failures_sql()) + "SELECT row_num, n_failures, status FROM rs"
    out["validate_overall"] = _with(M, _row_failures_sql()) + """
SELECT count(*) AS total_rows, CAST(sum(n_failures) AS BIGINT) AS total_failures,
       count_if(n_failures > 0) AS failed_rows, count_if(n_failures = 0) AS passed_rows FROM rs"""
    return out


def _bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` returns HUGEINT; Spark's returns BIGINT."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(tok)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        inner = sql[j + len(tok):k - 1]
        out.append(f"CAST(count_if({_bigint_counts(inner)}) AS BIGINT)")
        i = k


def all_sql() -> dict[str, str]:
    return {k: _bigint_counts(v) for k, v in _all_sql().items()}


def _all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(validation_sql())
    out.update(profile_sql())
    out.update(pii_sql())
    out.update(clean_mask_sql())
    out.update(extension_sql())
    out.update(streaming_sql())
    out.update(pipeline_sql(out))
    return out


# ---------------------------------------------------------------------------
# Profiling
# ---------------------------------------------------------------------------

CUST = list(spec.LOGICAL_TYPES)


def _phone_fmt_sql(s: str) -> str:
    parts = " ".join(f"WHEN {rx(s, p)} THEN {q(n)}" for n, p in spec.PHONE_FORMATS)
    return f"CASE {parts} ELSE {q(spec.PHONE_OTHER)} END"


def _date_shape_sql(s: str) -> str:
    parts = " ".join(f"WHEN regexp_matches({s}, {q(p)}, 'i') THEN {q(n)}" for n, p in spec.DATE_SHAPES)
    return f"CASE {parts} ELSE {q(spec.DATE_OTHER)} END"


def _tok(c: str) -> str:
    return strip(f"coalesce({c}, {q(spec.NULL_TOKEN)})")


def _issues_local_sql(src="messy") -> str:
    parts = []

    def add(pred, col, typ, value=None, agev="CAST(NULL AS DOUBLE)"):
        sev = spec.ISSUE_SEVERITY[typ]
        parts.append(
            f"SELECT row_num, '{col}' AS \"column\", '{typ}' AS type, '{sev}' AS severity, "
            f"{value or col} AS value, {agev} AS age_years FROM {src} WHERE {pred}"
        )

    for c in spec.DATE_SHAPE_COLUMNS:
        add(f"lower({_tok(c)}) = 'invalid_date'", c, "invalid_date_string")
    s = _tok("income")
    n = f"try_cast({s} AS DOUBLE)"
    add(f"{s} <> '' AND {n} IS NULL", "income", "non_numeric_income")
    add(f"{s} <> '' AND NOT isnan({n}) AND {n} < 0", "income", "negative_income")
    add(f"{s} <> '' AND NOT isnan({n}) AND {n} > 10000000", "income", "income_exceeds_10M")
    s = _tok("date_of_birth")
    d = pdate(f"coalesce(date_of_birth, {q(spec.NULL_TOKEN)})", spec.PROFILE_DOB_FORMATS)
    add(f"{s} <> '' AND lower({s}) <> 'invalid_date' AND {age(d)} > 150", "date_of_birth", "extreme_age",
        agev=f"round({age(d)}, 1)")
    s = _tok("created_date")
    d = pdate(f"coalesce(created_date, {q(spec.NULL_TOKEN)})", spec.PROFILE_CREATED_FORMATS)
    add(f"{s} <> '' AND lower({s}) <> 'invalid_date' AND {d} > {AS_OF}", "created_date", "future_created_date")
    dom = ", ".join(q(x) for x in spec.VALID_STATUSES)
    add(f"{nblank('account_status')} AND lower({strip('account_status')}) NOT IN ({dom})", "account_status",
        "invalid_account_status")
    for c in ("first_name", "last_name"):
        s = _tok(c)
        up = f"(regexp_matches({s}, '[A-Z]') AND NOT regexp_matches({s}, '[a-z]') AND length({s}) > 1)"
        low = f"(regexp_matches({s}, '[a-z]') AND NOT regexp_matches({s}, '[A-Z]') AND length({s}) > 1)"
        add(up, c, "name_all_caps")
        add(f"NOT {up} AND {low}", c, "name_all_lower")
    return "\nUNION ALL\n".join(parts)


def _phone_issues_sql(src="messy") -> str:
    s = strip("phone")
    return f"""SELECT min(row_num) OVER (PARTITION BY v) AS row_num, 'phone' AS "column",
  'non_standard_phone_format' AS type, 'Medium' AS severity, v AS value, CAST(NULL AS DOUBLE) AS age_years
FROM (SELECT row_num, {s} AS v FROM {src} WHERE {nblank('phone')}) WHERE {_phone_fmt_sql('v')} <> 'XXX-XXX-XXXX'"""


def _hist_sql(vals: str, group: list[str]) -> str:
    g = ", ".join(group)
    return f"""SELECT {g}, count(*) AS n_rows, min(row_num) AS first_row,
  max(CASE WHEN rn = 1 THEN value END) AS example_1, max(CASE WHEN rn = 2 THEN value END) AS example_2
FROM (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY row_num) AS rn FROM ({vals})) GROUP BY {g}"""


def profile_sql() -> dict[str, str]:
    out = {}

    def compl(src_cols, src):
        agg = ", ".join(f"count_if({blank(f'CAST({c} AS VARCHAR)')}) AS m{i}" for i, c in enumerate(src_cols))
        rows = " UNION ALL ".join(
            f"SELECT CAST({i + 1} AS BIGINT) AS position, {q(c)} AS \"column\", total, m{i} AS missing FROM a"
            for i, c in enumerate(src_cols)
        )
        return (f"WITH {M if src == 'messy' else 'x AS (SELECT 1)'}, a AS (SELECT count(*) AS total, {agg} FROM {src}) "
                f"SELECT position, \"column\", total, missing, round(100.0 * (total - missing) / nullif(total, 0), 1) "
                f"AS complete_pct FROM ({rows})")

    out["profile_completeness"] = compl(CUST, "messy")
    ocols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    out["profile_completeness_orders"] = compl(ocols, "orders")

    aggs, rows = [], []
    for i, c in enumerate(CUST):
        lt = spec.LOGICAL_TYPES[c]
        nb = nblank(c)
        if lt == "INT":
            n = pnum(c)
            bad = f"NOT coalesce({n} IS NOT NULL AND isfinite({n}) AND {n} = floor({n}), false)"
        elif lt == "NUMERIC":
            bad = f"{pnum(c)} IS NULL"
        elif lt == "DATE":
            bad = f"{pdate(c, spec.VALIDATE_DATE_FORMATS)} IS NULL"
        else:
            bad = "false"
        aggs += [f"count_if({nb}) AS n{i}", f"count_if({nb} AND {bad}) AS u{i}"]
        st = "OK" if lt == "STRING" else "FAIL"
        rows.append(f"SELECT CAST({i + 1} AS BIGINT) AS position, {q(c)} AS \"column\", 'STRING' AS detected, "
                    f"{q(lt)} AS expected, {q(st)} AS status, n{i} AS non_blank, u{i} AS unparseable FROM a")
    out["profile_type_conformance"] = _with(M, f"a AS (SELECT {', '.join(aggs)} FROM messy)") + " UNION ALL ".join(rows)

    s = strip("phone")
    vals = f"SELECT row_num, {s} AS value, {_phone_fmt_sql(s)} AS format FROM messy WHERE {nblank('phone')}"
    out["profile_phone_formats"] = _with(M) + _hist_sql(vals, ["format"])
    stacked = " UNION ALL ".join(
        f"SELECT row_num, {q(c)} AS \"column\", {strip(c)} AS value, {_date_shape_sql(strip(c))} AS format "
        f"FROM messy WHERE {nblank(c)}" for c in spec.DATE_SHAPE_COLUMNS
    )
    out["profile_date_formats"] = _with(M) + _hist_sql(stacked, ['"column"', "format"])
    out["profile_key_uniqueness"] = _with(M) + (
        "SELECT customer_id, count(*) AS n_rows, min(row_num) AS first_row FROM messy "
        "GROUP BY customer_id HAVING count(*) > 1")
    out["profile_key_uniqueness_lineitem"] = (
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
    out["profile_key_summary"] = _with(M) + """SELECT count(*) AS distinct_keys, count_if(n > 1) AS duplicate_keys,
  CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows, CAST(sum(n) AS BIGINT) AS total_rows,
  count_if(n > 1) = 0 AS is_unique FROM (SELECT customer_id, count(*) AS n FROM messy GROUP BY customer_id)"""

    local = _issues_local_sql()
    phone = _phone_issues_sql()
    out["issues_invalid_values"] = _with(M) + "SELECT * FROM (" + local + ") WHERE type NOT IN ('invalid_account_status', 'name_all_caps', 'name_all_lower')"
    out["issues_status"] = _with(M) + "SELECT * FROM (" + local + ") WHERE type = 'invalid_account_status'"
    out["issues_name_casing"] = _with(M) + "SELECT * FROM (" + local + ") WHERE type IN ('name_all_caps', 'name_all_lower')"
    out["issues_phone_format"] = _with(M) + phone
    all_iss = f"iss AS ({local}\nUNION ALL\n{phone})"
    out["issues_all"] = _with(M, all_iss) + "SELECT * FROM iss"
    lv = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS BIGINT) AS level, {q(s_)} AS severity, {q(spec.SEVERITY_DESCRIPTIONS[s_])} AS description"
        for i, s_ in enumerate(spec.SEVERITIES))
    out["issues_by_severity"] = _with(M, all_iss) + f"""SELECT l.level, l.severity, l.description,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_issues FROM ({lv}) l
  LEFT JOIN (SELECT severity, count(*) AS n FROM iss GROUP BY severity) c ON l.severity = c.severity"""
    out["issues_totals"] = _with(M, all_iss) + """SELECT count_if(type <> 'non_standard_phone_format') AS issues_core,
  count(*) AS issues_all FROM iss"""
    anyblank = " OR ".join(blank(c) for c in CUST)
    out["profile_row_health"] = _with(M, all_iss) + f"""
, probs AS (SELECT DISTINCT row_num FROM (SELECT row_num FROM iss UNION ALL SELECT row_num FROM messy WHERE {anyblank}))
, t AS (SELECT (SELECT count(*) FROM messy) AS total_rows, (SELECT count(*) FROM probs) AS problem_rows)
SELECT total_rows, CAST(10 AS BIGINT) AS total_columns, problem_rows,
  round(100.0 * problem_rows / nullif(total_rows, 0), 1) AS problem_pct,
  greatest(total_rows - problem_rows, 0) AS clean_rows,
  round(100.0 * greatest(total_rows - problem_rows, 0) / nullif(total_rows, 0), 1) AS clean_pct FROM t"""
    return out


# ---------------------------------------------------------------------------
# PII
# ---------------------------------------------------------------------------

def _pii_flags() -> dict[str, str]:
    def search(c, p):
        s = _tok(c)
        return f"({s} <> '' AND regexp_matches({s}, {q(p)}))"

    return {
        "name": f"({nblank('first_name')} OR {nblank('last_name')})",
        "email": search("email", spec.EMAIL_SEARCH),
        "phone": search("phone", spec.PHONE_SEARCH),
        "address": nblank("address"),
        "date_of_birth": nblank("date_of_birth"),
        "income": nblank("income"),
    }


_PII_LABELS = {"name": spec.PII_LABEL_NAME, "email": spec.PII_LABEL_EMAIL, "phone": spec.PII_LABEL_PHONE,
               "address": spec.PII_LABEL_ADDRESS, "date_of_birth": spec.PII_LABEL_DOB, "income": spec.PII_LABEL_INCOME}


TEXT_PATTERNS = {"email": spec.EMAIL_SEARCH, "phone": spec.PHONE_SEARCH, "date": spec.DATE_SEARCH}


def _text_hits_sql(table: str, id_expr: str, id_name: str, cols: list[str]) -> str:
    pats = {"email": spec.EMAIL_SEARCH, "phone": spec.PHONE_SEARCH, "date": spec.DATE_SEARCH}
    parts = []
    for c in cols:
        for k, p in pats.items():
            parts.append(f"SELECT {id_expr} AS {id_name}, {q(c)} AS \"column\", {q(k)} AS kind, "
                         f"CAST(len(regexp_extract_all(CAST({c} AS VARCHAR), {q(p)})) AS BIGINT) AS n_matches FROM {table}")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n_matches > 0"


def pii_sql() -> dict[str, str]:
    out = {}
    fl = _pii_flags()
    aggs = ", ".join(f"count_if({nblank(f'CAST({c} AS VARCHAR)')}) AS n{i}" for i, c in enumerate(CUST))
    rows = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS BIGINT) AS position, {q(c)} AS \"column\", "
        f"{q(spec.PII_REGISTRY.get(c, spec.NON_PII)[0])} AS category, {q(spec.PII_REGISTRY.get(c, spec.NON_PII)[1])} AS risk, "
        f"n{i} AS non_blank FROM a" for i, c in enumerate(CUST))
    out["pii_column_classification"] = _with(M, f"a AS (SELECT {aggs} FROM messy)") + rows
    order = ["email", "phone", "address", "date_of_birth", "name", "income"]
    aggs = ", ".join(f"count_if({fl[k]}) AS n_{k}" for k in order)
    rows = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS BIGINT) AS position, {q(k)} AS detector, n_{k} AS n_rows, total FROM a"
        for i, k in enumerate(order))
    out["pii_coverage"] = _with(M, f"a AS (SELECT count(*) AS total, {aggs} FROM messy)") + (
        f"SELECT position, detector, n_rows, total, round(100.0 * n_rows / nullif(total, 0), 1) AS pct FROM ({rows})")
    labels = ", ".join(f"CASE WHEN {fl[k]} THEN {q(v)} END" for k, v in _PII_LABELS.items())
    out["pii_row_inventory"] = _with(M) + f"""SELECT row_num, {_tok('customer_id')} AS customer_id,
  CASE WHEN len(l) > 0 THEN array_to_string(l, ', ') ELSE {q(spec.NO_PII)} END AS pii_types,
  CAST(len(l) AS BIGINT) AS n_types
FROM (SELECT row_num, customer_id, list_filter([{labels}], lambda x: x IS NOT NULL) AS l FROM messy)"""
    anyp = " OR ".join(fl.values())
    out["pii_at_risk"] = _with(M) + f"SELECT count(*) AS total_rows, count(*) AS at_risk_rows, count_if({anyp}) AS rows_with_any_pii FROM messy"
    out["pii_text_scan_documents"] = _text_hits_sql("documents", "doc_id", "doc_id", ["text"])
    strings = {"region": "r_name", "nation": "n_name", "customer": "c_name c_mktsegment", "supplier": "s_name", "part": "p_name p_brand p_type",
               "orders": "o_orderstatus o_orderpriority", "lineitem": "l_returnflag l_linestatus", "events": "event_type props",
               "documents": "text lang source", "pages": "url html", "benchmark": "text", "conversations": "role text"}
    out["pii_every_cell"] = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS path, '{k}' AS kind, count({c}) AS n_values, count_if(len(regexp_extract_all({c}, {q(p)})) > 0) AS n_hits, "
        f"CAST(coalesce(sum(len(regexp_extract_all({c}, {q(p)}))), 0) AS BIGINT) AS n_matches FROM {t}"
        for t, cs in strings.items() for c in cs.split() for k, p in TEXT_PATTERNS.items())
    out["pii_text_scan_pages"] = _text_hits_sql("pages", "page_id", "page_id", ["url", "html"])
    out["pii_text_scan_conversations"] = _text_hits_sql(
        "conversations", "CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)", "msg_id", ["text"])
    pats = {"email": spec.EMAIL_SEARCH, "phone": spec.PHONE_SEARCH, "date": spec.DATE_SEARCH}
    ms = " UNION ALL ".join(
        f"SELECT doc_id, {q(k)} AS kind, unnest(regexp_extract_all(text, {q(p)})) AS match FROM documents"
        for k, p in pats.items())
    out["pii_text_matches_documents"] = f"""SELECT doc_id, 'text' AS "column", kind, match,
  CASE WHEN kind = 'phone' AND NOT regexp_matches(match, '[-.\\s()]') THEN 'low' ELSE 'high' END AS confidence
FROM ({ms})"""
    out["pii_text_summary_documents"] = (
        "SELECT \"column\", kind, count(*) AS rows_with_hits, CAST(sum(n_matches) AS BIGINT) AS n_matches FROM ("
        + _text_hits_sql("documents", "doc_id", "doc_id", ["text"]) + ") GROUP BY 1, 2")
    return out


# ---------------------------------------------------------------------------
# Cleaning and masking
# ---------------------------------------------------------------------------

def _clean_ctes(src="messy") -> str:
    """s1: step values and flags; cl: cleaned rows with keep-first rank."""
    ph_d0 = digits(strip("phone"))
    ph_d = f"(CASE WHEN length({ph_d0}) = 11 AND starts_with({ph_d0}, '1') THEN substr({ph_d0}, 2) ELSE {ph_d0} END)"
    ph_fmt = f"(substr({ph_d}, 1, 3) || '-' || substr({ph_d}, 4, 3) || '-' || substr({ph_d}, 7, 4))"
    sel = [
        "*",
        f"{ph_d} AS ph_d",
        f"{ph_fmt} AS ph_fmt",
        f"({nblank('phone')} AND length({ph_d}) = 10 AND {ph_fmt} <> phone) AS ph_chg",
        f"({nblank('phone')} AND length({ph_d}) <> 10) AS ph_flag",
    ]
    for c in ("date_of_birth", "created_date"):
        p = pdate(c, spec.CLEAN_DATE_FORMATS)
        iso = f"strftime({p}, '%Y-%m-%d')"
        lit = f"({nblank(c)} AND lower({strip(c)}) = 'invalid_date')"
        sel += [
            f"{lit} AS {c}_lit",
            f"{iso} AS {c}_iso",
            f"({nblank(c)} AND NOT {lit} AND {p} IS NULL) AS {c}_bad",
            f"({nblank(c)} AND NOT {lit} AND {p} IS NOT NULL AND {iso} <> {strip(c)}) AS {c}_chg",
        ]
    for c in ("first_name", "last_name"):
        sel += [f"{title(strip(c))} AS {c}_t", f"({nblank(c)} AND {title(strip(c))} <> {strip(c)}) AS {c}_chg"]
    s1 = f"s1 AS (SELECT {', '.join(sel)} FROM {src})"
    sel2 = ["*", "CASE WHEN ph_chg THEN ph_fmt ELSE phone END AS phone_c"]
    for c in ("date_of_birth", "created_date"):
        sel2.append(f"CASE WHEN {c}_lit OR {c}_bad THEN NULL WHEN {c}_chg THEN {c}_iso ELSE {c} END AS {c}_c")
    for c in ("first_name", "last_name"):
        sel2.append(f"CASE WHEN {c}_chg THEN {c}_t ELSE {c} END AS {c}_c3")
    s2 = f"s2 AS (SELECT {', '.join(sel2)} FROM s1)"
    fills = spec.FILL_VALUES
    sel3 = ["*"]
    for c in ("first_name", "last_name"):
        sel3.append(f"CASE WHEN {blank(c + '_c3')} THEN {q(fills[c])} ELSE {c}_c3 END AS {c}_c")
    for c in ("address", "account_status", "income"):
        sel3.append(f"CASE WHEN {blank(c)} THEN {q(fills[c])} ELSE {c} END AS {c}_f")
    s3 = f"s3 AS (SELECT {', '.join(sel3)} FROM s2)"
    inc_n = f"coalesce({pnum('income_f')}, 0.0)"
    dob_p = pdate("date_of_birth_c", spec.AGE_FLAG_FORMATS)
    sel4 = [
        "*",
        f"({nblank('income_f')} AND NOT isnan({inc_n}) AND {inc_n} < 0) AS inc_neg",
        f"({nblank('date_of_birth_c')} AND {age(dob_p)} > 150) AS dob_old",
        f"printf('%.1f', {age(dob_p)}) AS dob_age",
    ]
    s4 = f"s4 AS (SELECT {', '.join(sel4)} FROM s3)"
    inc_c = "CASE WHEN inc_neg THEN '0' ELSE income_f END"
    inc_cn = f"coalesce({pnum(inc_c)}, 0.0)"
    dom = ", ".join(q(x) for x in spec.VALID_STATUSES)
    sel5 = [
        "*",
        f"{inc_c} AS income_c",
        "CASE WHEN dob_old THEN NULL ELSE date_of_birth_c END AS date_of_birth_c5",
        f"({nblank(inc_c)} AND NOT isnan({inc_cn}) AND {inc_cn} > 10000000) AS inc_hi",
        f"({nblank('account_status_f')} AND lower({strip('account_status_f')}) NOT IN ({dom})) AS st_bad",
        f"coalesce({pdate('created_date_c', spec.FUTURE_FLAG_FORMATS)} > {AS_OF}, false) AS cr_fut",
        "row_number() OVER (PARTITION BY customer_id ORDER BY row_num) AS rn",
        "min(row_num) OVER (PARTITION BY customer_id) AS first_row",
    ]
    s5 = f"s5 AS (SELECT {', '.join(sel5)} FROM s4)"
    cl = """cl AS (SELECT row_num, customer_id, first_name_c AS first_name, last_name_c AS last_name, email,
  phone_c AS phone, date_of_birth_c5 AS date_of_birth, address_f AS address, income_c AS income,
  account_status_f AS account_status, created_date_c AS created_date FROM s5 WHERE rn = 1)"""
    return ",\n".join([s1, s2, s3, s4, s5, cl])


def _sqlfmt(template: str, *values: str) -> str:
    parts = template.split("{}")
    out = [q(parts[0])]
    for v, tail in zip(values, parts[1:]):
        out += [v, q(tail)]
    return "(" + " || ".join(out) + ")"


def _audit_sql() -> str:
    e = []

    def add(where, step, col, action, old, new="NULL", note="NULL", src="s5"):
        e.append(f"SELECT row_num, {q(step)} AS step, {q(col)} AS \"column\", {q(action)} AS action, "
                 f"CAST({old} AS VARCHAR) AS old_value, CAST({new} AS VARCHAR) AS new_value, "
                 f"CAST({note} AS VARCHAR) AS note FROM {src} WHERE {where}")

    add("ph_chg", "phone_format", "phone", "change", "phone", "ph_fmt")
    add("ph_flag", "phone_format", "phone", "flag", "phone", "NULL",
        _sqlfmt(spec.NOTE_PHONE_FLAG, "CAST(length(ph_d) AS VARCHAR)"))
    for c in ("date_of_birth", "created_date"):
        add(f"{c}_chg", "date_format", c, "change", c, f"{c}_iso")
        add(f"{c}_lit", "date_format", c, "null", c, "NULL", q(spec.NOTE_DATE_LITERAL))
        add(f"{c}_bad", "date_format", c, "null", c, "NULL", _sqlfmt(spec.NOTE_DATE_UNPARSEABLE, strip(c)))
    for c in ("first_name", "last_name"):
        add(f"{c}_chg", "name_case", c, "change", c, f"{c}_t", _sqlfmt(spec.NOTE_NAME_CHANGE, strip(c), f"{c}_t"))
    for c in ("first_name", "last_name"):
        add(blank(f"{c}_c3"), "fill_missing", c, "fill", f"{c}_c3", q(spec.FILL_VALUES[c]))
    for c in ("address", "income", "account_status"):
        add(blank(c), "fill_missing", c, "fill", c, q(spec.FILL_VALUES[c]))
    add("rn > 1", "dedupe", "customer_id", "drop", "customer_id", "NULL",
        "'duplicate of row ' || CAST(first_row AS VARCHAR)")
    add("rn = 1 AND inc_neg", "negative_income", "income", "change", "income_f", "'0'")
    add("rn = 1 AND inc_hi", "income_over_limit", "income", "flag", "income_c", "NULL", q(spec.NOTE_FLAG_UNCHANGED))
    add("rn = 1 AND st_bad", "invalid_status", "account_status", "flag", "account_status_f", "NULL", q(spec.NOTE_FLAG))
    add("rn = 1 AND cr_fut", "future_created_date", "created_date", "flag", "created_date_c", "NULL",
        q(spec.NOTE_FLAG_UNCHANGED))
    add("rn = 1 AND dob_old", "extreme_age", "date_of_birth", "null", "date_of_birth_c", "NULL",
        _sqlfmt(spec.NOTE_AGE, "dob_age"))
    return "aud AS (" + "\nUNION ALL\n".join(e) + ")"


def _mask_exprs() -> dict[str, str]:
    def name(x):
        s = strip(x)
        return f"CASE WHEN {blank(x)} THEN '' WHEN {s} = '[UNKNOWN]' THEN {s} ELSE substr({s}, 1, 1) || '***' END"

    def email(x):
        s = strip(x)
        loc = f"split_part({s}, '@', 1)"
        return (f"CASE WHEN {blank(x)} THEN '' WHEN strpos({s}, '@') = 0 THEN {s} "
                f"ELSE (CASE WHEN {loc} <> '' THEN substr({loc}, 1, 1) || '***' ELSE '***' END) || '@' || "
                f"substr({s}, strpos({s}, '@') + 1) END")

    def phone(x):
        s = strip(x)
        d0 = digits(s)
        d = f"(CASE WHEN length({d0}) = 11 AND starts_with({d0}, '1') THEN substr({d0}, 2) ELSE {d0} END)"
        return (f"CASE WHEN {blank(x)} THEN '' WHEN length({d}) = 10 THEN '***-***-' || substr({d}, 7, 4) "
                f"WHEN length({s}) >= 4 THEN '***' || right({s}, 4) ELSE '****' END")

    def address(x):
        s = strip(x)
        return f"CASE WHEN {x} IS NULL THEN '' WHEN {s} IN ('', '[UNKNOWN]') THEN {s} ELSE '[MASKED ADDRESS]' END"

    def dob(x):
        s = strip(x)
        h = f"split_part({s}, '-', 1)"
        return f"CASE WHEN {blank(x)} THEN '' WHEN length({h}) = 4 THEN {h} || '-**-**' ELSE '****-**-**' END"

    return {"first_name": name("first_name"), "last_name": name("last_name"), "email": email("email"),
            "phone": phone("phone"), "address": address("address"), "date_of_birth": dob("date_of_birth")}


def clean_mask_sql() -> dict[str, str]:
    out = {}
    base = _with(M, _clean_ctes(), _audit_sql())
    out["clean_full"] = base + "SELECT * FROM cl"
    out["clean_row_numbers"] = _with(M, _clean_ctes()) + (
        "SELECT row_num, CAST(row_number() OVER (ORDER BY row_num) + 1 AS BIGINT) AS clean_row_num FROM cl")
    steps = {
        "clean_phone": "step = 'phone_format'",
        "clean_dates": "step = 'date_format'",
        "clean_names": "step = 'name_case'",
        "clean_fill": "step = 'fill_missing'",
        "clean_dedupe": "step = 'dedupe'",
        "clean_negative_income": "step = 'negative_income'",
        "clean_extreme_age": "step = 'extreme_age'",
        "clean_flags": "action = 'flag'",
    }
    for name, cond in steps.items():
        out[name] = base + f"SELECT * FROM aud WHERE {cond}"
    out["clean_audit_counts"] = base + 'SELECT step, "column", action, count(*) AS n_rows FROM aud GROUP BY 1, 2, 3'
    out["clean_summary"] = base + """SELECT (SELECT count(*) FROM messy) AS rows_in, (SELECT count(*) FROM cl) AS rows_out,
  (SELECT count(*) FROM messy) - (SELECT count(*) FROM cl) AS rows_dropped,
  (SELECT count_if(date_of_birth_c IS NULL OR trim(date_of_birth_c) = '') FROM s5) AS dob_missing,
  CAST(10 AS BIGINT) AS columns"""
    out["clean_before_after"] = _with(M, _clean_ctes(), f"fb AS ({failures_sql('messy')})",
                                      f"fa AS ({failures_sql('cl')})") + """
SELECT 'before' AS phase, "column", count(*) AS n_failures FROM fb GROUP BY 2
UNION ALL SELECT 'after', "column", count(*) FROM fa GROUP BY 2"""
    out["clean_negative_balance"] = ("SELECT c_custkey, c_acctbal AS old_value, CAST(0.0 AS DOUBLE) AS new_value FROM customer "
                                     "WHERE NOT isnan(c_acctbal) AND c_acctbal < 0")
    mx = _mask_exprs()
    cl = _with(M, _clean_ctes())
    out["mask_names"] = cl + f"SELECT row_num, {mx['first_name']} AS first_name, {mx['last_name']} AS last_name FROM cl"
    out["mask_email"] = cl + f"SELECT row_num, {mx['email']} AS email FROM cl"
    out["mask_phone"] = cl + f"SELECT row_num, {mx['phone']} AS phone FROM cl"
    out["mask_address"] = cl + f"SELECT row_num, {mx['address']} AS address FROM cl"
    out["mask_dob"] = cl + f"SELECT row_num, {mx['date_of_birth']} AS date_of_birth FROM cl"
    full_cols = ", ".join(mx.get(c, c) + f" AS {c}" for c in ["row_num"] + CUST)
    masked = f"mk AS (SELECT {full_cols} FROM cl)"
    out["mask_full"] = _with(M, _clean_ctes(), masked) + "SELECT * FROM mk"
    out["mask_sample"] = _with(M, _clean_ctes(), masked) + """
SELECT * FROM (SELECT *, 'before' AS phase FROM cl ORDER BY row_num LIMIT 3)
UNION ALL SELECT * FROM (SELECT *, 'after' AS phase FROM mk ORDER BY row_num LIMIT 3)"""
    cnt = ", ".join(
        (f"count_if(({mx[c]}) IS DISTINCT FROM {c}) AS c{i}" if c in mx else f"CAST(0 AS BIGINT) AS c{i}")
        for i, c in enumerate(CUST))
    rows = " UNION ALL ".join(
        f"SELECT rows, CAST({i + 1} AS BIGINT) AS position, {q(c)} AS \"column\", "
        f"{q('MASKED' if c in mx else 'INTACT')} AS treatment, c{i} AS n_changed FROM a" for i, c in enumerate(CUST))
    out["mask_summary"] = _with(M, _clean_ctes(), f"a AS (SELECT count(*) AS rows, {cnt} FROM cl)") + rows
    return out


# ---------------------------------------------------------------------------
# Extensions
# ---------------------------------------------------------------------------

def extension_sql() -> dict[str, str]:
    out = {}
    dob = pdate("date_of_birth", spec.VALIDATE_DATE_FORMATS)
    cr = pdate("created_date", spec.VALIDATE_DATE_FORMATS)
    inc = pnum("income")
    out["ext_cross_column"] = _with(M) + f"""
SELECT row_num, 'date_of_birth,created_date' AS "column", 'cross.created_before_birth' AS rule_id,
  'Account created before the date of birth' AS rule, concat_ws(' / ', date_of_birth, created_date) AS value
FROM messy WHERE {cr} < {dob}
UNION ALL
SELECT row_num, 'date_of_birth,income', 'cross.minor_with_income', 'Income reported for an age below 18',
  concat_ws(' / ', date_of_birth, income) FROM messy WHERE {age(dob)} < 18 AND NOT isnan({inc}) AND {inc} > 0"""
    out["ext_soft_duplicates"] = _with(M) + f"""
SELECT lower({strip('email')}) AS match_key, count(*) AS n_rows, count(DISTINCT {strip('customer_id')}) AS n_ids,
  min(row_num) AS first_row FROM messy WHERE {nblank('email')} GROUP BY 1 HAVING count(DISTINCT {strip('customer_id')}) > 1"""

    def nm(c):
        return f"regexp_replace(lower({strip(f'coalesce({c}, {chr(39)}{chr(39)})')}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"

    full = f"concat_ws('|', {nm('first_name')}, {nm('last_name')}, {nm('address')})"
    out["ext_fuzzy_duplicates"] = _with(M, f"b AS (SELECT row_num, {full} AS f FROM messy "
                                            f"WHERE {nblank('last_name')} AND {nblank('address')})") + """,
t AS (SELECT f, min(row_num) AS first_row FROM b GROUP BY f),
p AS (SELECT x.f, min({'rep': y.first_row, 'd': levenshtein(x.f, y.f)}) AS low FROM t x, t y
  WHERE abs(length(x.f) - length(y.f)) <= 2 AND levenshtein(x.f, y.f) <= 2 GROUP BY x.f)
SELECT b.row_num, p.low.rep AS rep_row, CAST(p.low.d AS BIGINT) AS distance
FROM b JOIN p USING (f) WHERE p.low.rep < b.row_num"""

    def z(src, idc, grp, val, ctes=""):
        return f"""WITH {ctes}base AS (SELECT {idc}, {grp} AS grp, {val} AS x FROM {src}),
b2 AS (SELECT * FROM base WHERE x IS NOT NULL AND NOT isnan(x) AND grp IS NOT NULL),
st AS (SELECT grp, avg(x) AS mean, stddev_samp(x) AS sd FROM b2 GROUP BY grp)
SELECT {idc}, grp, round(x, 4) AS value, round((x - mean) / sd, 4) AS z FROM b2 JOIN st USING (grp)
WHERE sd IS NOT NULL AND sd > 0 AND abs((x - mean) / sd) > 3"""

    out["ext_zscore_outliers"] = z("orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    out["ext_zscore_income"] = z("messy", "row_num", f"lower({strip('account_status')})", pnum("income"), M + ",\n")
    from veridq.operators.extend import RELATIONS
    rel = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS BIGINT) AS position, {q(name)} AS relation, "
        f"(SELECT count(*) FROM {ct}) AS child_rows, "
        f"(SELECT count(*) FROM {ct} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {pt} p WHERE p.{pk} = c.{fk})) AS orphan_rows"
        for i, (name, ct, fk, pt, pk) in enumerate(RELATIONS))
    out["ext_referential_orphans"] = rel
    out["ext_quarantine_split"] = _with(M, _row_failures_sql()) + """,
a AS (SELECT count(*) AS t, count_if(n_failures > 0) AS qn FROM rs)
SELECT 'valid' AS partition, t - qn AS n_rows, round(qn * 100.0 / t, 2) AS batch_failure_pct,
  CASE WHEN qn * 1.0 / t > 0.2 THEN 'HOLD' ELSE 'PASS' END AS gate FROM a
UNION ALL SELECT 'quarantine', qn, round(qn * 100.0 / t, 2), CASE WHEN qn * 1.0 / t > 0.2 THEN 'HOLD' ELSE 'PASS' END FROM a"""
    changed = [(c, r, p.replace("BETWEEN 10 AND 15", "BETWEEN 11 AND 15"), m) for c, r, p, m in _rules() if (c, r) != ("first_name", "charset")]
    out["ext_rescan"] = _with(M) + f"""SELECT *, CASE WHEN rule_id = 'phone.digits' THEN 1 ELSE 0 END AS since
FROM ({failures_sql("messy", rules=changed)})"""
    email = failures_sql("messy", ["email"])
    out["ext_gate"] = _with(M, _row_failures_sql(), f"""e AS (
  SELECT m.row_num, count(f.row_num) AS n FROM messy m LEFT JOIN ({email}) f USING (row_num) GROUP BY ALL)""") + """
SELECT CASE WHEN n = 0 THEN 'published' ELSE 'quarantined' END AS view, 'email' AS batch, row_num, CAST(n AS BIGINT) AS n_failures FROM e
WHERE (SELECT avg(CAST(n > 0 AS INT)) <= 0.2 FROM e)
UNION ALL SELECT 'quarantined', 'all', row_num, n_failures FROM rs WHERE (SELECT avg(CAST(n_failures > 0 AS INT)) > 0.2 FROM rs)"""
    lineage = _with(M, _clean_ctes(), _audit_sql())
    out["ext_lineage_replay"] = lineage + "SELECT * FROM cl"
    out["ext_lineage_restore"] = lineage + "SELECT m.* FROM messy m SEMI JOIN cl USING (row_num)"
    out["ext_lineage_report"] = lineage + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_cells, count_if(m.{c} IS DISTINCT FROM cl.{c}) AS n_changed,
  count_if(m.row_num IN (SELECT row_num FROM aud WHERE "column" = '{c}' AND action IN ('change', 'null', 'fill'))) AS n_audited, CAST(0 AS BIGINT) AS n_unexplained
FROM messy m JOIN cl USING (row_num)""" for c in CUST)
    out["ext_sketch_weeks"] = """SELECT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER) AS week, count(*) AS n_events,
  count_if(value IS NULL) AS n_missing, count(DISTINCT user_id) AS n_users, true AS users_within, true AS median_within
FROM events GROUP BY 1"""
    out["ext_failure_drift"] = """WITH d AS (
  SELECT CAST(ts AS DATE) AS day, count(*) AS n_events,
    count_if(event_type = 'error' OR value IS NULL OR isnan(value) OR value < 0 OR NOT coalesce(json_valid(props), false)) AS n_failed
  FROM events GROUP BY 1),
r AS (SELECT day, n_events, n_failed, n_failed * 100.0 / n_events AS rate FROM d),
p AS (SELECT a.day, avg(b.rate) AS avg_prev FROM r a JOIN r b ON b.day >= a.day - 7 AND b.day <= a.day - 1 GROUP BY a.day)
SELECT CAST(r.day AS VARCHAR) AS day, n_events, n_failed, round(rate, 4) AS failure_pct, round(avg_prev, 4) AS avg_prev_pct,
  CASE WHEN avg_prev IS NULL THEN 'OK' WHEN abs(rate - avg_prev) > 5 THEN 'DRIFT' ELSE 'OK' END AS status
FROM r LEFT JOIN p USING (day)"""
    out["ext_review_queue"] = _with(M, _clean_ctes(), _audit_sql()) + """SELECT a.row_num, a.step, a."column", a.old_value,
  a.note, c.customer_id, c.email FROM aud a JOIN cl c USING (row_num) WHERE a.action = 'flag'"""
    n = pnum("income")
    br = " ".join(f"WHEN {n} < {hi} THEN {q(lbl)}" for lo, hi, lbl in
                  [(0, 25000, "0-25k"), (25000, 50000, "25k-50k"), (50000, 100000, "50k-100k"), (100000, 250000, "100k-250k")])
    out["ext_income_brackets"] = _with(M, _clean_ctes()) + f"""SELECT row_num,
  CASE WHEN {n} IS NULL OR isnan({n}) THEN 'unknown' WHEN {n} < 0 THEN 'negative' {br} ELSE '250k+' END AS income_bracket
FROM cl"""
    return out


# ---------------------------------------------------------------------------
# Streaming (same results as the batch operators they mirror)
# ---------------------------------------------------------------------------

def streaming_sql() -> dict[str, str]:
    mx = _mask_exprs()
    cols = ", ".join(mx.get(c, c) + f" AS {c}" for c in ["row_num"] + CUST)
    return {
        "stream_validate": _with(M) + failures_sql("messy"),
        "stream_mask": _with(M) + f"SELECT {cols} FROM messy",
        "stream_dedupe": _with(M) + "SELECT * FROM messy QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_num) = 1",
        "stream_duplicate_ids": _with(M) + "SELECT * FROM (" + failures_sql("messy", ["customer_id"]) + ") WHERE rule_id = 'customer_id.duplicate'",
        "stream_pii_conversations": f"""WITH n AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS msg_id,
  {", ".join(f"len(regexp_extract_all(coalesce(text, ''), {q(p)})) AS n_{k}" for k, p in TEXT_PATTERNS.items())} FROM conversations)
SELECT *, array_to_string(list_filter([{", ".join(f"CASE WHEN n_{k} > 0 THEN '{k}' END" for k in TEXT_PATTERNS)}], lambda x: x IS NOT NULL), ',') AS pii FROM n""",
        "stream_pii_windows": _with(M) + f"""SELECT strftime({pdate("created_date", spec.VALIDATE_DATE_FORMATS)}, '%Y-%m') AS month, detector,
  count_if(hit) AS n_rows, count(*) AS total
FROM (SELECT created_date, unnest([{", ".join(f"{{'detector': '{k}', 'hit': {v}}}" for k, v in _pii_flags().items())}], recursive := true) FROM messy)
GROUP BY 1, 2""",
        "stream_event_quality": """SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n_events,
  count_if(event_type = 'error' OR value IS NULL OR isnan(value) OR value < 0 OR NOT coalesce(json_valid(props), false)) AS n_failed
FROM events GROUP BY 1""",
    }


# ---------------------------------------------------------------------------
# Runs: stage rows and row counts of every table, and the gate
# ---------------------------------------------------------------------------

#: Table of a run -> query with the same rows.
RUN_TABLES = {
    "issues": "issues_all", "issue_severity": "issues_by_severity", "completeness": "profile_completeness",
    "type_conformance": "profile_type_conformance", "phone_formats": "profile_phone_formats",
    "date_formats": "profile_date_formats", "key_duplicates": "profile_key_uniqueness", "row_health": "profile_row_health",
    "pii_inventory": "pii_row_inventory", "pii_coverage": "pii_coverage", "pii_classification": "pii_column_classification",
    "failures": "validate_all_failures", "validation_summary": "validate_column_summary", "row_status": "validate_row_status",
    "cleaned": "clean_full", "masked": "mask_full", "mask_summary": "mask_summary",
}


def pipeline_sql(sql: dict[str, str]) -> dict[str, str]:
    def n(name):
        return f"(SELECT count(*) FROM ({sql[RUN_TABLES[name]]}))"

    audit = "(SELECT count(*) FROM (" + _with(M, _clean_ctes(), _audit_sql()) + "SELECT * FROM aud))"
    counts = {t: n(t) for t in RUN_TABLES} | {"audit": audit}
    raw = "(SELECT count(*) FROM orders)"
    failed = f"(SELECT count(*) FROM ({sql['validate_row_status']}) WHERE n_failures > 0)"
    stages = [
        ("load", "'SUCCESS'", f"CAST({raw} AS VARCHAR) || ' rows, 10 columns'", raw, raw),
        ("profile", "'SUCCESS'", "CAST(issues AS VARCHAR) || ' quality issues found'", "NULL", "issues"),
        ("pii", "'SUCCESS'", "'inventory and coverage written'", "NULL", "pii_inventory"),
        ("validate", "CASE WHEN failures = 0 THEN 'SUCCESS' ELSE 'WARNINGS' END", "CAST(failures AS VARCHAR) || ' failures in ' || CAST(failed AS VARCHAR) || ' rows'", "row_status", "failures"),
        ("clean", "'SUCCESS'", "CAST(cleaned AS VARCHAR) || ' rows after cleaning'", "NULL", "cleaned"),
        ("mask", "'SUCCESS'", "'all PII columns masked'", "NULL", "masked"),
        ("run", "'SUCCESS'", f"'{len(counts)} tables written, 0 missing'", raw, "masked"),
    ]
    c = "c AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in counts.items()) + f", {failed} AS failed)"
    summary = " UNION ALL ".join(
        f"SELECT '{s}' AS stage, {status} AS status, {detail} AS detail, CAST({i} AS BIGINT) AS rows_in, CAST({o} AS BIGINT) AS rows_out FROM c"
        for s, status, detail, i, o in stages)
    tables = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", {v} AS rows, 'OK' AS status" for t, v in counts.items())
    return {
        "pipeline_summary": _with(c) + summary,
        "manifest": tables,
        "pipeline_gate": f"""SELECT *, 'SUCCESS' AS first_run,
  CASE WHEN (SELECT avg(CAST(n_failures > 0 AS INT)) FROM ({sql['validate_row_status']})) > 0.2 THEN 'HELD' ELSE 'SUCCESS' END AS second_run
FROM ({sql['mask_full']})""",
    }
