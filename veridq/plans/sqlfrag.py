"""SQL fragments for the DuckDB oracle queries (independent formulation of the
same semantics, used only to cross-check the Spark operators)."""

from __future__ import annotations

from veridq import spec

AS_OF = f"DATE '{spec.GOLDEN_AS_OF.isoformat()}'"
WS = "(" + "||".join(f"chr({ord(c)})" for c in spec.PY_WHITESPACE) + ")"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(v: str) -> str:
    return f"trim({v}, {WS})"


def blank(v: str) -> str:
    return f"({v} IS NULL OR {strip(v)} = '')"


def nblank(v: str) -> str:
    return f"({v} IS NOT NULL AND {strip(v)} <> '')"


_PY_FMT = {spec.ISO: "%Y-%m-%d", spec.US: "%m/%d/%Y", spec.EU: "%d/%m/%Y", spec.YMD_SLASH: "%Y/%m/%d"}


def pdate(v: str, formats) -> str:
    fl = ", ".join(q(_PY_FMT[f]) for f in formats)
    return f"CAST(try_strptime({strip(v)}, [{fl}]) AS DATE)"


def pnum(v: str) -> str:
    return f"try_cast({strip(v)} AS DOUBLE)"


def digits(v: str) -> str:
    return f"regexp_replace({v}, '[^0-9]', '', 'g')"


def age(d: str) -> str:
    return f"(date_diff('day', {d}, {AS_OF}) / 365.25)"


def rx(v: str, pattern: str) -> str:
    return f"regexp_matches({v}, {q(pattern)})"


def title(v: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({v}, '[A-Za-z]+|[^A-Za-z]+'), "
        f"lambda x: upper(x[1]) || lower(x[2:])), '')"
    )


def messy_cte() -> str:
    """The messy customer view over ``orders`` (FIXTURES.md §2) in SQL."""
    k = "o_orderkey"
    p3 = f"lpad(CAST({k} % 1000 AS VARCHAR), 3, '0')"
    p4 = f"lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')"
    mm = f"lpad(CAST(1 + {k} % 12 AS VARCHAR), 2, '0')"
    dd = f"lpad(CAST(1 + {k} % 28 AS VARCHAR), 2, '0')"
    yy = f"CAST(1950 + {k} % 50 AS VARCHAR)"
    return f"""messy AS (
  SELECT
    CAST({k} + 2 AS BIGINT) AS row_num,
    CASE WHEN {k} % 211 = 7 THEN NULL WHEN {k} % 223 = 9 THEN 'abc' WHEN {k} % 227 = 11 THEN '-4'
         WHEN {k} % 97 = 5 THEN CAST({k} AS VARCHAR) ELSE CAST({k} + 1 AS VARCHAR) END AS customer_id,
    CASE WHEN {k} % 29 = 3 THEN NULL WHEN {k} % 53 = 9 THEN '   ' WHEN {k} % 31 = 4 THEN 'PATRICIA'
         WHEN {k} % 37 = 5 THEN 'jennifer' WHEN {k} % 41 = 6 THEN 'J' WHEN {k} % 43 = 7 THEN 'o''brien'
         WHEN {k} % 47 = 8 THEN 'R2D2' WHEN {k} % 4 = 0 THEN 'John' WHEN {k} % 4 = 1 THEN 'Mary'
         WHEN {k} % 4 = 2 THEN 'McKay' ELSE 'Ann-Lee' END AS first_name,
    CASE WHEN {k} % 34 = 3 THEN NULL WHEN {k} % 38 = 4 THEN 'wilson' WHEN {k} % 46 = 5 THEN 'MOORE'
         WHEN {k} % 3 = 0 THEN 'Doe' WHEN {k} % 3 = 1 THEN 'Smith' ELSE 'Brown' END AS last_name,
    CASE WHEN {k} % 59 = 1 THEN NULL WHEN {k} % 61 = 2 THEN 'not-an-email'
         WHEN {k} % 62 = 3 THEN 'a@b@example.com'
         ELSE 'user.' || CAST({k} AS VARCHAR) || '@example.com' END AS email,
    CASE WHEN {k} % 67 = 3 THEN NULL
         WHEN {k} % 7 = 0 THEN '(555) ' || {p3} || '-' || {p4}
         WHEN {k} % 7 = 1 THEN '555.' || {p3} || '.' || {p4}
         WHEN {k} % 7 = 2 THEN '555' || {p3} || {p4}
         WHEN {k} % 7 = 3 THEN '+1-555-' || {p3} || '-' || {p4}
         WHEN {k} % 77 = 4 THEN {p3} || '-' || {p4}
         ELSE '555-' || {p3} || '-' || {p4} END AS phone,
    CASE WHEN {k} % 71 = 6 THEN NULL WHEN {k} % 17 = 3 THEN 'invalid_date'
         WHEN {k} % 23 = 5 THEN '1850-01-01' WHEN {k} % 73 = 7 THEN '2001-02-30'
         WHEN {k} % 79 = 8 THEN '25/12/1990' WHEN {k} % 74 = 9 THEN '1990/07/22'
         WHEN {k} % 109 = 2 THEN '2099-01-01' WHEN {k} % 19 = 4 THEN {mm} || '/' || {dd} || '/' || {yy}
         ELSE {yy} || '-' || {mm} || '-' || {dd} END AS date_of_birth,
    CASE WHEN {k} % 13 = 2 THEN NULL ELSE CAST({k} AS VARCHAR) || ' Main St' END AS address,
    CASE WHEN {k} % 11 = 3 THEN NULL WHEN {k} % 83 = 4 THEN '-5000' WHEN {k} % 89 = 5 THEN '15000000'
         WHEN {k} % 101 = 6 THEN 'abc' ELSE CAST(20000 + ({k} * 37) % 100000 AS VARCHAR) END AS income,
    CASE WHEN {k} % 15 = 4 THEN NULL WHEN {k} % 16 = 5 THEN 'unknown' WHEN {k} % 18 = 6 THEN 'ACTIVE'
         WHEN {k} % 3 = 0 THEN 'active' WHEN {k} % 3 = 1 THEN 'inactive' ELSE 'suspended' END AS account_status,
    CASE WHEN {k} % 103 = 5 THEN '2099-06-01' WHEN {k} % 107 = 6 THEN 'invalid_date'
         ELSE '2024-' || {mm} || '-' || {dd} END AS created_date
  FROM orders
)"""
