from collections import Counter

from veridq.operators import profile as P


def test_completeness(raw):
    m = {r.column: r.missing for r in P.completeness(raw).collect()}
    assert m == {"customer_id": 0, "first_name": 1, "last_name": 1, "email": 0, "phone": 0,
                 "date_of_birth": 1, "address": 2, "income": 1, "account_status": 1, "created_date": 0}


def test_type_conformance(raw):
    st = {r.column: r.status for r in P.type_conformance(raw).collect()}
    assert [c for c, s in st.items() if s == "FAIL"] == ["customer_id", "date_of_birth", "income", "created_date"]


def test_formats(raw):
    ph = {r.format: (r.n_rows, r.example_1, r.example_2) for r in P.phone_formats(raw).collect()}
    assert ph["XXX-XXX-XXXX"] == (9, "555-123-4567", "555-345-6789")
    assert ph["(XXX) XXX-XXXX"][0] == 3 and ph["XXX.XXX.XXXX"][0] == 1
    assert ph["XXXXXXXXXX"][0] == 1 and ph["+1-XXX-XXX-XXXX"][0] == 1
    df = {(r.column, r.format): r.n_rows for r in P.date_formats(raw).collect()}
    assert df == {("date_of_birth", "YYYY-MM-DD"): 11, ("date_of_birth", "MM/DD/YYYY"): 1,
                  ("date_of_birth", "invalid_date (literal)"): 2, ("created_date", "YYYY-MM-DD"): 15}


def test_uniqueness(raw):
    d = P.key_duplicates(raw, ["customer_id"]).collect()
    assert [(r.customer_id, r.n_rows, r.first_row) for r in d] == [("1", 2, 2)]


def test_issues_golden(raw):
    iss = P.issues(raw).collect()
    assert len(iss) == 19
    assert Counter(r.severity for r in iss) == {"Critical": 3, "High": 3, "Medium": 13}
    ages = [r.age_years for r in iss if r.type == "extreme_age"]
    assert ages == [176.2]
    phone_rows = sorted(r.row_num for r in iss if r.type == "non_standard_phone_format")
    assert phone_rows == [3, 4, 8, 9, 10, 13]
    caps = sorted((r.column, r.row_num) for r in iss if r.type == "name_all_caps")
    assert caps == [("first_name", 4), ("first_name", 7), ("last_name", 6)]
    sev = {r.severity: r.n_issues for r in P.issues_by_severity(raw).collect()}
    assert sev == {"Critical": 3, "High": 3, "Medium": 13}
    t = P.issue_totals(raw).first()
    assert (t.issues_core, t.issues_all) == (13, 19)


def test_row_health(raw):
    h = P.row_health(raw).first()
    assert (h.total_rows, h.problem_rows, h.clean_rows, h.problem_pct, h.clean_pct) == (15, 13, 2, 86.7, 13.3)


def test_clean_semantics_without_null_token(raw):
    iss = P.issues(raw, token=None).collect()
    assert not any(r.type == "non_numeric_income" for r in iss)
    assert not any(r.type == "name_all_caps" and r.value is None for r in iss)
