"""Table contract, rule constants and policies (plain data, no Spark).

The values under "FIXED VALUES" must equal the behaviour being reproduced
(patterns, domains, messages, registry entries); they are stated once here and
every operator reads them from this module.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
from dataclasses import asdict, dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — must match the reproduced behaviour exactly.
# ---------------------------------------------------------------------------

# Customer contract: column -> logical type.
LOGICAL_TYPES = {
    "customer_id": "INT",
    "first_name": "STRING",
    "last_name": "STRING",
    "email": "STRING",
    "phone": "STRING",
    "date_of_birth": "DATE",
    "address": "STRING",
    "income": "NUMERIC",
    "account_status": "STRING",
    "created_date": "DATE",
}
CUSTOMER_COLUMNS = list(LOGICAL_TYPES)

# Allowed account_status values (compared after strip + lower-case).
VALID_STATUSES = ["active", "inactive", "suspended"]

# Ordered phone format catalogue: first match wins, else PHONE_OTHER.
PHONE_FORMATS = [
    ("XXX-XXX-XXXX", r"^\d{3}-\d{3}-\d{4}$"),
    ("(XXX) XXX-XXXX", r"^\(\d{3}\) \d{3}-\d{4}$"),
    ("XXX.XXX.XXXX", r"^\d{3}\.\d{3}\.\d{4}$"),
    ("XXXXXXXXXX", r"^\d{10}$"),
    ("+1-XXX-XXX-XXXX", r"^\+1-\d{3}-\d{3}-\d{4}$"),
]
PHONE_OTHER = "Other / Unrecognised"
PHONE_STANDARD = "XXX-XXX-XXXX"

# Ordered date-shape catalogue (case-insensitive): first match wins, else DATE_OTHER.
DATE_SHAPES = [
    ("YYYY-MM-DD", r"^\d{4}-\d{2}-\d{2}$"),
    ("MM/DD/YYYY", r"^\d{2}/\d{2}/\d{4}$"),
    ("invalid_date (literal)", r"^invalid_date$"),
]
DATE_OTHER = "Other / Unparseable"
DATE_SHAPE_COLUMNS = ["date_of_birth", "created_date"]

# Date parse formats per stage (Spark datetime patterns; 1-2 digit month/day,
# exactly four-digit year).  Python equivalents: %Y-%m-%d, %m/%d/%Y, %d/%m/%Y, %Y/%m/%d.
ISO = "yyyy-M-d"
US = "M/d/yyyy"
EU = "d/M/yyyy"
YMD_SLASH = "yyyy/M/d"
VALIDATE_DATE_FORMATS = [ISO, US, EU]
PROFILE_DOB_FORMATS = [ISO, US, EU]
PROFILE_CREATED_FORMATS = [ISO, US]
CLEAN_DATE_FORMATS = [ISO, US, EU, YMD_SLASH]
FUTURE_FLAG_FORMATS = [ISO, US]
AGE_FLAG_FORMATS = [ISO, US]

INVALID_DATE_LITERAL = "invalid_date"
AGE_LIMIT_YEARS = 150
DAYS_PER_YEAR = 365.25
INCOME_LIMIT = 10_000_000

# Validation patterns.
EMAIL_FULL = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
NAME_FULL = r"^[A-Za-z\s'\-]{2,50}$"
PHONE_MIN_DIGITS, PHONE_MAX_DIGITS = 10, 15
NAME_MIN_LEN, NAME_MAX_LEN = 2, 50

# Free-text PII patterns (search semantics).
EMAIL_SEARCH = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE_SEARCH = r"(?:\+1[-.\s]?)?(?:\(\d{3}\)|\d{3})[-.\s]?\d{3}[-.\s]?\d{4}"
DATE_SEARCH = r"\b\d{4}-\d{2}-\d{2}\b|\b\d{2}/\d{2}/\d{4}\b"

# PII registry: column -> (category, risk); the other contract columns are non-PII.
PII_REGISTRY = {
    "first_name": ("Names", "HIGH"),
    "last_name": ("Names", "HIGH"),
    "email": ("Contact Info", "HIGH"),
    "phone": ("Contact Info", "HIGH"),
    "date_of_birth": ("Sensitive Personal", "HIGH"),
    "address": ("Sensitive Personal", "HIGH"),
    "income": ("Financial", "MEDIUM"),
}
NON_PII = ("Non-PII", "NONE")

# Row inventory labels, in output order.
PII_LABEL_NAME = "Name (first/last)"
PII_LABEL_EMAIL = "Email"
PII_LABEL_PHONE = "Phone"
PII_LABEL_ADDRESS = "Address"
PII_LABEL_DOB = "Date of Birth"
PII_LABEL_INCOME = "Income"
NO_PII = "No PII detected"

# Issue types: (type, severity).
SEVERITIES = ["Critical", "High", "Medium"]
SEVERITY_DESCRIPTIONS = {
    "Critical": "blocks processing",
    "High": "data incorrect",
    "Medium": "needs cleaning",
}
ISSUE_SEVERITY = {
    "invalid_date_string": "Critical",
    "non_numeric_income": "Critical",
    "negative_income": "High",
    "income_exceeds_10M": "Medium",
    "extreme_age": "High",
    "future_created_date": "Medium",
    "invalid_account_status": "High",
    "name_all_caps": "Medium",
    "name_all_lower": "Medium",
    "non_standard_phone_format": "Medium",
}

# Validation messages.
MSG_ID_MISSING = "Must be a positive integer (missing)"
MSG_ID_NOT_POSITIVE = "Must be a positive integer (value <= 0)"
MSG_ID_NOT_NUMERIC = "Must be a positive integer (non-numeric)"
MSG_ID_DUPLICATE = "Must be unique (duplicate of row {})"
MSG_NON_EMPTY = "Must be non-empty"
MSG_NAME_LENGTH = "Length must be between 2 and 50 characters"
MSG_NAME_CHARSET = "Must contain only letters, spaces, hyphens, or apostrophes"
MSG_EMAIL_FORMAT = "Must be a valid email address format"
MSG_PHONE_DIGITS = "Stripped digit count must be 10–15 (got {})"
MSG_DATE_LITERAL = "Not a valid date (literal 'invalid_date' string)"
MSG_DATE_UNPARSEABLE = "Could not be parsed as a valid date"
MSG_DATE_FUTURE = "Date must not be in the future"
MSG_DOB_AGE = "Date of birth implies age > 150 years (~{} years)"
MSG_DOB_FUTURE = "Date of birth is in the future"
MSG_INCOME_EMPTY = "Must be non-empty numeric value"
MSG_INCOME_NOT_NUMERIC = "Must be a numeric value"
MSG_INCOME_NEGATIVE = "Income must be non-negative"
MSG_INCOME_OVER = "Income exceeds $10,000,000 upper bound"
MSG_STATUS_MISSING = "Must be one of: active, inactive, suspended (missing)"
MSG_STATUS_DOMAIN = "Must be one of: active, inactive, suspended (got '{}')"

# Per-column rule descriptions of the validation summary.
RULE_DESCRIPTIONS = {
    "customer_id": "Positive int, unique",
    "first_name": "Non-empty, 2-50 chars, letters only",
    "last_name": "Non-empty, 2-50 chars, letters only",
    "email": "Valid email format",
    "phone": "10-15 digits when stripped",
    "date_of_birth": "Valid date, age 0-150 years",
    "created_date": "Valid date, not in future",
    "address": "Non-empty string",
    "income": "Non-negative, <= $10M",
    "account_status": "active|inactive|suspended",
}

# Cleaning fills (blank -> value); date_of_birth is left null.
FILL_VALUES = {
    "first_name": "[UNKNOWN]",
    "last_name": "[UNKNOWN]",
    "address": "[UNKNOWN]",
    "income": "0",
    "account_status": "unknown",
}
PLACEHOLDER = "[UNKNOWN]"

# Cleaning audit notes ({} = value inserted at run time).
NOTE_PHONE_FLAG = "Could not normalise: {} digits after stripping"
NOTE_DATE_LITERAL = "Literal 'invalid_date' — set to NaN"
NOTE_DATE_UNPARSEABLE = "Unparseable date string '{}' — set to NaN"
NOTE_NAME_CHANGE = "'{}' -> '{}'"
NOTE_FLAG_UNCHANGED = "flagged for review (NOT modified)"
NOTE_FLAG = "flagged for review"
NOTE_AGE = "(~{} years old)"

# Masking outputs.
MASK_SUFFIX = "***"
MASKED_ADDRESS = "[MASKED ADDRESS]"
MASKED_PHONE_PREFIX = "***-***-"
MASKED_PHONE_SHORT = "****"
MASKED_DOB_TAIL = "-**-**"
MASKED_DOB_FULL = "****-**-**"

NULL_TOKEN = "<NA>"

# Date of the published golden run; every date rule takes as_of explicitly.
GOLDEN_AS_OF = _dt.date(2026, 2, 27)

# Python str.strip() whitespace: \t \n \v \f \r, \x1c-\x1f, space, \x85, nbsp,
# U+1680, U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# ---------------------------------------------------------------------------
# Policies
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RunConfig:
    """Options shared by all stages."""

    as_of: _dt.date = GOLDEN_AS_OF
    # Render null cells as "<NA>" in the checks that stringify (parity); None = clean semantics.
    null_token: str | None = NULL_TOKEN


@dataclass(frozen=True)
class CleanPolicy:
    fills: dict = field(default_factory=lambda: dict(FILL_VALUES))
    date_formats: tuple = tuple(CLEAN_DATE_FORMATS)
    # Skip title-casing of fill placeholders so that clean(clean(x)) == clean(x).
    protect_placeholders: bool = False
    # False = "flag only" review mode: no value is changed, every change becomes a flag.
    fix: bool = True


@dataclass(frozen=True)
class MaskPolicy:
    # True: an email without "@" is replaced by "***" instead of left as is.
    strict: bool = False


def ruleset_version() -> str:
    """Stable hash of every constant that drives the rules (X5)."""
    payload = {
        k: v
        for k, v in globals().items()
        if k.isupper() and isinstance(v, (str, int, float, list, dict, tuple))
    }
    blob = json.dumps(payload, sort_keys=True, default=str).encode()
    return hashlib.sha256(blob).hexdigest()[:16]


def config_dict(cfg: RunConfig) -> dict:
    return {k: str(v) for k, v in asdict(cfg).items()}
