"""Code columns: lenient casts, labels and the registry's predicates.

Codes arrive as text (``'02'``, ``'2'``, ``'ativa'``); every numeric comparison goes through
``try_cast`` so that junk becomes NULL instead of failing the job, on both sides of a comparison.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Registration status labels, site kinds and the code meaning "active".
# ---------------------------------------------------------------------------------------------
STATUS_LABELS: dict[int, str] = {2: "ATIVA", 3: "SUSPENSA", 4: "INAPTA", 8: "BAIXADA"}
STATUS_UNKNOWN = "(DESCONHECIDA)"
ACTIVE_CODE = 2
ACTIVE_TEXT = "ATIVA"
SITE_KINDS: dict[str, str] = {"1": "MATRIZ", "2": "FILIAL"}
HEAD_OFFICE = 1
INACTIVE_CODES = (3, 4, 8)
LARGE_SIZE_CODES = (3, 5)          # "EPP" and above
VALID_SIZE_CODES = (0, 1, 3, 5)
VALID_STATUS_CODES = (1, 2, 3, 4, 8)
CLINIC_MARKS = ("CLÍNIC", "CLINIC")
HEALTH_DIVISION = "86"


def col(c: Column | str) -> Column:
    """A Column from a name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def try_int(c: Column | str) -> Column:
    """Lenient integer: ``'02'`` → 2, ``' 2 '`` → 2, ``''``/``'abc'``/``'1.5'`` → NULL. Integers stay."""
    return col(c).try_cast("int")


def blank(c: Column | str) -> Column:
    """NULL → ``''``."""
    return F.coalesce(col(c), F.lit(""))


def flag(c: Column | str, default: str = "N") -> Column:
    """Yes/no flag with a default for missing values (``COALESCE(opcao,'N')``)."""
    return F.coalesce(col(c), F.lit(default))


def is_yes(c: Column | str) -> Column:
    """``'S'``/``'s'`` → true; NULL counts as ``'N'``. Never NULL itself."""
    return F.upper(flag(c)) == F.lit("S")


def same_text_ci(c: Column | str, value: str) -> Column:
    """Case-insensitive equality with a bound value (``UPPER(c) = UPPER(?)``)."""
    return F.upper(col(c)) == F.upper(F.lit(value))


def code_in(c: Column | str, codes: Iterable[int]) -> Column:
    """Lenient code membership (``TRY_CAST(c AS INT) IN (…)``); junk and NULL never match."""
    return try_int(c).isin([int(x) for x in codes])


def code_eq(c: Column | str, code: int) -> Column:
    """Lenient code equality (``TRY_CAST(c AS INT) = code``)."""
    return try_int(c) == F.lit(int(code))


def is_active(c: Column | str, code: Column | None = None) -> Column:
    """Active by code or by text (``2`` / ``'02'`` / ``'ATIVA'`` in any case)."""
    return ((try_int(c) if code is None else code) == F.lit(ACTIVE_CODE)) | (F.upper(col(c)) == F.lit(ACTIVE_TEXT))


def is_head_office(c: Column | str) -> Column:
    """Site kind 1 (head office), by lenient code."""
    return try_int(c) == F.lit(HEAD_OFFICE)


def status_label(c: Column | str) -> Column:
    """Status code label; unknown codes show the raw text, NULL shows ``(DESCONHECIDA)``."""
    code = try_int(c)
    expr = None
    for k, label in STATUS_LABELS.items():
        expr = F.when(code == k, F.lit(label)) if expr is None else expr.when(code == k, F.lit(label))
    return expr.otherwise(F.coalesce(col(c), F.lit(STATUS_UNKNOWN)))


def site_kind_label(c: Column | str) -> Column:
    """``'1'`` → MATRIZ, ``'2'`` → FILIAL, other text unchanged, NULL stays NULL."""
    c = col(c)
    expr = None
    for k, label in SITE_KINDS.items():
        expr = F.when(c == k, F.lit(label)) if expr is None else expr.when(c == k, F.lit(label))
    return expr.otherwise(c)


def cnae_division(c: Column | str) -> Column:
    """First two characters of an activity code (``''`` when missing)."""
    return F.substring(blank(c), 1, 2)


def division_eq(c: Column | str, division: int) -> Column:
    """Division test against a number: ``'01…'`` matches 1, a missing code never matches."""
    return try_int(cnae_division(c)) == F.lit(int(division))


def health_kind(description: Column | None) -> Column:
    """CLINICA when the activity description mentions a clinic, else OUTROS_SAUDE;
    SAUDE when no activity lookup exists."""
    if description is None:
        return F.lit("SAUDE")
    d = F.upper(blank(description))
    hit = None
    for mark in CLINIC_MARKS:
        h = d.contains(F.lit(mark))
        hit = h if hit is None else (hit | h)
    return F.when(hit, F.lit("CLINICA")).otherwise(F.lit("OUTROS_SAUDE"))


def date_arg(value: str) -> str:
    """``'2020-01-31'`` → ``'20200131'``, the form dates are stored in."""
    return value.replace("-", "")


def in_list_text(csv_list: Column | str, value: str) -> Column:
    """Membership of ``value`` in a comma-separated list column (missing list → false)."""
    return F.coalesce(F.array_contains(F.split(col(csv_list), ","), F.lit(value)), F.lit(False))
