"""Text columns: tax-id removal from name fields, and slugs.

``clean_name`` removes CPF/CNPJ numbers written at the start or end of a name, then loose edge
punctuation, then shrinks the first run of blanks and trims. It is a chain of built-in
``regexp_replace`` calls (JVM-side, codegen'd), written for Java's regex engine but with the
results of an RE2 engine that replaces only the first match:

* ``\\s`` is spelled ``[ \\t\\n\\f\\r]`` (Java's ``\\s`` also has ``\\x0B``), ``$`` is ``\\z``
  (Java's ``$`` also matches before a final newline);
* "first match only" is kept where it matters: only the first blank run is shrunk;
* blanks and punctuation around a token are possessive, so long blank runs stay linear;
* the end-anchored id step runs only on the trailing run of characters an id token can contain,
  which bounds its backtracking to that run and gives the same result (a match ending at the
  end of the text can only contain such characters).
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import col

# ---------------------------------------------------------------------------------------------
# The name-cleaning patterns, RE2 syntax, applied in this order, each replacing
# only its first match: ids at the start (formatted or bare CPF = 11 digits, CNPJ = 14 digits,
# CNPJ base = 8 digits, with brackets or separators around them, repeated), ids at the end,
# loose punctuation at the start, loose punctuation at the end, the first run of blanks (→ one
# space). The SQL oracle uses them as they are.
# ---------------------------------------------------------------------------------------------
RE2_LEAD_IDS = (r"^(?:\s*[\(\[\-]*\s*(?:\d{3}[.\s]?\d{3}[.\s]?\d{3}[-\s]?\d{2}|\d{11}|"
                r"\d{2}[.\s]?\d{3}[.\s]?\d{3}[\/\s]?\d{4}[-\s]?\d{2}|\d{14}|\d{2}[.\s]?\d{3}[.\s]?\d{3}|\d{8})"
                r"\s*[\)\]\-,:|]*\s*)+")
RE2_TRAIL_IDS = (r"(?:\s*[\(\[\-,:|]*\s*(?:\d{3}[.\s]?\d{3}[.\s]?\d{3}[-\s]?\d{2}|\d{11}|"
                 r"\d{2}[.\s]?\d{3}[.\s]?\d{3}[\/\s]?\d{4}[-\s]?\d{2}|\d{14}|\d{2}[.\s]?\d{3}[.\s]?\d{3}|\d{8})"
                 r"\s*[\)\]\-]*\s*)+$")
RE2_LEAD_PUNCT = r"^\s*[\-\(\)\[\]\.,:|]+\s*"
RE2_TRAIL_PUNCT = r"\s*[\-\(\)\[\]\.,:|]+\s*$"
RE2_BLANK_RUN = r"\s+"

JAVA_BLANK = r" \t\n\f\r"           # RE2's \s, written out for Java
_CLASS = re.compile(r"\[(?:\\.|[^\]\\])*\]")

# Trimming strips the Unicode space separators (category Zs) at both ends.
SPACE_SEPARATORS = "".join(chr(cp) for cp in range(0x110000) if unicodedata.category(chr(cp)) == "Zs")


def re2_patterns() -> dict[str, str]:
    return {"lead_ids": RE2_LEAD_IDS, "trail_ids": RE2_TRAIL_IDS, "lead_punct": RE2_LEAD_PUNCT,
            "trail_punct": RE2_TRAIL_PUNCT, "blank_run": RE2_BLANK_RUN}


def to_java(pattern: str) -> str:
    """Same matches in Java's engine: ``\\s`` spelled out (inside classes and as ``[…]``), every
    repeated class possessive (blanks and punctuation never need to give characters back, and
    this keeps long runs linear), and a final ``$`` as ``\\z``. Optional separators inside a
    token (``[.\\s]?``) stay as they are."""
    p = _CLASS.sub(lambda m: m.group(0).replace(r"\s", JAVA_BLANK), pattern)
    p = re.sub(r"(\[(?:\\.|[^\]\\])*\])([*+])(?!\+)", r"\1\2+", p)
    p = re.sub(r"\\s([*+])", lambda m: f"[{JAVA_BLANK}]{m.group(1)}+", p)
    return p[:-1] + r"\z" if p.endswith("$") else p


JAVA_LEAD_IDS = to_java(RE2_LEAD_IDS)
JAVA_TRAIL_IDS = to_java(RE2_TRAIL_IDS)
JAVA_LEAD_PUNCT = to_java(RE2_LEAD_PUNCT)
JAVA_TRAIL_PUNCT = to_java(RE2_TRAIL_PUNCT)
# characters a trailing id match can contain: blanks, digits, token separators, brackets
_TAIL_CHARS = rf"[0-9{JAVA_BLANK}.\/\(\)\[\]\-,:|]"
JAVA_TAIL_RUN = rf"(?<!{_TAIL_CHARS}){_TAIL_CHARS}*+\z"
# first-match-only replacement of the first blank run, written for replace-all engines
JAVA_FIRST_BLANK_RUN = rf"^([^{JAVA_BLANK}]*+)[{JAVA_BLANK}]++"
# The id and punctuation steps can only change a name that starts or ends (after blanks) with a
# digit, a bracket or edge punctuation; every other name skips them. Superset test, linear time.
_EDGE = r"0-9\(\)\[\]\-.,:|"
JAVA_NEEDS_EDGE_STEPS = rf"^[{JAVA_BLANK}]*+[{_EDGE}]|[{_EDGE}][{JAVA_BLANK}]*+\z"


def strip_leading_ids(c: Column) -> Column:
    return F.regexp_replace(c, JAVA_LEAD_IDS, "")


def strip_trailing_ids(c: Column) -> Column:
    tail = F.regexp_extract(c, JAVA_TAIL_RUN, 0)
    head = F.substring(c, F.lit(1), F.length(c) - F.length(tail))
    return F.concat(head, F.regexp_replace(tail, JAVA_TRAIL_IDS, ""))


def _once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once per row, however often ``then`` refers to it."""
    return F.transform(F.array(value), then)[0]


def clean_name(c: Column | str) -> Column:
    """Name without leading/trailing tax ids and loose edge punctuation; NULL → ``''``."""
    x0 = F.coalesce(col(c), F.lit(""))
    x = _once(strip_leading_ids(x0), strip_trailing_ids)
    x = F.regexp_replace(x, JAVA_LEAD_PUNCT, "")
    x = F.regexp_replace(x, JAVA_TRAIL_PUNCT, "")
    x = F.when(x0.rlike(JAVA_NEEDS_EDGE_STEPS), x).otherwise(x0)
    x = F.regexp_replace(x, JAVA_FIRST_BLANK_RUN, "$1 ")
    return F.btrim(x, F.lit(SPACE_SEPARATORS))


def clean_name_sql(expr: str) -> str:
    """The same cleaning as DuckDB SQL over RE2 (first-match ``regexp_replace``)."""
    p = {k: v.replace("'", "''") for k, v in re2_patterns().items()}
    x = f"coalesce({expr}, '')"
    for k in ("lead_ids", "trail_ids", "lead_punct", "trail_punct"):
        x = f"regexp_replace({x}, '{p[k]}', '')"
    x = f"regexp_replace({x}, '{p['blank_run']}', ' ')"
    return f"trim({x})"


# ---------------------------------------------------------------------------------------------
# Slugs: folded to ASCII, lower case, runs of other characters → '_', no edge '_'.
# One rule for column names (driver) and for text columns (Spark, DuckDB).
# ---------------------------------------------------------------------------------------------
def _fold_rules() -> dict[str, str]:
    """Latin characters (U+00A0–U+024F) by their compatibility decomposition without marks: ``ã`` → ``a``,
    ``º`` → ``o``, ``½`` → ``1⁄2``. Characters that do not decompose (``ß``, ``æ``, ``ø``) stay."""
    rules = {}
    for ch in map(chr, range(0xA0, 0x250)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if plain != ch:
            rules[ch] = plain
    return rules


FOLD_RULES = _fold_rules()
FOLD_LONG = {k: v for k, v in FOLD_RULES.items() if len(v) != 1}
FOLD_FROM = "".join(k for k in FOLD_RULES if k not in FOLD_LONG)
FOLD_TO = "".join(FOLD_RULES[k] for k in FOLD_FROM)
_FOLD_TABLE = str.maketrans(FOLD_RULES)


def fold_text(text: str) -> str:
    """The folding of :func:`fold_accents` for a text that the driver holds (marks that stand alone go)."""
    return "".join(c for c in text.translate(_FOLD_TABLE) if not unicodedata.combining(c))


def slug_text(text: str) -> str:
    """The slug of :func:`slug` for a text that the driver holds."""
    return "_".join(re.findall("[a-z0-9]+", fold_text(text).lower()))


def fold_accents(c: Column | str) -> Column:
    x = col(c)
    for long, plain in FOLD_LONG.items():
        x = F.replace(x, F.lit(long), F.lit(plain))
    return F.regexp_replace(F.translate(x, FOLD_FROM, FOLD_TO), r"\p{M}+", "")


def slug(c: Column | str) -> Column:
    x = F.lower(fold_accents(col(c)))
    x = F.regexp_replace(x, "[^a-z0-9]+", "_")
    return F.regexp_replace(x, "^_+|_+$", "")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fold_sql(expr: str) -> str:
    """DuckDB twin of :func:`fold_accents`."""
    for long, plain in FOLD_LONG.items():
        expr = f"replace({expr}, {_sql_text(long)}, {_sql_text(plain)})"
    return f"regexp_replace(translate({expr}, {_sql_text(FOLD_FROM)}, {_sql_text(FOLD_TO)}), '\\p{{M}}+', '', 'g')"


def slug_sql(expr: str) -> str:
    """DuckDB twin of :func:`slug`."""
    x = f"regexp_replace(lower({fold_sql(expr)}), '[^a-z0-9]+', '_', 'g')"
    return f"regexp_replace({x}, '^_+|_+$', '', 'g')"
