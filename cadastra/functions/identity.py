"""CNPJ identifiers as Column expressions: key, digits, split, mask and check digits.

A CNPJ is ``basico`` (8 digits, the company) + ``ordem`` (4, the site) + ``dv`` (2 check digits).
The check is pure arithmetic on substrings, so it stays inside whole-stage codegen (no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import col

# ---------------------------------------------------------------------------------------------
# CNPJ check-digit weights (first digit over 12 digits, second over 13).
# ---------------------------------------------------------------------------------------------
DV1_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
DV2_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def cnpj_key(basico: Column | str = "cnpj_basico", ordem: Column | str = "cnpj_ordem",
             dv: Column | str = "cnpj_dv") -> Column:
    """14-character key; NULL when any part is NULL."""
    return F.concat(col(basico), col(ordem), col(dv))


def only_digits(c: Column | str) -> Column:
    """Digits of a text, NULL → ``''``."""
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^0-9]", "")


def cnpj_split(digits: Column | str) -> tuple[Column, Column, Column]:
    d = col(digits)
    return F.substring(d, 1, 8), F.substring(d, 9, 4), F.substring(d, 13, 2)


def cnpj_mask(basico: Column | str, ordem: Column | str, dv: Column | str) -> Column:
    """``basico.ordem/dv``, the way the per-CNPJ report prints a key."""
    return F.concat(col(basico), F.lit("."), col(ordem), F.lit("/"), col(dv))


def cnpj_format(digits: Column | str) -> Column:
    """Conventional ``NN.NNN.NNN/NNNN-NN`` display of 14 digits."""
    d = col(digits)
    return F.concat(F.substring(d, 1, 2), F.lit("."), F.substring(d, 3, 3), F.lit("."),
                    F.substring(d, 6, 3), F.lit("/"), F.substring(d, 9, 4), F.lit("-"),
                    F.substring(d, 13, 2))


def _check_digit(d: Column, weights: tuple[int, ...]) -> Column:
    total = None
    for i, w in enumerate(weights, start=1):
        term = F.substring(d, i, 1).cast("int") * F.lit(w)
        total = term if total is None else total + term
    r = total % 11
    return F.when(r < 2, F.lit(0)).otherwise(F.lit(11) - r)


def cnpj_is_valid(c: Column | str) -> Column:
    """True when the text holds 14 digits, not all equal, whose check digits agree."""
    return digits_are_valid_cnpj(only_digits(c))


def digits_are_valid_cnpj(d: Column) -> Column:
    """:func:`cnpj_is_valid` for a column that already holds only digits. Pass a column
    reference (a projected digits column): the test reads it about thirty times."""
    ok_shape = (F.length(d) == 14) & (d != F.repeat(F.substring(d, 1, 1), 14))
    dv1 = _check_digit(d, DV1_WEIGHTS)
    dv2 = _check_digit(d, DV2_WEIGHTS)
    dv_text = F.concat(dv1.cast("string"), dv2.cast("string"))
    # the arithmetic only runs on 14-digit inputs (CASE short-circuits), so casts never see junk
    return F.when(ok_shape, F.substring(d, 13, 2) == dv_text).otherwise(F.lit(False))
