"""Joins of the registry: sites with companies and tax regime, and the code lookups.

Two strategies, chosen per input:

* **Lookups** (municipalities, activities, …) are code tables. They are broadcast only after a
  bounded count proves them small in rows and bytes; above the bounds the join is left to the
  planner (sort-merge with AQE).
* **Company-level tables** (companies, tax regime) meet the site table on ``cnpj_basico``. All of
  them are large, so they shuffle on that key, and consecutive joins reuse one partitioning.
  A single company may own a large share of all sites; such *hot* keys are found with a
  partially-aggregated count. Their site rows are not shuffled: the few company rows that match hot
  keys are joined to them by a checked broadcast. Rows without a key match nothing and are not
  shuffled either. The remaining keys take the plain shuffle join. Results are identical to a plain
  join; nothing is dropped or sampled.
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import try_int

# Bounds under which a table is broadcast.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20

_small_cache: "weakref.WeakKeyDictionary[DataFrame, dict[tuple[int, int], bool]]" = weakref.WeakKeyDictionary()


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of text. Costs one bounded
    job, memoised per DataFrame and bounds."""
    known = _small_cache.setdefault(df, {})
    if (max_rows, max_bytes) not in known:
        width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
        rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
        known[max_rows, max_bytes] = rows <= max_rows and (size or 0) <= max_bytes
    return known[max_rows, max_bytes]


def lookup_join(df: DataFrame, lookup: DataFrame, code: Column | str, how: str = "left",
                prefix: str = "lk", lookup_code: str = "codigo",
                columns: Sequence[str] = ("codigo", "descricao")) -> DataFrame:
    """Join a code lookup on lenient integer codes (``TRY_CAST`` on both sides).

    The lookup's columns come out as ``{prefix}_codigo`` / ``{prefix}_descricao``.
    """
    small = is_small(lookup)
    lk = lookup.select(*[F.col(c).alias(f"{prefix}_{c}") for c in columns])
    lk = lk.withColumn(f"_{prefix}_key", try_int(f"{prefix}_{lookup_code}"))
    if small:
        lk = F.broadcast(lk)
    code_col = F.col(code) if isinstance(code, str) else code
    out = df.join(lk, try_int(code_col) == F.col(f"_{prefix}_key"), how)
    return out.drop(f"_{prefix}_key")


# ---------------------------------------------------------------------------------------------
# fact ⋈ company-level tables, with hot-key splitting
# ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class SkewPolicy:
    hot_rows: int = 1_000_000      # a key with more fact rows than this is hot
    enabled: bool = True


DEFAULT_SKEW = SkewPolicy()


def hot_keys(fact: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys holding more than ``hot_rows`` fact rows (partial aggregation before the shuffle).
    At most ``rows / hot_rows`` keys come out. Rows without a key have none that could be hot."""
    return (fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > F.lit(hot_rows)).select(key))


def _chain(left: DataFrame, dims: Sequence[tuple[DataFrame, str]], on: str) -> DataFrame:
    out = left
    for dim, how in dims:
        out = out.join(dim, on, how)
    return out


def _unmatched(rows: DataFrame, dims: Sequence[tuple[DataFrame, str]], key: str) -> DataFrame:
    """``rows`` as a left join leaves them when nothing matches."""
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for dim, _ in dims for f in dim.schema.fields if f.name != key]
    return rows.select(key, *[c for c in rows.columns if c != key], *blank)


def fact_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], key: str = "cnpj_basico",
              skew: SkewPolicy = DEFAULT_SKEW, bound: int | None = None,
              hot: DataFrame | None = None) -> DataFrame:
    """``fact`` joined with each ``(dim, how)`` on ``key`` (USING semantics, one key column).

    ``how`` is ``inner`` or ``left`` (fact side preserved). Dimension rows are expected to be
    few per key; any number works, duplicates multiply rows as in a plain join.

    Plan: the union of three disjoint parts of the fact. Ordinary keys: plain joins on ``key``, one
    shuffle per input. Hot keys: their fact rows stay where they are and meet the dimension rows of
    the hot keys by broadcast (if a count proves those small; else by a join that AQE can split). No key: kept
    as unmatched when every join is a left one.

    ``bound``: a proven upper bound on the fact's row count; at or below ``hot_rows`` no key can
    be hot and the plain joins are used (the planner may then broadcast small dimensions).
    ``hot``: precomputed hot keys (any superset of the fact's hot keys is correct).
    """
    if not skew.enabled or not dims or (bound is not None and bound <= skew.hot_rows):
        return _chain(fact, dims, key)
    hot = (hot if hot is not None else hot_keys(fact, key, skew.hot_rows)).select(key).distinct()
    if is_small(hot):
        hot = F.broadcast(hot)
    cold = fact.where(F.col(key).isNotNull()).join(hot, key, "left_anti")
    few = []
    for dim, how in dims:
        rows = dim.join(hot, key, "left_semi")
        few.append((F.broadcast(rows) if is_small(rows) else rows, how))
    out = _chain(cold, dims, key).unionByName(_chain(fact.join(hot, key, "left_semi"), few, key))
    if all(how == "left" for _, how in dims):
        out = out.unionByName(_unmatched(fact.where(F.col(key).isNull()), dims, key))
    return out
