"""Source mixing: temperature weights by bisection, realised as budgeted block permutations.

*Weights.* With ``p`` the token shares of the sources, ``w`` is ``p ** a`` normalised. The exponent
``a`` lies in [0, 1]: 1 keeps the corpus shares, 0 makes all sources equal; entropy falls and the
repetition of small sources falls as ``a`` rises. The operator takes the largest ``a`` whose entropy
reaches ``target_entropy`` times the logarithm of the number of sources, then raises it, if needed,
until no source is repeated more than ``max_repeats`` times (the limit wins over the entropy). Both
searches bisect: each step is one aggregate over the table of sources that tries ``PARTS - 1`` inner
points at once and keeps the part in which the condition turns.

*Realisation.* Source ``s`` gets ``round(w * budget)`` tokens: whole passes over its documents and a
rest. Its documents are dealt by hash into blocks of about ``block_tokens`` tokens, at most
``MAX_BLOCKS`` a source. Every pass is a permutation of the blocks of its own; the last pass takes
blocks in that order while the rest allows, and of the block in which it runs out, in hash order, every
document that still fits. So a source that holds a third of all rows is many blocks, and no task
ever orders more than the blocks of a source or the documents of one block.

Defined results: a null source is a source of its own; rows without a word (or with null text) weigh
nothing and are returned by no partial pass but by every whole one; repeated rows count as often as
they occur; an empty table gives no rows; the words of a very long text are counted in place, none is cut. Columns
other than id, source and text do not matter, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_names, materialise, md5_long

BLOCK_TOKENS = 1 << 16
MAX_BLOCKS = 1 << 16
#: documents of a cut block that one step of the fold looks at: taken keys are copied within a step only
FOLD = 1000
#: each search step tries this many exponents in one aggregate and keeps one of the parts between them
PARTS = 16
STEPS = 9


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _turning_point(low: float, high: float, holds: Callable[[list[float]], list[bool]], keep_low: bool) -> float:
    """Where ``holds`` turns between ``low`` and ``high``; the end on the side named by ``keep_low``."""
    for _ in range(STEPS):
        inner = [low + (high - low) * i / PARTS for i in range(1, PARTS)]
        same_as_low = [h == keep_low for h in holds(inner)]
        k = same_as_low.index(False) if False in same_as_low else PARTS - 1
        low, high = (inner[k - 1] if k else low), (inner[k] if k < PARTS - 1 else high)
    return low if keep_low else high


def mixture_exponent(sources: DataFrame, budget: float | None, target_entropy: float | None,
                     max_repeats: float | None) -> float:
    """The exponent, by bisection over aggregates of ``sources`` (source, tokens, share).

    ``budget`` None stands for the budget at which the least repeated source is read exactly once.
    """
    used = sources.where("tokens > 0")
    n = used.count()
    if n < 2:
        return 1.0

    def entropy_reached(at: list[float]) -> list[bool]:
        w = [F.pow("share", F.lit(a)) for a in at]
        row = used.agg(*[F.sum(x) for x in w], *[F.sum(x * F.ln("share")) for x in w]).first()
        return [math.log(z) - a * s / z >= target_entropy * math.log(n) - 1e-12
                for a, z, s in zip(at, row[:len(at)], row[len(at):], strict=True)]

    def repeats_allowed(at: list[float]) -> list[bool]:
        w = [F.pow("share", F.lit(a)) for a in at]
        per = [x / F.col("tokens") for x in w]
        row = used.agg(*[F.sum(x) for x in w], *[F.min(x) for x in per], *[F.max(x) for x in per]).first()
        z, least, most = (row[i * len(at):(i + 1) * len(at)] for i in range(3))
        return [(m / low if budget is None else m / total * budget) <= max_repeats
                for total, low, m in zip(z, least, most, strict=True)]

    a = 1.0
    if target_entropy is not None and not entropy_reached([1.0])[0]:
        a = _turning_point(0.0, 1.0, entropy_reached, keep_low=True)
    if max_repeats is not None and not repeats_allowed([a])[0]:
        a = _turning_point(a, 1.0, repeats_allowed, keep_low=False)
    return round(a, 6)


def _fitting(cut: DataFrame) -> DataFrame:
    """(s_, key_): the documents of the cut blocks that fit, each tried in hash order; rows of one key go together."""
    units = cut.groupBy("source", "room", "key").agg(F.sum("tokens").alias("size"))
    taken = F.expr(f"""flatten(aggregate(
        transform(sequence(0, (size(units) - 1) div {FOLD}), i -> slice(units, i * {FOLD} + 1, {FOLD})),
        named_struct('used', 0L, 'taken', cast(array() as array<array<bigint>>)),
        (state, part) -> transform(
            array(aggregate(part, named_struct('used', state.used, 'keys', cast(array() as array<bigint>)),
                (s, u) -> if(s.used + u.size <= room, named_struct('used', s.used + u.size, 'keys', concat(s.keys, array(u.key))), s))),
            done -> named_struct('used', done.used, 'taken', concat(state.taken, array(done.keys))))[0],
        state -> state.taken))""")
    return (units.groupBy("source", "room").agg(F.array_sort(F.collect_list(F.struct("key", "size"))).alias("units"))
            .select(F.col("source").alias("s_"), F.explode(taken).alias("key_")))


def mix_sources(docs: DataFrame, budget: int | None = None, target_entropy: float | None = None,
                max_repeats: float | None = None, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """The mixture: doc_id, source, pass (from 0), block, place (of the block in its pass), tokens.

    ``budget`` in tokens; None reads the least repeated source exactly once, so that every document
    with a word is kept.
    """
    rows = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        token_count(F.col(text_col)).alias("tokens"), md5_long(F.col(id_col).cast("string")).alias("key")), "mix-rows")
    totals = materialise(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    sources = totals.withColumn("share", F.col("tokens") / F.lit(max(total, 1)))
    a = mixture_exponent(sources, budget, target_entropy, max_repeats)
    used = sources.where("tokens > 0").withColumn("raw", F.pow("share", F.lit(a)))
    z, most = used.agg(F.sum("raw"), F.max(F.col("tokens") / F.col("raw"))).first()
    size = budget if budget is not None else math.ceil((most or 0) * (z or 0))

    # the table of sources: passes, the rest and the number of blocks
    wanted = F.round(F.col("raw") / F.lit(z or 1.0) * F.lit(float(size))).cast("long")
    if budget is None:  # rounding must not cost the least repeated source its pass
        wanted = F.greatest(wanted, F.col("tokens"))
    plan = materialise(used.withColumn("wanted", wanted).select(
        F.col("source").alias("s"), F.expr("wanted div tokens").alias("passes"),
        F.expr("wanted % tokens").alias("rest"),
        F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("long").alias("n_blocks")), "mix-plan")

    dealt = (rows.join(plan, rows.source.eqNullSafe(plan.s))
             .withColumn("block", F.expr("key % n_blocks")).drop("s", "n_blocks"))
    blocks = dealt.groupBy("source", "block", "passes", "rest").agg(F.sum("tokens").alias("block_size"))
    order = Window.partitionBy("source", "pass").orderBy("turn", "block")
    turns = (blocks.withColumn("pass", F.explode(F.expr("sequence(0L, passes)")))
             .where("pass < passes OR rest > 0")
             .withColumn("turn", md5_long(F.coalesce("source", F.lit("")), F.col("pass").cast("string"),
                                          F.col("block").cast("string")))
             .withColumns({"place": F.row_number().over(order), "upto": F.sum("block_size").over(order)})
             .withColumn("room", F.when(F.col("pass") < F.col("passes"), F.col("block_size"))
                         .otherwise(F.col("rest") - F.col("upto") + F.col("block_size")))
             .where("room > 0")
             .select(F.col("source").alias("s"), F.col("block").alias("b"), "pass", "place", "room",
                     (F.col("room") >= F.col("block_size")).alias("whole")))
    turns = materialise(turns, "mix-turns")
    here = dealt.join(turns, dealt.source.eqNullSafe(turns.s) & (dealt.block == turns.b))
    out = ["doc_id", "source", "pass", "block", "place", "tokens"]
    whole = here.where("whole").select(*out)
    # one block of each source at most is cut: its documents in hash order
    cut = here.where("NOT whole")
    fitting = _fitting(cut)
    cut = cut.join(fitting, cut.source.eqNullSafe(fitting.s_) & (cut.key == fitting.key_), "left_semi")
    cut = cut.select(*out)
    return whole.unionByName(cut)


def mixed_documents(docs: DataFrame, budget: int | None = None, **params) -> DataFrame:
    """The rows of ``docs`` (all columns), each as often as the mixture of ``mix_sources`` has it.

    Without a budget no document goes: those of sources without a word are kept once.
    """
    id_col, source_col = params.get("id_col", "doc_id"), params.get("source_col", "source")
    doc, source, n, copy = free_names(docs, "__id", "__source", "__copies", "__copy")
    copies = (mix_sources(docs, budget, **params).groupBy(F.col("doc_id").alias(doc), F.col("source").alias(source))
              .agg(F.count_distinct("pass").alias(n)))
    keyed = docs.join(copies, docs[id_col].eqNullSafe(copies[doc]) & docs[source_col].cast("string").eqNullSafe(copies[source]),
                      "left" if budget is None else "inner")
    return (keyed.withColumn(copy, F.explode(F.sequence(F.lit(1), F.coalesce(F.col(n).cast("int"), F.lit(1)))))
            .select(*[docs[c] for c in docs.columns]))


def oracle_sql(target_entropy: float, max_repeats: float) -> str:
    """DuckDB SQL of ``mix_sources`` with the corpus's token count as the budget."""
    def hashed(*cols: str) -> str:
        return f"('0x' || substr(md5(concat_ws('|', {', '.join(cols)})), 1, 15))::BIGINT"
    return rf"""
WITH RECURSIVE r AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens,
         {hashed('doc_id::VARCHAR')} AS key FROM documents),
total AS (SELECT sum(tokens)::DOUBLE AS t FROM r),
s AS (SELECT source, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE / greatest(max(t), 1) AS share
      FROM r, total GROUP BY source HAVING sum(tokens) > 0),
entropic AS (
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, false AS done
  UNION ALL
  SELECT i + 1, CASE WHEN h >= goal THEN mid ELSE low END, CASE WHEN h >= goal THEN high ELSE mid END, h1 >= goal OR n < 2
  FROM (SELECT i, low, high, mid, n, {target_entropy} * ln(n) - 1e-12 AS goal,
               (SELECT ln(sum(pow(share, mid))) - mid * sum(pow(share, mid) * ln(share)) / sum(pow(share, mid)) FROM s) AS h,
               (SELECT -sum(share * ln(share)) FROM s) AS h1
        FROM (SELECT *, (low + high) / 2 AS mid, (SELECT count(*) FROM s) AS n FROM entropic WHERE i < 36))),
a1 AS (SELECT CASE WHEN done THEN 1.0 ELSE low END AS a FROM entropic WHERE i = 36),
repeated AS (
  SELECT 0 AS i, a AS low, 1.0::DOUBLE AS high, a AS start FROM a1
  UNION ALL
  SELECT i + 1, CASE WHEN m <= {max_repeats} THEN low ELSE mid END, CASE WHEN m <= {max_repeats} THEN mid ELSE high END, start
  FROM (SELECT *, (SELECT max(pow(share, mid) / tokens) / sum(pow(share, mid)) FROM s) * (SELECT t FROM total) AS m
        FROM (SELECT *, (low + high) / 2 AS mid FROM repeated WHERE i < 36))),
a2 AS (SELECT round(CASE WHEN (SELECT max(pow(share, start) / tokens) / sum(pow(share, start)) FROM s)
                              * (SELECT t FROM total) <= {max_repeats} THEN start ELSE high END, 6) AS a
       FROM repeated WHERE i = 36),
wanted AS (SELECT source, tokens, round(pow(share, a) / (SELECT sum(pow(share, a)) FROM s, a2) * t)::BIGINT AS wanted
           FROM s, a2, total),
plan AS (SELECT source, wanted // tokens AS passes, wanted % tokens AS rest,
                least({MAX_BLOCKS}, ceil(tokens / {BLOCK_TOKENS}))::BIGINT AS n_blocks FROM wanted),
dealt AS (SELECT r.*, key % n_blocks AS block, passes, rest FROM r JOIN plan ON r.source IS NOT DISTINCT FROM plan.source),
blocks AS (SELECT source, block, passes, rest, sum(tokens)::BIGINT AS block_size FROM dealt GROUP BY ALL),
turns AS (
  SELECT *, row_number() OVER w AS place, sum(block_size) OVER w AS upto
  FROM (SELECT *, {hashed("coalesce(source, '')", 'pass::VARCHAR', 'block::VARCHAR')} AS turn
        FROM (SELECT *, unnest(range(passes + 1)) AS pass FROM blocks) WHERE pass < passes OR rest > 0)
  WINDOW w AS (PARTITION BY source, pass ORDER BY turn, block)),
rooms AS (SELECT source, block, pass, place, block_size,
                 CASE WHEN pass < passes THEN block_size ELSE rest - upto + block_size END AS room FROM turns),
picked AS (
  SELECT d.doc_id, d.source, t.pass, d.block, t.place, d.tokens, d.key, t.room, t.room >= t.block_size AS whole
  FROM dealt d JOIN rooms t ON d.source IS NOT DISTINCT FROM t.source AND d.block = t.block WHERE t.room > 0),
units AS (SELECT source, room, key, sum(tokens)::BIGINT AS size, row_number() OVER (PARTITION BY source ORDER BY key) AS nth
          FROM picked WHERE NOT whole GROUP BY source, room, key),
tried AS (
  SELECT DISTINCT source, 0::BIGINT AS nth, 0::BIGINT AS used, NULL::BIGINT AS key, false AS fits FROM units
  UNION ALL
  SELECT u.source, u.nth, CASE WHEN t.used + u.size <= u.room THEN t.used + u.size ELSE t.used END, u.key, t.used + u.size <= u.room
  FROM tried t JOIN units u ON t.source IS NOT DISTINCT FROM u.source AND u.nth = t.nth + 1)
SELECT doc_id, source, pass, block, place::INTEGER AS place, tokens FROM picked WHERE whole
UNION ALL
SELECT p.doc_id, p.source, p.pass, p.block, p.place::INTEGER, p.tokens
FROM picked p JOIN tried t ON p.source IS NOT DISTINCT FROM t.source AND p.key = t.key WHERE NOT p.whole AND t.fits"""
