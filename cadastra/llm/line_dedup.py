"""Line de-duplication: a suffix array over line ids, built by distributed prefix doubling.

Every line of every document has an id (a 128-bit hash). Ranks order the suffixes of these sequences
by their first line, then by their first 2, 4, 8, ... lines: each round pairs a suffix's rank with the
rank 2**k lines further on, sorts the distinct pairs by range partitions and numbers them in order.
Suffixes whose rank nobody shares are in place and leave; so only repeated lines are ever ranked, and
each distinct pair is counted before it is shuffled, however often it occurs. Doubling ends when every
rank is single.

The ranks are then read from the longest to the shortest. Suffixes that agree on their first m lines are
an interval of the suffix array; asking each for the rank of the next 2**k lines splits the interval into
those that agree on m + 2**k lines. In each part the earliest occurrence (document, then place) stays in
the interval that was split, for the shorter ranks to come, and stands in the part as its witness; the
others go on in the part, m + 2**k lines long. One earliest occurrence answers for its whole part, as
whoever is left behind disagrees with all of it within these 2**k lines. An interval thus holds at most
one witness, and a suffix ends with the length of its longest common prefix with any earlier suffix.
Such a run is maximal if the suffix one line before does not cover it; the lines of maximal runs of at
least ``min_chars`` characters are deleted, so of every repeated run the earliest copy stays.

Frequent groups (a blank line, a passage in a third of the rows) are aggregated before they are shuffled
and meet their rows by a broadcast of the at most ``HOT_GROUPS`` groups that hold more than that share.

Defined results: null text stays null; a document may become empty; rows equal in id and text are one
document (both get the same result); a null id counts as the smallest; ties between equal ids are
ordered by a hash of the text; runs that overlap their own first copy lose the overlap as well; a very
long text is as many rows as it has lines, and only its spans are gathered; an empty table gives no rows;
other columns are kept as they are (``n_lines`` and ``n_deleted`` are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.session import written

from .common import free_names, materialise, ordered_ids

MIN_CHARS = 40
#: groups with more than the total divided by this many rows are broadcast; there can be no more of them
HOT_GROUPS = 1024
_DOC = ["doc", "tie"]
_NO_ID = -(1 << 63)


def _key(id_col: str, text_col: str) -> list[Column]:
    """What tells documents apart: the id (a number for null) and a hash of the text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)), F.xxhash64(F.col(text_col))]


def meet(rows: DataFrame, groups: DataFrame, keys: list[str], total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with their group (``n``: rows in it, ``total`` in all), frequent groups by broadcast."""
    frequent = F.col("n") > total // HOT_GROUPS  # at most HOT_GROUPS groups, as their rows add up to ``total``
    hot = F.broadcast(groups.where(frequent))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(groups.where(~frequent), keys, how)
    return rows.join(hot, keys).unionByName(rest).drop("n")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tie, pos, rank) of every line that occurs more than once; rank orders the line ids."""
    lines = (docs.where(F.col(text_col).isNotNull())
             .select(*[k.alias(c) for k, c in zip(_key(id_col, text_col), _DOC)],
                     F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "line"))
             .select(*_DOC, "pos", F.xxhash64("line").alias("id1"), F.xxhash64(F.lit("line"), "line").alias("id2")))
    lines, total = written(lines, "lines")
    shared = lines.groupBy("id1", "id2").agg(F.count("*").alias("n")).where("n > 1")
    names = ordered_ids(shared, ["id1", "id2"], "line-ranks", "rank")
    return materialise(meet(lines, names, ["id1", "id2"], total).select(*_DOC, "pos", "rank")
                       .dropDuplicates([*_DOC, "pos"]), "line-level")


def doubled(level: DataFrame, step: int) -> tuple[DataFrame, int]:
    """Ranks by twice as many lines (``step`` so far) of the suffixes that share theirs, and their number."""
    ahead = Window.partitionBy(*_DOC).orderBy("pos")
    # the row ``step`` lines further on, if its line is ranked; positions have gaps, hence the range frame
    there = ahead.rangeBetween(step, step)
    pairs, total = written(level.select(*_DOC, "pos", "rank", F.max("rank").over(there).alias("next"))
                           .where("next IS NOT NULL"), "line-pairs")
    shared = pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1")
    names = ordered_ids(shared, ["rank", "next"], "line-ranks", "new")
    return written(meet(pairs, names, ["rank", "next"], total).select(*_DOC, "pos", F.col("new").alias("rank")), "line-level")


def suffix_levels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[DataFrame]:
    """The shared ranks (doc, tie, pos, rank) by 1, 2, 4, ... lines, until every rank is single."""
    levels = [repeated_lines(docs, id_col, text_col)]
    while True:
        level, n = doubled(levels[-1], 1 << (len(levels) - 1))
        if not n:
            return levels
        levels.append(level)


def longest_earlier(levels: list[DataFrame]) -> DataFrame:
    """(doc, tie, pos, lines): the longest run from each place that also occurs earlier, if there is one."""
    every = levels[0].withColumn("k", F.lit(0))
    for k, level in enumerate(levels[1:], 1):
        every = every.unionByName(level.withColumn("k", F.lit(k)))
    # a suffix enters at its longest shared rank: it has no answer to the longer ones
    entry = materialise(every.groupBy(*_DOC, "pos").agg(F.max(F.struct("k", "rank")).alias("top")), "line-entry")
    place = F.struct(*_DOC, "pos")
    interval = ["level", "id"]  # of the suffixes that agree on ``lines`` lines; (-1, 0) holds all
    state = None
    for k in range(len(levels) - 1, -1, -1):
        asked = (entry.where(F.col("top.k") == k)
                 .select(*_DOC, "pos", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("id"), F.lit(0).alias("lines"),
                         F.lit(True).alias("own"), F.col("top.rank").alias("rank")))
        if state is not None:
            there = levels[k].select(*_DOC, F.col("pos").alias("at"), "rank")
            asked = asked.unionByName(state.withColumn("at", F.col("pos") + F.col("lines"))
                                      .join(there, [*_DOC, "at"], "left").drop("at"))
        asked, total = written(asked, "line-asked")
        parts = (asked.where("rank IS NOT NULL").groupBy(*interval, "rank")
                 .agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1")
                 .withColumn("part", F.monotonically_increasing_id()))
        parts = materialise(parts, "line-parts")
        met = meet(asked.where("rank IS NOT NULL"), parts, [*interval, "rank"], total, "left")

        def row(level, ident, lines, own):  # noqa: ANN001
            return F.struct(level.alias("level"), ident.alias("id"), lines.alias("lines"), own.alias("own"))

        stays = row(F.col("level"), F.col("id"), F.col("lines"), F.col("own"))
        longer = (F.lit(k), F.col("part"), F.col("lines") + (1 << k))
        moved = (F.when(F.col("part").isNull(), F.array(stays))
                 .when(place == F.col("kept"), F.array(stays, row(*longer, F.lit(False))))  # the witness
                 .otherwise(F.array(row(*longer, F.col("own")))))
        state = (met.select(*_DOC, "pos", F.explode(moved).alias("to")).select(*_DOC, "pos", "to.*")
                 .unionByName(asked.where("rank IS NULL").drop("rank")))
    return state.where("own AND lines > 0").select(*_DOC, "pos", "lines")


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tie, pos, lines): the maximal runs of lines that are later copies, of any number of characters."""
    runs = longest_earlier(suffix_levels(docs, id_col, text_col))
    before = Window.partitionBy(*_DOC).orderBy("pos")
    covered = (F.lag("pos").over(before) == F.col("pos") - 1) & (F.lag("lines").over(before) > F.col("lines"))
    return (runs.withColumn("covered", F.coalesce(covered, F.lit(False))).where("NOT covered").drop("covered"))


def _inside(lines: list[str], runs: list[dict], min_chars: int) -> set[int]:
    """The places that lie in one of the ``runs`` of at least ``min_chars`` characters."""
    upto = [0, *accumulate(map(len, lines))]
    inside, done = set(), 0
    for run in sorted(runs, key=lambda r: r["pos"]):  # maximal runs end in the order in which they begin
        end = run["pos"] + run["lines"]
        if upto[end] - upto[run["pos"]] >= min_chars:
            inside.update(range(max(done, run["pos"]), end))
            done = end
    return inside


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the later copies of repeated line runs, with ``n_lines`` and ``n_deleted``.

    Columns of these names that ``docs`` already has are replaced.
    """
    docs = docs.drop("n_lines", "n_deleted")
    spans = later_copies(docs, id_col, text_col).groupBy(*_DOC).agg(F.collect_list(F.struct("pos", "lines")).alias("runs"))
    doc, tie, runs_col = free_names(docs, "__doc", "__tie", "__runs")
    found = materialise(spans.toDF(doc, tie, runs_col), "line-runs")
    joined = (docs.withColumns(dict(zip((doc, tie), _key(id_col, text_col)))).join(found, [doc, tie], "left").drop(doc, tie))
    names = docs.columns
    n = len(names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", n_lines long, n_deleted long"
    at = names.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, total, gone = [], [], []
            for text, runs in zip(b.column(at).to_pylist(), b.column(n).to_pylist()):
                lines = text.split("\n") if text is not None else []
                drop = _inside(lines, runs or (), min_chars)
                total.append(len(lines))
                gone.append(len(drop))
                if drop:
                    text = "\n".join([x for i, x in enumerate(lines) if i not in drop])
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             names=[*names, "n_lines", "n_deleted"])

    return joined.mapInArrow(cut, schema)


def oracle_sql(min_chars: int = MIN_CHARS) -> str:
    """DuckDB SQL of the op5 query (document ids are unique there)."""
    return rf"""
WITH doc AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM doc),
sums AS (SELECT *, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto,
                sum(length(line)) OVER (PARTITION BY doc_id ORDER BY pos) - length(line) AS before FROM line),
forth AS (SELECT a.doc_id, a.pos, min(b.pos) AS last FROM sums a JOIN sums b
          ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.before >= {min_chars} GROUP BY ALL),
back AS (SELECT b.doc_id, max(a.pos) AS pos, b.pos AS last FROM sums b JOIN sums a
         ON a.doc_id = b.doc_id AND a.pos <= b.pos AND b.upto - a.before >= {min_chars} GROUP BY b.doc_id, b.pos),
run AS (SELECT r.doc_id, r.pos, r.last, array_to_string(lines[r.pos:r.last], chr(10)) AS txt
        FROM (SELECT * FROM forth UNION SELECT doc_id, pos, last FROM back) r JOIN doc USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY txt, last - pos ORDER BY doc_id, pos) AS nth FROM run),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, last + 1)) AS pos FROM ranked WHERE nth > 1),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE g.pos IS NULL) AS txt,
                count(*) AS n_lines, count(g.pos) AS n_deleted
         FROM line LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(txt, '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted
FROM documents d LEFT JOIN kept USING (doc_id)"""
