"""N-gram Jaccard join with adaptive multi-match prefixes; connected components of its links.

A document's set holds its distinct five-word shingles as 64-bit hashes. With sets of sizes ``n``, two
documents link when ``100 * |x & y| >= percent * |x | y|``; then ``|x & y|`` is at least
``o = ceil(percent * n / 100)`` for either. In any common order of shingles, linked documents share at
least ``l`` of their first ``n - o + l`` ones (multi-match prefixes, Wang et al. 2012): a longer
prefix costs more look-ups but asks for more matches before a pair is verified.

1. *Sets.* One pass writes size, digest and the lowest hashes of each set. Equal sets are one class;
   only its first row goes on, so groups of exact copies cost one document.
2. *Order.* By hash, but shingles that occur in more than ``FREQUENT`` prefixes come last: they would
   name many pairs. Documents whose stored hashes do not hold enough rare ones (they consist of
   frequent shingles) are read again as whole sets, and what is frequent among those joins the list.
3. *Prefixes.* Per document, the running sum of the lists behind its shingles estimates the cost of
   each ``l``: scanning them plus verifying the candidates, which must occur ``l`` times among them.
   The cheapest ``l`` up to ``LONGEST`` is taken.
4. *Stars.* In each list every document is paired with one leader only, as many pairs as entries.
   Pairs that share much are verified; groups of near copies grow together here.
5. *Rest.* Lists that still hold several components give the pairs across them. A pair with ``m``
   shared prefix shingles has at most ``m + max(o - l)`` in common; pairs that cannot reach the
   overlap their sizes ask for go, all others are verified on whole sets. Most go before they are
   formed: by the places of a shared shingle in both orders, and because a document shares no more
   shingles than it has entries left.

No pair that could link is dropped: stars only decide what is already connected. Pairs are verified in
cells: documents of a group of pairs are hashed into blocks, a cell holds the pairs of two blocks and
the sets of their documents once, so a large group travels as blocks, not once per pair. Hot shingles
are counted before they are shuffled, and joins on them are plain joins that can be split.

Defined results: null text is empty; a document without words has an empty set and links with nothing;
one with fewer than five words has one shingle; rows that repeat are classes of equal sets; the
component id is the smallest doc_id of the component, nulls aside; an empty table gives no rows; the set of a
very long text is one row of a task. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions
from .components import component_roots
from .shingles import shingle_hashes, word_hashes

PERCENT = 80
FREQUENT = 32
LONGEST = 8
#: cost of verifying a candidate, in list entries
VERIFY_COST = 16
#: documents of one block of a cell
BLOCK = 256
#: rows (of a list: entries) up to which a table of wanted documents is broadcast; beyond, both sides shuffle
SMALL_ROWS = 200_000
#: shingles up to which the frequent ones, a number each, are broadcast
SMALL_TOKENS = 1_000_000


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text, as signed numbers."""
    return np.unique(shingle_hashes(word_hashes(text or "", lower=True)).view(np.int64))


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _overlap(n, percent: int):
    return -(-n * percent // 100)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def _sets(rows: DataFrame, percent: int) -> DataFrame:
    """(row, doc_id, tie, n, digest, stored, low): low holds the prefix of the longest ``l`` and some spare hashes."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t) for t in b.column("text").to_pylist()]
            n = [len(s) for s in sets]
            low = [s[:k - _overlap(k, percent) + LONGEST + k // 16 + 4] for s, k in zip(sets, n)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tie"), pa.array(n, pa.int64()),
                                              pa.array([_digest(s) for s in sets], pa.binary()),
                                              pa.array(map(len, low), pa.int64()), _lists(low)],
                                             names=["doc_id", "tie", "n", "digest", "stored", "low"])

    made = rows.mapInArrow(compute, "doc_id long, tie long, n long, digest binary, stored long, low array<long>")
    return materialise(made.withColumn("row", F.monotonically_increasing_id()), "jaccard-sets")


def _whole_sets(rows: DataFrame, wanted: DataFrame, lists: str | None = None) -> DataFrame:
    """(row, set) of the ``wanted`` (row, doc_id, tie, digest), from the texts, with their column ``lists`` if named.

    Rows that repeat under one id give the same set several times.
    """
    extra = [lists] if lists else []
    few = (wanted.select(F.explode(lists)) if lists else wanted).limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    side = F.broadcast(wanted) if few else wanted
    found = (rows.join(side, rows.doc_id.eqNullSafe(wanted.doc_id) & (rows.tie == wanted.tie))
             .select("text", "row", "digest", *extra))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, sets = [], []
            for i, (text, digest) in enumerate(zip(*(b.column(c).to_pylist() for c in ("text", "digest")))):
                s = shingle_set(text)
                if _digest(s) == digest:  # texts that share an id and a hash differ in their sets
                    keep.append(i)
                    sets.append(s)
            if keep:
                kept = b.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([kept.column("row"), _lists(sets), *map(kept.column, extra)],
                                                 names=["row", "set", *extra])

    kinds = dict(wanted.dtypes)
    return found.mapInArrow(compute, ", ".join(["row long, set array<long>", *(f"{c} {kinds[c]}" for c in extra)]))


def verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (x, y, g): counted on whole sets, in cells of blocks of a group ``g``."""
    # only groups beyond one block are looked up: with a pair for each of their documents, one for BLOCK pairs at most
    blocks = materialise(pairs.groupBy("g").agg(*[F.ceil(F.approx_count_distinct(c) / BLOCK).alias(f"{c}_blocks") for c in "xy"])
                         .where("x_blocks > 1 OR y_blocks > 1"), "jaccard-blocks")
    few = blocks.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    at = lambda c: F.coalesce(F.col(f"{c}_blocks"), F.lit(1))
    cell = F.xxhash64("g", *[F.pmod(F.xxhash64(F.lit(c), c), at(c)) for c in "xy"])
    placed = materialise(pairs.join(F.broadcast(blocks) if few else blocks, "g", "left").select(cell.alias("cell"), "x", "y"),
                         "jaccard-cells")
    # each wanted text is read once, and its set goes straight to the cells that hold it
    members = placed.select("cell", F.col("x").alias("row")).unionByName(placed.select("cell", F.col("y").alias("row")))
    cells = members.groupBy("row").agg(F.collect_set("cell").alias("cells"))
    wanted = materialise(classes.select("row", "doc_id", "tie", "digest").join(cells, "row"), "jaccard-wanted")
    sets = _whole_sets(rows, wanted, "cells")
    empty = F.lit(None).cast("array<long>")
    n = shuffle_partitions(pairs.sparkSession)
    dealt = (sets.select(F.explode("cells").alias("cell"), F.col("row").alias("x"), F.lit(None).cast("long").alias("y"), "set")
             .unionByName(placed.select("cell", "x", "y", empty.alias("set")))
             .repartition(n, "cell").sortWithinPartitions("cell", F.col("y").asc_nulls_first()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, known = None, {}
        for b in batches:
            xs, ys = [], []
            sets = b.column("set")
            offsets, values = sets.offsets.to_numpy(), sets.values.to_numpy(zero_copy_only=False)
            for i, (c, x, y) in enumerate(zip(*(b.column(k).to_pylist() for k in ("cell", "x", "y")))):
                if c != here:
                    here, known = c, {}
                if y is None:
                    known[x] = values[offsets[i]:offsets[i + 1]].copy()
                else:
                    common = len(np.intersect1d(known[x], known[y], assume_unique=True))
                    if 100 * common >= percent * (len(known[x]) + len(known[y]) - common):
                        xs.append(x)
                        ys.append(y)
            if xs:
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])

    return materialise(dealt.mapInArrow(count, "x long, y long"), "jaccard-links")


def _postings(classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """(token, row, pos, n): the prefixes of the longest ``l`` in the common order, unique tokens left out.

    Unique is what no other prefix can hold: stored hashes and whole sets count.
    """
    low = classes.select("row", F.posexplode("low").alias("at", "token"))
    sizes = classes.select("row", "n", "stored")
    shared = materialise(low.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"), "jaccard-counts")
    need = F.least(F.col("n"), F.col("n") - overlap(F.col("n"), percent) + LONGEST)

    def frequent_at(tokens: DataFrame) -> DataFrame:
        """(row, frequent): how many of the few ``tokens`` each class has stored."""
        few = tokens.limit(SMALL_TOKENS + 1).count() <= SMALL_TOKENS
        return low.join(F.broadcast(tokens) if few else tokens, "token").groupBy("row").agg(F.count("*").alias("frequent"))

    def short_of_rare(tokens: DataFrame) -> DataFrame:
        """Classes whose stored hashes hold fewer rare ones than their longest prefix needs."""
        f = frequent_at(tokens).join(sizes, "row")
        return f.where((F.col("stored") - F.col("frequent") < need) & (F.col("stored") < F.col("n"))).select("row")

    first = materialise(shared.where(F.col("c") > FREQUENT).select("token"), "jaccard-frequent")
    deep = materialise(short_of_rare(first), "jaccard-deep")
    info = classes.select("row", "doc_id", "tie", "digest")
    whole_sets = lambda some: materialise(
        _whole_sets(rows, info.join(some, "row")).dropDuplicates(["row"]), "jaccard-whole")
    whole = whole_sets(deep)
    second = (whole.select(F.explode("set").alias("token")).groupBy("token").agg(F.count("*").alias("c"))
              .where(F.col("c") > FREQUENT).select("token"))
    frequent = materialise(first.unionByName(second).distinct(), "jaccard-frequent")
    deeper = materialise(short_of_rare(frequent).join(deep, "row", "left_anti"), "jaccard-deep")
    if not deeper.isEmpty():
        whole = whole.unionByName(whole_sets(deeper))
        deep = deep.unionByName(deeper)
    frequent = frequent.withColumn("last", F.lit(1))

    by_row = Window.partitionBy("row")
    read = materialise(whole.select("row", F.explode("set").alias("token")).join(frequent, "token", "left")
                       .withColumn("last", F.coalesce("last", F.lit(0)))
                       .withColumn("pos", F.row_number().over(by_row.orderBy("last", "token")) - 1)
                       .join(sizes, "row").where(F.col("pos") < need).select("token", "row", "pos", "n"), "jaccard-read")
    # a stored shingle that no other stored part holds may be in a prefix read from a whole set
    marks = materialise(shared.select("token", F.lit(0).alias("last")).unionByName(frequent)
                        .unionByName(read.select("token", F.lit(0).alias("last")).distinct())
                        .groupBy("token").agg(F.max("last").alias("last")), "jaccard-marks")
    marked = materialise(low.join(marks.hint("shuffle_hash"), "token"), "jaccard-entries").join(sizes, "row")

    so_far = F.sum("last").over(by_row.orderBy("at"))
    # rare hashes move up past the frequent ones before them; those follow at the end
    rare = (marked.join(deep, "row", "left_anti")
            .withColumn("pos", F.when(F.col("last") == 0, F.col("at") - so_far)
                        .otherwise(F.col("stored") - F.sum("last").over(by_row) + so_far - 1))
            .where(F.col("pos") < need).select("token", "row", "pos", "n"))
    entries = materialise(rare.unionByName(read), "jaccard-prefixes")
    lists = entries.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    return entries.join(lists, "token")


def overlap(n: Column, percent: int) -> Column:
    """The least overlap of a set of ``n`` shingles with any that it links with."""
    return F.floor((n * percent + 99) / 100)


def _adaptive(postings: DataFrame, percent: int) -> DataFrame:
    """(token, row, n, l, pos): the prefix of each document at its cheapest ``l``."""
    o = overlap(F.col("n"), percent)
    steps = [k for k in (1, 2, 4, 8) if k <= LONGEST]
    sums = postings.groupBy("row", "n").agg(*[
        F.sum(F.when(F.col("pos") < F.col("n") - o + k, F.col("c") - 1).otherwise(0)).alias(f"s{k}") for k in steps])
    cost = F.array_sort(F.array(*[F.struct((F.col(f"s{k}") * (1 + VERIFY_COST / k)).alias("cost"), F.lit(k).alias("l"))
                                  for k in steps]))
    chosen = sums.select("row", F.least(cost[0]["l"].cast("long"), o).alias("l"))
    return (postings.join(chosen, "row").where(F.col("pos") < F.col("n") - o + F.col("l"))
            .select("token", "row", "n", "l", "pos"))


def linked_components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, tie (a hash of the text), n_shingles, component_id, first.

    ``first`` marks the row that stands for its component (smallest doc_id, then tie).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"),
                       F.col(text_col).alias("text"))
    sets = _sets(rows, percent)
    narrow = sets.select("row", "doc_id", "tie", "n", "digest")
    firsts = (narrow.where("n > 0").groupBy("digest", "n")
              .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("first"),
                   F.count("*").alias("copies")))
    copies = materialise(firsts.where("copies > 1").select("digest", "n", F.col("first.row").alias("first")), "jaccard-copies")
    copied = materialise(narrow.join(copies, ["digest", "n"]).where("row <> first").select("row", "first"), "jaccard-copied")
    classes = sets.where("n > 0").join(copied.select("row"), "row", "left_anti")

    prefixes = materialise(_adaptive(_postings(classes, rows, percent), percent), "jaccard-adaptive")
    o = lambda s: overlap(F.col(f"n_{s}"), percent)
    least_common = F.ceil((F.col("n_x") + F.col("n_y")) * percent / (100 + percent))
    need = F.greatest(F.lit(1), least_common - F.greatest(o("x") - F.col("l_x"), o("y") - F.col("l_y")))
    # at a shared shingle: what can lie before and after it in both orders must reach the overlap
    near = (((F.least("n_x", "n_y") * 100) >= (F.greatest("n_x", "n_y") * percent))
            & (F.least("pos_x", "pos_y") + F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y")) >= least_common))
    side = lambda s: prefixes.select("token", *[F.col(c).alias(f"{d}_{s}" if d else s) for c, d in
                                                (("row", ""), ("n", "n"), ("l", "l"), ("pos", "pos"))])
    keys = ["x", "y", "n_x", "n_y", "l_x", "l_y"]

    # stars: each entry with its list's leader, the document that shares most: the middle of a group of copies
    held = prefixes.withColumn("held", F.count("*").over(Window.partitionBy("row")))
    leader = (held.groupBy("token").agg(F.min(F.struct((-F.col("held")).alias("turn"), F.col("row").alias("x"),
                                                           F.col("n").alias("n_x"), F.col("l").alias("l_x"),
                                                           F.col("pos").alias("pos_x"))).alias("z"),
                                            F.count("*").alias("c")).where("c > 1").select("token", "z.x", "z.n_x", "z.l_x", "z.pos_x"))
    stars = (side("y").join(leader, "token").where((F.col("x") != F.col("y")) & near)
             .groupBy(*keys).agg(F.count("*").alias("m")).where(F.col("m") * 2 >= need)
             .select("x", "y", F.col("x").alias("g")))
    links = verified(materialise(stars, "jaccard-stars"), classes, rows, percent)
    roots = component_roots(links)

    # the rest: pairs across the components that a list still holds
    placed = (prefixes.join(roots.withColumnRenamed("node", "row"), "row", "left")
              .withColumn("root", F.coalesce("root", "row")))
    mixed = placed.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("token")
    placed = placed.join(mixed, "token")
    # at most the entries that a document still has, and those from its first one to its prefix's end, are shared
    own = Window.partitionBy("row")
    placed = materialise(placed.withColumns({"left": F.count("*").over(own), "start": F.min("pos").over(own)}), "jaccard-mixed")
    half = lambda s: placed.select("token", F.col("row").alias(s),
                                   *[F.col(c).alias(f"{c}_{s}") for c in ("n", "l", "root", "pos", "left", "start")])
    # both prefixes at the smaller of the two lengths
    both_l = F.least("l_x", "l_y")
    end = lambda s: F.col(f"n_{s}") - o(s) + both_l
    need = F.greatest(F.lit(1), least_common - F.greatest(o("x"), o("y")) + both_l)
    room = F.least("left_x", "left_y", end("x") - F.col("start_x"), end("y") - F.col("start_y"))
    across = (half("x").join(half("y"), "token")
              .where((F.col("x") < F.col("y")) & (F.col("root_x") != F.col("root_y")) & near
                     & (F.col("pos_x") < end("x")) & (F.col("pos_y") < end("y")) & (room >= need))
              .groupBy(*keys).agg(F.count("*").alias("m"), F.min("token").alias("g")).where(F.col("m") >= need)
              .select("x", "y", "g"))
    more = verified(materialise(across, "jaccard-across"), classes, rows, percent)
    roots = component_roots(links.unionByName(more))

    # class -> component -> smallest doc_id; classes without links are their own
    members = (narrow.where("n > 0").join(copied, "row", "left")
               .select("row", "doc_id", "tie", F.coalesce("first", "row").alias("class")))
    grouped = (members.join(roots.withColumnRenamed("node", "class"), "class", "left")
               .withColumn("root", F.coalesce("root", "class")))
    several = (grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("c"),
                                           F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tie")).alias("head"))
               .where("c > 1"))
    told = grouped.join(several, "root").select("row", "component_id", "head")
    first = F.col("head").isNull() | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & F.col("tie").eqNullSafe(F.col("head.tie")))
    return (narrow.join(told, "row", "left")
            .select("doc_id", "tie", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id"), first.alias("first")))
