"""Hard-negative mining on exact integer inner products, with candidate lists that clusters of anchors share.

For every anchor: its first ``positives`` other rows of the same label, and for each of those the first
``negatives`` rows of another label whose score is at most the positive's and at least ``least`` percent of it.
Higher scores come first, ties by smaller id.

*Clusters.* Anchors are clustered by direction (spherical k-means on a sample of at most ``SAMPLE_NUMBERS`` numbers; the
sample decides what can be skipped, never a result). Every anchor goes to its nearest centroid; a cluster's radius is its
largest angle to it. Clusters of more than ``MEMBERS`` anchors are walked in chunks, so no task holds more.

*Lists.* For a candidate ``i`` at angle ``t`` from the centroid, no member ``a`` scores above
``|a| |i| cos(max(0, t - radius))``. A cluster's list is ordered by this bound, falling. It is cut into segments (the cuts
are quantiles of a sample of candidates) that are made one after another, when some member still needs them: a task
of candidates computes their bounds and deals those of the segment over stripes of some ``STRIPE`` rows of each cluster's
list. Within its stripe every member walks down the bounds, block by block, and ends when the bound times its length is
under what its last place asks for. Members without an open place take no part in the next segment, nor do candidates
whose bound no open place asks for. The last segment has everything that is left, so nothing is missed.

The first walk finds the positives, the second the negatives, whose window is known by then.

Defined results: rows with a null label, a null vector, null or non-finite entries take no part; of several vector
lengths the most frequent one counts (the longest of those that tie). Integers are held within ``LARGEST``. Rows that
repeat an id are rows of their own (ties of id by an arbitrary but fixed number); a null id comes after all others.
Zero vectors score 0 with everything. No anchor, or no partner, gives no rows. Other columns do not matter,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

POSITIVES = NEGATIVES = 5
LEAST = 80
#: largest entry: with it scores of 4,096 dimensions fit in 63 bits
LARGEST = 1 << 25
MEMBERS = 2048
#: clusters: one for MEMBERS anchors, but not fewer or more than these
FEWEST_CLUSTERS, MOST_CLUSTERS = 8, 1024
#: numbers (rows x dimensions) of the samples for centroids and cuts
SAMPLE_NUMBERS = 1 << 20
#: parts of a list that end its segments
SEGMENTS = (0.02, 0.2, 1.0)
STRIPE = 4096
#: candidates that a walk scores at once
STEP = 512
#: angles are rounded by less than this
SLACK = 1e-6

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FOUND = "anchor long, target int, score long, gid long, vec_id long"


def integer_rows(rows: DataFrame, label: Column, scale: int, vec_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """(gid, vec_id, label, q): the rows that take part, ``q`` being ``floor(scale * x)``; written, ``gid`` unique."""
    usable = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))

    def entry(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")

    out = (rows.where(F.col(vec_col).isNotNull() & usable & label.isNotNull())
           .select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                   F.transform(vec_col, entry).alias("q")))
    return materialise(out.withColumn("gid", F.monotonically_increasing_id()), "negatives-rows")


def _matrix(column, d: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sample(rows: DataFrame, count: int, d: int) -> np.ndarray:
    """About ``SAMPLE_NUMBERS / d`` rows by hash, at most twice as many."""
    most = max(1000, SAMPLE_NUMBERS // d)
    part = F.pmod(F.xxhash64("gid"), F.lit(1 << 30)) < min(1 << 30, (most << 30) // max(count, 1))
    return np.array([r[0] for r in rows.where(part).select("q").limit(2 * most).collect()], np.float64).reshape(-1, d)


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=-1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def centroids_of(sample: np.ndarray, k: int, turns: int = 10) -> np.ndarray:
    """Unit centroids by spherical k-means, begun at the points farthest from those chosen before."""
    points = _unit(sample[np.any(sample != 0, axis=1)])
    if not len(points):
        return _unit(np.ones((1, sample.shape[1])))
    chosen, near = [0], points @ points[0]
    while len(chosen) < min(k, len(points)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, points @ points[chosen[-1]])
    centres = points[chosen]
    for _ in range(turns):
        nearest = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        moved = _unit(sums)
        centres = np.where(np.any(moved != 0, axis=1)[:, None], moved, centres)
    return centres


def _angles(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(q.astype(np.float64)) @ centres.T, -1.0, 1.0))


def _bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """(rows, clusters): what a member of length 1 can score at most."""
    length = np.linalg.norm(q.astype(np.float64), axis=1)
    return length[:, None] * (np.cos(np.maximum(0.0, _angles(q, centres) - radius - SLACK)) + 1e-9)


def _with_clusters(anchors: DataFrame, centres: np.ndarray, d: int) -> DataFrame:
    """``anchors`` with cluster, angle to its centroid, and length; written."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b.column("q"), d)
            angles = _angles(q, centres)
            nearest = angles.argmin(1)
            angle = np.where(np.any(q != 0, axis=1), angles[np.arange(len(q)), nearest], 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nearest.astype(np.int32)), pa.array(angle),
                                              pa.array(np.linalg.norm(q.astype(np.float64), axis=1))],
                                             names=[*b.schema.names, "cluster", "angle", "length"])

    kept = anchors.select("gid", "vec_id", "label", "q")
    return materialise(kept.mapInArrow(assign, "gid long, vec_id long, label long, q array<int>, cluster int, angle double, "
                                               "length double"), "negatives-anchors")


def _scores(members: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where these hold them."""
    top = max(int(np.abs(members).max(initial=0)), int(np.abs(items).max(initial=0)))
    if top * top * members.shape[1] < 1 << 53:
        return (members.astype(np.float64) @ items.astype(np.float64).T).astype(np.int64)
    return members.astype(np.int64) @ items.astype(np.int64).T


def walk(members: pa.Table, items: pa.Table, d: int, same_label: bool, keep: int) -> pa.Table:
    """The best ``keep`` candidates of every target in one stripe, as far as they reach what the target asks for.

    A member has targets: score windows from ``needs`` (what its last place asks for so far) to ``tops``.
    """
    items = items.take(pa.array(np.argsort(-items.column("bound").to_numpy(), kind="stable")))
    bound, item_gid, item_label = (items.column(c).to_numpy() for c in ("bound", "gid", "label"))
    unknown = items.column("vec_id").is_null().to_numpy()
    item_id = items.column("vec_id").fill_null(0).to_numpy()
    q, own = _matrix(items.column("q"), d), _matrix(members.column("q"), d)
    gid, label, length = (members.column(c).to_numpy() for c in ("gid", "label", "length"))
    tops, needs = (np.array(members.column(c).to_pylist(), np.int64).reshape(len(gid), -1) for c in ("tops", "needs"))
    targets = tops.shape[1]
    key, at, score = (np.zeros(0, np.int64) for _ in range(3))  # kept: member * targets + target, item, score
    for begin in range(0, len(bound), STEP):
        wants = ((needs <= tops) & (needs - 0.5 <= (length * bound[begin])[:, None])).any(1)
        who = np.flatnonzero(wants)
        if not len(who):
            break
        here = slice(begin, begin + STEP)
        made = _scores(own[who], q[here])
        fits = (item_label[here][None, :] == label[who][:, None]) == same_label
        if same_label:
            fits &= item_gid[here][None, :] != gid[who][:, None]
        for t in range(targets):
            m, i = np.nonzero(fits & (made >= needs[who, t][:, None]) & (made <= tops[who, t][:, None]))
            key = np.concatenate([key, who[m] * targets + t])
            at, score = np.concatenate([at, begin + i]), np.concatenate([score, made[m, i]])
        order = np.lexsort((item_gid[at], item_id[at], unknown[at], -score, key))
        key, at, score = key[order], at[order], score[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        place = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
        key, at, score, place = (x[place < keep] for x in (key, at, score, place))
        full = place == keep - 1
        flat = needs.reshape(-1)
        flat[key[full]] = np.maximum(flat[key[full]], score[full])
    return pa.table({"anchor": gid[key // targets], "target": (key % targets).astype(np.int32), "score": score,
                     "gid": item_gid[at], "vec_id": items.column("vec_id").take(pa.array(at))})


class _Lists:
    """The shared lists of all clusters: centroids, radii, cuts between segments and sizes (bounded, on the driver)."""

    def __init__(self, items: DataFrame, anchors: DataFrame, centres: np.ndarray, count: int, d: int):
        self.items, self.anchors, self.centres, self.count, self.d = items, anchors, centres, count, d
        found = {r["cluster"]: r for r in anchors.groupBy("cluster").agg(
            F.max("angle").alias("angle"), F.count("*").alias("c")).collect()}  # <= MOST_CLUSTERS rows
        k = len(centres)
        self.radius = np.array([found[c]["angle"] if c in found else 0.0 for c in range(k)])
        self.chunks = np.array([-(-found[c]["c"] // MEMBERS) if c in found else 1 for c in range(k)], np.int32)
        self.sampled = _bounds(_sample(items, count, d), centres, self.radius)
        inner = [np.quantile(self.sampled, 1 - p, axis=0) if len(self.sampled) else np.zeros(k) for p in SEGMENTS[:-1]]
        self.cuts = np.array([np.full(k, np.inf), *inner, np.full(k, -np.inf)])

    def segment(self, r: int, targets: DataFrame, same_label: bool, keep: int) -> DataFrame | None:
        """What segment ``r`` has for ``targets`` (anchor, tops, needs); None if no member needs it."""
        k, d, centres, radius = len(self.centres), self.d, self.centres, self.radius
        high, low = self.cuts[r], self.cuts[r + 1]
        bounds = self.anchors.sparkSession.createDataFrame(
            [(c, float(high[c]), int(self.chunks[c])) for c in range(k)], "cluster int, high double, chunks int")
        asked = F.array_min(F.transform(F.arrays_zip("needs", "tops"), lambda z: F.when(z["needs"] <= z["tops"], z["needs"])))
        open_ = (self.anchors.join(targets, F.col("gid") == F.col("anchor")).join(F.broadcast(bounds), "cluster")
                 .withColumn("asked", asked).where("asked IS NOT NULL")
                 .withColumn("floor", F.when(F.col("length") > 0, (F.col("asked") - 0.5) / F.col("length"))
                             .otherwise(F.lit(float("-inf"))))
                 .where("floor <= high"))
        open_ = materialise(open_.select("cluster", F.pmod(F.xxhash64("gid"), "chunks").cast("int").alias("chunk"), "gid",
                                         "label", "length", "q", "tops", "needs", "floor"), "negatives-members")
        floors = {r["cluster"]: r["floor"] for r in open_.groupBy("cluster").agg(F.min("floor").alias("floor")).collect()}
        if not floors:
            return None
        least = np.maximum(low, [floors.get(c, np.inf) for c in range(k)])
        part = ((self.sampled < high) & (self.sampled >= least)).mean(0) if len(self.sampled) else np.ones(k)
        stripes = np.maximum(1, np.ceil(part * self.count / STRIPE)).astype(np.int32)
        chunks = self.chunks

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 1024):
                    rows = b.slice(at, 1024)
                    made = _bounds(_matrix(rows.column("q"), d), centres, radius)
                    which, cluster = np.nonzero((made < high) & (made >= least))
                    for x in range(0, len(which), 8192):
                        w, c = which[x:x + 8192], cluster[x:x + 8192]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c.astype(np.int32)), pa.array(chunks[c]), pa.array(stripes[c]), pa.array(made[w, c]),
                             *(rows.column(n).take(pa.array(w)) for n in ("gid", "vec_id", "label", "q"))],
                            names=["cluster", "chunks", "stripes", "bound", "gid", "vec_id", "label", "q"])

        dealt = self.items.select("gid", "vec_id", "label", "q").mapInArrow(
            deal, "cluster int, chunks int, stripes int, bound double, gid long, vec_id long, label long, q array<int>")
        dealt = (dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                 .withColumn("stripe", F.pmod(F.xxhash64("gid"), "stripes").cast("int")))
        wide = self.anchors.sparkSession.createDataFrame([(c, int(stripes[c])) for c in range(k)], "cluster int, stripes int")
        members = (open_.join(F.broadcast(wide), "cluster")
                   .withColumn("stripe", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1))))
        keys = ["cluster", "chunk", "stripe"]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:  # a chunk without open members, a stripe without candidates
                return pa.table({"anchor": pa.array([], pa.int64()), "target": pa.array([], pa.int32()),
                                 **{n: pa.array([], pa.int64()) for n in ("score", "gid", "vec_id")}})
            return walk(left, right, d, same_label, keep)

        return members.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(run, _FOUND)

    def best(self, targets: DataFrame, same_label: bool, keep: int) -> DataFrame:
        """(anchor, target, place, score, gid, vec_id): the first ``keep`` rows of every target of (anchor, tops, needs)."""
        order = Window.partitionBy("anchor", "target").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "gid")
        known = None
        for r in range(len(SEGMENTS)):
            now = targets
            if known is not None:  # a full target asks for its last place's score
                full = (known.groupBy("anchor", "target").agg(F.min("score").alias("last"), F.count("*").alias("c"))
                        .where(F.col("c") == keep).groupBy("anchor")
                        .agg(F.map_from_entries(F.collect_list(F.struct("target", "last"))).alias("last")))
                now = targets.join(full, "anchor", "left").select(
                    "anchor", "tops", F.transform("needs", lambda n, t: F.greatest(n, F.col("last")[t.cast("int")])).alias("needs"))
            found = self.segment(r, now, same_label, keep)
            if found is None:
                break
            both = found if known is None else known.drop("place").unionByName(found)
            known = materialise(both.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep),
                                "negatives-best")
        if known is None:
            known = self.anchors.sparkSession.createDataFrame([], _FOUND).withColumn("place", F.lit(1))
        return known


def mine(items: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """Hard negatives of the anchors among ``items`` (of ``integer_rows``): the rows of ``OUT``."""
    spark = items.sparkSession
    lengths = items.groupBy(F.size("q").alias("d")).agg(F.count("*").alias("c")).where("d > 0")
    most = lengths.orderBy(F.desc("c"), F.desc("d")).first()
    if most is None:
        return spark.createDataFrame([], OUT)
    d, count = most["d"], most["c"]
    items = items.where(F.size("q") == d)
    anchors = items.where(is_anchor)
    n = anchors.count()
    if not n:
        return spark.createDataFrame([], OUT)
    k = min(n, MOST_CLUSTERS, max(FEWEST_CLUSTERS, -(-n // MEMBERS)))
    anchors = _with_clusters(anchors, centres := centroids_of(_sample(anchors, n, d), k), d)
    lists = _Lists(items, anchors, centres, count, d)
    far = (1 << 62) - 1
    every = anchors.select(F.col("gid").alias("anchor"), F.array(F.lit(far)).alias("tops"), F.array(F.lit(-far)).alias("needs"))
    near = lists.best(every, same_label=True, keep=positives)
    # the window of each positive: from least percent of its score, rounded up, to its score (below 0: empty)
    by_place = F.map_from_entries(F.collect_list(F.struct("place", "score")))
    top = lambda p: F.coalesce(F.col("s")[p], F.lit(-1).cast("long"))
    windows = (near.groupBy("anchor").agg(by_place.alias("s"))
               .withColumn("tops", F.transform(F.sequence(F.lit(1), F.lit(positives)), top))
               .withColumn("needs", F.expr(f"transform(tops, s -> if(s >= 0, (s * {least}L + 99) div 100, {far}L))"))
               .select("anchor", "tops", "needs"))
    hard = lists.best(windows, same_label=False, keep=negatives)
    names = anchors.select(F.col("gid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    positive = near.select("anchor", (F.col("place") - 1).alias("target"), F.col("vec_id").alias("positive_id"),
                           F.col("score").alias("positive_score"))
    return (hard.join(positive, ["anchor", "target"]).join(names, "anchor")
            .select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
