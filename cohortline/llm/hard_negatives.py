"""Hard negatives by inner product: length buckets, sorted coordinate lists, feasible ranges, exact verification.

Rows are dealt to cells of (vector length, anchor group, row group); a cell holds a bounded number of anchors and rows.
There the rows are sorted by Euclidean length and cut into buckets. A bucket keeps one sorted list of the
normalised values of each coordinate. An anchor that needs a score of at least ``t`` can only meet rows whose cosine is
at least ``t / (anchor length * bucket's greatest length)``: above 1 the bucket is skipped, else every coordinate of
such a row lies in a range around the anchor's own value. The ranges of the anchor's largest coordinates (its focus)
are looked up in the sorted lists, the narrowest is taken and intersected with the others, and what is left
is verified with the whole integer inner product. ``t`` rises while buckets are read: it is the least score that
can still enter the anchor's list.

Two rounds over the cells: the positives of every anchor, then the negatives in the band of each positive. Each cell
returns at most ``count`` rows per anchor (and positive); a window over these picks the overall first ones. Scores are
exact: in double precision while every sum is below 2**53, else in Python integers.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part; of several rows
with one id the least (label, vector) counts; only vectors of the same number of components are compared; a zero
vector scores 0 with all; components and scores beyond 64 bits saturate; ties go to the smaller id; empty tables give
empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import store

ANCHORS = 512        # anchors per cell, about
ROWS = 16384         # rows per cell, about
BUCKET = 2048        # rows per length bucket
FOCUS = 4            # coordinates whose lists are looked up
_SLACK = 1e-9        # ranges are widened by this much, against rounding
_LONG = 2 ** 63 - 1
_EXACT = 2.0 ** 53
FOUND = "dim int, anchor_id long, positive_id long, positive_score long, row_id long, score long"


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """``floor(scale * x)`` of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def prepare(df: DataFrame, id_col: str, label: Column, vector: Column) -> DataFrame:
    """(id, label, vec, dim) of the rows that take part, one per id."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vec"))
    rows = rows.filter("id is not null and label is not null and vec is not null")
    one = rows.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row"))
    return one.select("id", "row.label", "row.vec", F.size("row.vec").alias("dim"))


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         anchors_per_cell: int = ANCHORS, rows_per_cell: int = ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``prepare``.

    A positive is one of an anchor's first ``positives`` other rows of its label; its negatives are the first
    ``negatives`` rows of other labels with ``low * positive_score <= 100 * score <= high * positive_score``.
    """
    rows = store(rows)
    chosen = rows.filter(anchors)
    # cells per number of components: numbers only, one row for each number of components
    sizes = {r["dim"]: (max(1, math.ceil(r["a"] / anchors_per_cell)), max(1, math.ceil(r["n"] / rows_per_cell)))
             for r in rows.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(anchors, 1)).alias("a")).collect()
             if r["a"]}
    empty = "array<struct<id: bigint, score: bigint>>"
    kept = cells(rows, chosen.withColumn("want", F.lit(None).cast(empty)), sizes, ("same", positives, low, high))
    best = first(kept, ["anchor_id"], positives).select(
        F.col("anchor_id").alias("id"), F.struct(F.col("row_id").alias("id"), "score").alias("positive"))
    want = store(chosen.join(best.groupBy("id").agg(F.array_sort(F.collect_list("positive")).alias("want")), "id"))
    kept = cells(rows, want, sizes, ("other", negatives, low, high))
    return first(kept, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def first(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def cells(rows: DataFrame, anchors: DataFrame, sizes: dict[int, tuple[int, int]], task: tuple) -> DataFrame:
    """What each cell finds: rows go to one row group and all anchor groups, anchors the other way round."""
    spark = rows.sparkSession
    counts = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, F.array(F.lit(n[0]), F.lit(n[1])))]) \
        if sizes else F.lit(None).cast("map<int, array<int>>")
    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")

    def dealt(df, is_anchor, want):
        df = df.withColumn("n", counts[F.col("dim")]).filter("n is not null")
        mine_, all_ = (0, 1) if is_anchor else (1, 0)
        own = F.pmod(F.xxhash64("id"), F.col("n")[mine_]).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("n")[all_] - 1))
        g, s = (own, every) if is_anchor else (every, own)
        return df.select("dim", g.alias("g"), s.alias("s"), F.lit(is_anchor).alias("is_anchor"), "id", "label", "vec", want.alias("want"))

    both = dealt(rows, False, none).unionByName(dealt(anchors, True, F.col("want")))
    spread = both.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "dim", "g", "s")
    return spread.groupBy("dim", "g", "s").applyInArrow(probe(*task), FOUND)


def probe(kind: str, count: int, low: int, high: int):
    """The function of one cell."""
    def run(cell: pa.Table) -> pa.Table:
        side = cell.column("is_anchor").to_numpy(zero_copy_only=False).astype(bool)
        ids, labels = cell.column("id").to_numpy(), cell.column("label").to_numpy()
        dim = cell.column("dim")[0].as_py()
        vecs = cell.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
        at = np.flatnonzero(side)
        wants = cell.column("want").take(pa.array(at)).to_pylist()
        anchors = [a for i, want in zip(at.tolist(), wants) if (a := Anchor(int(ids[i]), int(labels[i]), vecs[i], lists(want))).lists]
        other = np.flatnonzero(~side)
        search(anchors, ids[other], labels[other], vecs[other], kind)
        out = [(dim, a.id, f.positive, f.positive_score, i, s) for a in anchors for f in a.lists for s, i in f.rows()]
        columns = list(zip(*out)) or [()] * 6
        types = [pa.int32()] + [pa.int64()] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[
            "dim", "anchor_id", "positive_id", "positive_score", "row_id", "score"])

    def lists(want):
        if kind == "same":
            return [Found(count)]
        bands = [(w["id"], w["score"], -(-low * w["score"] // 100), high * w["score"] // 100) for w in want or ()]
        return [Found(count, *band) for band in bands if band[2] <= band[3]]

    return run


class Found:
    """The first ``count`` rows so far for an anchor, or for one of its positives."""

    def __init__(self, count, positive=None, positive_score=None, least=None, most=None):
        self.count, self.positive, self.positive_score, self.least, self.most = count, positive, positive_score, least, most
        self.best: list[tuple[int, int]] = []      # (-score, id), ascending

    def need(self) -> float:
        """The least score that can still enter."""
        full = -self.best[-1][0] if len(self.best) == self.count else None
        return max((x for x in (self.least, full) if x is not None), default=-math.inf)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        need = self.need()
        good = np.ones(len(scores), bool) if need == -math.inf else (scores >= need).astype(bool)
        if self.most is not None:
            good &= (scores <= self.most).astype(bool)
        good = np.flatnonzero(good)
        if len(good) > self.count and scores.dtype != object:
            edge = np.partition(scores[good], len(good) - self.count)[len(good) - self.count]
            good = good[scores[good] >= edge]
            good = good[np.lexsort((ids[good], -scores[good]))[:self.count]]
        if len(good):
            new = [(-int(s), int(i)) for s, i in zip(scores[good].tolist(), ids[good].tolist())]
            self.best = sorted(self.best + new)[:self.count]

    def rows(self):
        return [(min(max(-s, -_LONG - 1), _LONG), i) for s, i in self.best]


class Anchor:
    """An anchor and its lists: one of positives, or one of negatives for each positive."""

    def __init__(self, id, label, vec, lists):
        self.id, self.label, self.vec, self.lists = id, label, vec, lists
        self.floats = vec.astype(np.float64)
        self.length = math.sqrt(float(self.floats @ self.floats))
        self.unit = self.floats / (self.length or 1.0)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS].tolist()

    def cosine(self, longest: float) -> float:
        """The least cosine with a row of that length that can still enter a list."""
        need, reach = min(f.need() for f in self.lists), self.length * longest
        return need / reach if reach else math.inf if need > 0 else -math.inf


def search(anchors: list[Anchor], ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray, kind: str) -> None:
    """All rows against all anchors, bucket by bucket in order of falling length."""
    if not anchors or not len(ids):
        return
    floats = vecs.astype(np.float64)
    lengths = np.sqrt((floats * floats).sum(1))
    order = np.lexsort((ids, -lengths))
    for begin in range(0, len(order), BUCKET):
        bucket = Bucket(ids, labels, vecs, floats, lengths, order[begin:begin + BUCKET])
        for anchor in anchors:
            cosine = anchor.cosine(bucket.longest)
            if cosine > 1 + _SLACK:
                continue
            at = bucket.feasible(anchor.unit, anchor.focus, cosine)
            same = bucket.labels[at] == anchor.label
            at = at[same & (bucket.ids[at] != anchor.id) if kind == "same" else ~same]
            if len(at):
                scores, its = bucket.scores(at, anchor), bucket.ids[at]
                for found in anchor.lists:
                    found.add(scores, its)


class Bucket:
    """Rows of similar length with the sorted list of each coordinate's normalised values."""

    def __init__(self, ids, labels, vecs, floats, lengths, rows):
        self.ids, self.labels, self.vecs, self.floats = ids[rows], labels[rows], vecs[rows], floats[rows]
        self.longest = float(lengths[rows[0]])
        scale = lengths[rows]
        self.unit = self.floats / np.where(scale > 0, scale, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.values = np.take_along_axis(self.unit, self.order, 0)
        self.all = np.arange(len(rows))
        self.greatest = float(np.abs(self.floats).max(initial=0))

    def feasible(self, unit: np.ndarray, focus: list[int], cosine: float) -> np.ndarray:
        """Rows whose focus coordinates all allow that cosine."""
        if cosine <= 0:
            return self.all
        cosine = min(cosine, 1.0) - _SLACK
        ranges = []
        for f in focus:
            x = float(unit[f])
            across = math.sqrt(max(0.0, (1 - cosine * cosine) * (1 - x * x)))
            least = (-1.0 if -x >= cosine else x * cosine - across) - _SLACK
            most = (1.0 if x >= cosine else x * cosine + across) + _SLACK
            begin = int(np.searchsorted(self.values[:, f], least, "left"))
            end = int(np.searchsorted(self.values[:, f], most, "right"))
            ranges.append((end - begin, begin, end, f, least, most))
        ranges.sort()
        _, begin, end, f, _, _ = ranges[0]
        at = self.order[begin:end, f]
        for n, _, _, f, least, most in ranges[1:]:
            if n == len(self.all):
                break
            value = self.unit[at, f]
            at = at[(value >= least) & (value <= most)]
        return at

    def scores(self, at: np.ndarray, anchor: Anchor) -> np.ndarray:
        bound = self.greatest * float(np.abs(anchor.floats).max(initial=0)) * max(1, len(anchor.vec))
        if bound < _EXACT:
            if 2 * len(at) > len(self.all):
                return (self.floats @ anchor.floats)[at].astype(np.int64)
            return (self.floats[at] @ anchor.floats).astype(np.int64)
        return np.array([sum(map(int.__mul__, row, anchor.vec.tolist())) for row in self.vecs[at].tolist()] + [None], object)[:-1]


def hard_negatives(df: DataFrame) -> DataFrame:
    """The mined triples of a table (vec_id, embedding, label): anchors are the ids divisible by 100."""
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = prepare(df, "vec_id", label, F.when(usable(F.col("embedding")), quantised(F.col("embedding"))))
    return mine(rows, F.col("id") % 100 == 0)
