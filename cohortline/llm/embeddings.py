"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on ``PROJECTIONS`` random directions, each an axis. Two vectors collide on an axis if the
second lies in a window centred on the first. Nothing is sorted along an axis and no window is swept: cells of a grid
over several axes (as in LSH, at most ``MOST_TABLES`` tables) stand in for the sort. Only pairs that share a
range of a few axes at once (a table; several tables with shifted ranges) are counted, which keeps the
work far below all pairs; pairs with enough collisions over all axes are verified by cosine in double precision.

The window follows from the similarity; the least count and the number of tables are calibrated for recall on a
bounded sample of the vectors (``SAMPLE``, chosen by a hash), each paired with a random vector at exactly the
similarity. The number of axes per table follows the number of vectors, so that a table's groups keep their size.

Equal vectors are one class with a multiplicity, so copies are never paired. A pair is counted in the first table that holds
it, hence tasks return sums and spanning links instead of pairs. Groups over ``BLOCK`` vectors are dealt out as pairs of blocks.

Defined results: a vector that is null, empty or zero, or holds a null or non-finite component, links with nothing and is its own
component. Vectors of unlike length do not link. Every row is a vector, rows of a repeated id included; ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, store
from .components import components

PROJECTIONS = 32
SAMPLE = 1000
BLOCK = 2000
RECALL = 0.98
# Vectors of a table's group on average: what more there are goes into more axes per table.
GROUP = 1000
MOST_TABLES = 64
_SCALE = 2048.0     # axes as 16-bit integers


@dataclass(frozen=True)
class Plan:
    similarity: float
    axes: int           # per table
    tables: int
    least: int          # collisions
    seed: int = 17

    @property
    def spread(self) -> float:
        """Standard deviation along an axis of the difference of two vectors at the similarity."""
        return math.sqrt(2 - 2 * self.similarity)

    @property
    def window(self) -> int:
        return int(1.6 * self.spread * _SCALE)

    @property
    def width(self) -> float:
        return 4 * self.spread

    def directions(self, dims: int) -> np.ndarray:
        """Random directions, orthogonal as far as there are dimensions; axes have about unit variance."""
        rng = np.random.default_rng((self.seed, dims))
        parts = [np.linalg.qr(rng.normal(size=(dims, dims)))[0] for _ in range(-(-PROJECTIONS // dims))]
        return np.concatenate(parts, 1)[:, :PROJECTIONS] * math.sqrt(dims)

    def cells(self, axes: np.ndarray) -> np.ndarray:
        """Key of each vector (row) in each table (column)."""
        rng = np.random.default_rng(self.seed + 1)
        out = np.zeros((len(axes), self.tables), np.int64)
        for t in range(MOST_TABLES):
            use = rng.choice(PROJECTIONS, PROJECTIONS, replace=False)[:self.axes]
            shift = rng.random(PROJECTIONS)[:self.axes]
            if t < self.tables:
                cell = np.floor(axes[:, use] / self.width + shift).astype(np.int64)
                for c in cell.T:
                    out[:, t] = out[:, t] * 1000003 + c + 512
        return out


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def quantized(axes: np.ndarray) -> np.ndarray:
    return np.clip(np.round(axes * _SCALE), -15000, 15000).astype(np.int16)


def collisions(a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """For each row of ``a`` and of ``b`` the number of axes on which ``b`` is in the window around ``a``."""
    out = np.zeros((len(a), len(b)), np.uint8)
    for x, y in zip(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)):
        out += ((y[None, :] - (x - np.int16(window))[:, None]).view(np.uint16) <= 2 * window).view(np.uint8)
    return out


def calibrated(sample: np.ndarray, n: int, similarity: float) -> Plan:
    """Axes per table from the number of vectors; tables and least count from the sample."""
    apart = 0.45        # chance that two unrelated vectors share a range of an axis
    axes = int(np.clip(round(math.log(max(n, 2) / GROUP) / -math.log(apart)), 1, PROJECTIONS))
    plan = Plan(similarity, axes, MOST_TABLES, 0)
    if not len(sample):
        return Plan(similarity, axes, 1, 0)
    rng = np.random.default_rng(3)
    v = np.repeat(unit(sample), max(1, 2000 // len(sample)), axis=0)
    if v.shape[1] == 1:
        return Plan(similarity, axes, MOST_TABLES, 0)
    u = rng.normal(size=v.shape)
    u -= (u * v).sum(1, keepdims=True) * v
    w = similarity * v + math.sqrt(1 - similarity ** 2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    d = plan.directions(v.shape[1])
    a, b = v @ d, w @ d
    counts = (np.abs(quantized(a).astype(np.int32) - quantized(b)) <= plan.window).sum(1)
    least = int(np.quantile(counts, 1 - (1 + 2 * RECALL) / 3, method="lower"))
    while True:     # fewer axes per table, if all tables together would miss too many
        plan = Plan(similarity, axes, MOST_TABLES, least)
        met = np.maximum.accumulate(plan.cells(a) == plan.cells(b), axis=1) & (counts >= least)[:, None]
        good = np.flatnonzero(met.mean(0) >= RECALL)
        if len(good) or axes == 1:
            return Plan(similarity, axes, int(good[0]) + 1 if len(good) else MOST_TABLES, least)
        axes -= 1


def classes_of(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(embedding, rep, copies): the comparable vectors, each once."""
    v = F.col(vector_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return (table.filter(v.isNotNull() & good).groupBy(v.alias("embedding"))
            .agg(F.min(F.col(id_col).cast("long")).alias("rep"), F.count("*").alias("copies")))


def in_tables(classes: DataFrame, plan: Plan) -> DataFrame:
    """(t, cell, dims, rep, copies, vector): each class once per table."""
    def deal(batches):
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = pc.list_value_length(vectors).to_numpy()
            for dims in np.unique(lengths).tolist():
                own = pa.array(np.flatnonzero(lengths == dims))
                x = np.asarray(vectors.take(own).flatten()).reshape(-1, dims)
                cells = plan.cells(unit(x) @ plan.directions(dims))
                raw = x.astype(np.float64).tobytes() if x.dtype == np.float64 else x.astype(np.float32).tobytes()
                size = len(raw) // len(x)
                data = pa.array([raw[i:i + size] for i in range(0, len(raw), size)], pa.binary())
                rep, copies = batch.column("rep").take(own), batch.column("copies").take(own)
                for t in range(plan.tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), pa.array(cells[:, t]), pa.array(np.full(len(x), dims, np.int32)),
                         rep, copies, data], names=["t", "cell", "dims", "rep", "copies", "vector"])

    return classes.select("embedding", "rep", "copies").mapInArrow(deal, "t int, cell long, dims int, rep long, copies long, vector binary")


def blocked(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows with their task (i, j): one for most groups, a pair of blocks in large ones."""
    large = rows.groupBy("t", "cell", "dims").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = rows.join(large, ["t", "cell", "dims"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))) \
        .withColumn("own", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("blocks", "other")


def groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Rows of a sorted partition, one group of equal ``names`` at a time."""
    open_group: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names], 1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        if open_group and [open_group[-1].column(c)[-1].as_py() for c in names] != keys[0].tolist():
            yield pa.Table.from_batches(open_group)
            open_group = []
        for a, b in zip(edges, edges[1:]):
            open_group.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(open_group)
                open_group = []
    if open_group:
        yield pa.Table.from_batches(open_group)


def linked_pairs(x: np.ndarray, a: np.ndarray, b: np.ndarray, plan: Plan, table: int, inner: bool) -> Iterator[tuple]:
    """Indices (u, v) into ``x`` of verified pairs between ``a`` and ``b`` whose first common table is this one."""
    axes = x @ plan.directions(x.shape[1])
    points, cells = quantized(axes), plan.cells(axes)[:, :table]
    for begin in range(0, len(a), 256):
        part = a[begin:begin + 256]
        rest = b[begin + 1:] if inner else b
        if not len(rest):
            continue
        enough = collisions(points[part], points[rest], plan.window) >= plan.least
        u, v = np.nonzero(enough)
        if inner:
            later = v + 1 > u
            u, v = u[later], v[later]
        u, v = part[u], rest[v]
        near = np.einsum("ij,ij->i", x[u], x[v]) >= plan.similarity
        u, v = u[near], v[near]
        fresh = (cells[u] != cells[v]).all(1)
        yield u[fresh], v[fresh]


def partial_links(rows: DataFrame, plan: Plan) -> DataFrame:
    """(rep, links, v): per task the number of linked vectors of each class, and links that span its components."""
    names = ["t", "cell", "dims", "i", "j"]

    def count(batches):
        for g in groups(batches, names):
            if g.num_rows < 2:
                continue
            t, dims, i, j = (g.column(c)[0].as_py() for c in ("t", "dims", "i", "j"))
            rep, copies, own = (g.column(c).to_numpy() for c in ("rep", "copies", "own"))
            data = g.column("vector").to_pylist()
            x = unit(np.frombuffer(b"".join(data), np.float32 if len(data[0]) == 4 * dims else np.float64).reshape(-1, dims))
            a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
            total = np.zeros(len(rep), np.int64)
            root = np.arange(len(rep))

            def find(k):
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for u, v in linked_pairs(x, a, b, plan, t, i == j):
                np.add.at(total, u, copies[v])
                np.add.at(total, v, copies[u])
                for p, q in zip(u.tolist(), v.tolist()):
                    p, q = find(p), find(q)
                    if p != q:
                        root[max(p, q)] = min(p, q)
            met = np.flatnonzero(total)
            if len(met):
                yield pa.RecordBatch.from_arrays([pa.array(rep[met]), pa.array(total[met]), pa.array(rep[[find(k) for k in met.tolist()]])],
                                                 names=["rep", "links", "v"])

    dealt = rows.repartition(4 * partitions(rows.sparkSession), *names).sortWithinPartitions(*names)
    return dealt.mapInArrow(count, "rep long, links long, v long")


def near_duplicates(table: DataFrame, similarity: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
                    block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    classes = store(classes_of(table, id_col, vector_col))
    # a bounded sample: the plan does not depend on more of them
    sample = [r[0] for r in classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("embedding").collect()]
    same = [s for s in sample if len(s) == len(sample[0])]
    plan = calibrated(np.array(same, np.float64), classes.count(), similarity)
    found = store(partial_links(blocked(in_tables(classes, plan), block), plan))
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("u"), "v"))
    known = (classes.join(sums, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
             .select("embedding", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    own = F.col(id_col)
    out = (table.select(own, F.col(vector_col).alias("embedding")).join(known, "embedding", "left")
           .select(own, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("component_id", own.cast("long")).alias("component_id")))
    return out.withColumn("kept", own.cast("long") == F.col("component_id"))
