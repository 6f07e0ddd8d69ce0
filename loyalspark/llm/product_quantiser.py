"""Near-duplicate vectors by product quantisation.

Index: unit vectors are dealt to inverted lists by the nearest centroids of
their two halves (so k centroids a half make k * k lists at 2 k comparisons),
and the residual from the list's centre is cut into subspaces, each coded as
the nearest of up to 256 entries. Centroids and codebooks are fitted on at
most ``TRAIN_VECTORS`` vectors, taken evenly by a hash of the vector; every
vector is indexed.

Search: a vector is looked up in its own list and in the ``probes`` nearest
lists of greater number, so each pair meets once. Asymmetric distances to the
coded vectors come from tables of the query's residual; a coded vector is
passed on if the distance, less its own coding error (kept with it), may lie
within the threshold, so coding loses no pair. What is passed on is settled by
cosine in double precision.

Hot groups: equal vectors are one class with a weight. Where the sample is
dense, a ball around its mean takes all vectors so close to it that any two of
them are linked; these links are counted by the ball's weight and its members
are tied to one another through the smallest, so no pair within a ball is ever
looked at. Lists and queries beyond ``BLOCK`` are split into blocks that meet
in tasks of their own. Tasks give counts and trees that span linked vectors,
never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_hot, join_small, stage

#: Vectors that centroids, codebooks and balls are fitted on, at most.
TRAIN_VECTORS = 16_384
#: Mean vectors in a list; rows and queries that meet in one task, at most.
LIST, BLOCK = 512, 4096
SUBSPACES = 8
#: Balls at most, and the share of the sample that makes one.
MAX_BALLS, BALL_SHARE = 256, 256
#: Lists (about 50 bytes each) that are split, up to which they are broadcast.
MAX_BROADCAST_LISTS = 500_000
_SLICE = 256


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """At most k centroids; fewer where x has fewer distinct rows."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    start = np.random.default_rng(seed).permutation(len(x))
    at = np.unique(x[start], axis=0, return_index=True)[1]
    c = x[start[np.sort(at)[:k]]].copy()
    for _ in range(rounds):
        near = nearest(x, c)[0]
        n = np.bincount(near, minlength=len(c))
        sums = np.stack([np.bincount(near, x[:, j], len(c)) for j in range(x.shape[1])], axis=1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, rows of x to rows of c."""
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1))


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    best, far = np.empty(len(x), np.int64), np.empty(len(x))
    for lo in range(0, len(x), 4096):
        d = squares(x[lo: lo + 4096], c)
        best[lo: lo + 4096] = d.argmin(1)
        far[lo: lo + 4096] = d.min(1)
    return best, far


class Index:
    """Centroids, codebooks and balls for unit vectors of one dimension."""

    def __init__(self, sample: np.ndarray, vectors: int, threshold: float):
        self.threshold = threshold
        self.radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
        self.half = sample.shape[1] // 2
        k = max(1, round(math.sqrt(vectors / LIST)))
        self.coarse = [_kmeans(x, k, 8, 1) for x in (sample[:, : self.half], sample[:, self.half:])]
        self.probes = max(16, round(6 * math.log2(k + 1)))
        self.parts = [p for p in np.array_split(np.arange(sample.shape[1]), SUBSPACES) if len(p)]
        rest = sample - self.centre(self.lists(sample)[:, 0])
        self.books = [_kmeans(rest[:, p], 256, 4, 2) for p in self.parts]
        self.balls = self._balls(sample)

    def centre(self, lists: np.ndarray) -> np.ndarray:
        a, b = np.divmod(lists, len(self.coarse[1]))
        return np.hstack([self.coarse[0][a], self.coarse[1][b]])

    def lists(self, x: np.ndarray, n: int = 1) -> np.ndarray:
        """The n nearest lists of each vector, nearest first, -1 for none."""
        da, db = squares(x[:, : self.half], self.coarse[0]), squares(x[:, self.half:], self.coarse[1])
        # of the n nearest sums, the i-th best of a half pairs with at most n / i of the other
        ia, ib = (np.argsort(d, axis=1, kind="stable")[:, :n] for d in (da, db))
        i, j = np.nonzero((np.arange(ia.shape[1])[:, None] + 1) * (np.arange(ib.shape[1]) + 1) <= n)
        rows = np.arange(len(x))[:, None]
        total = da[rows, ia[:, i]] + db[rows, ib[:, j]]
        number = ia[:, i] * len(self.coarse[1]) + ib[:, j]
        best = np.argsort(total, axis=1, kind="stable")[:, :n]
        return number[rows, best]

    def _balls(self, sample: np.ndarray) -> np.ndarray:
        """Unit centres of the sample's dense places, the densest first."""
        close = math.sqrt((1 + self.threshold) / 2)
        unit = sample.astype(np.float32)
        many = max(8, len(sample) // BALL_SHARE)
        count = np.concatenate([(unit[lo: lo + 1024] @ unit.T >= close).sum(1) for lo in range(0, len(unit), 1024)] or [np.zeros(0, int)])
        out, free = [], count >= many
        while free.any() and len(out) < MAX_BALLS:
            seed = np.flatnonzero(free)[count[free].argmax()]
            mean = sample[(sample @ sample[seed]) >= close].mean(0)
            mean /= max(np.linalg.norm(mean), 1e-300)
            out.append(mean)
            free &= sample @ mean < close
            free[seed] = False
        return np.array(out).reshape(len(out), sample.shape[1])

    def ball(self, x: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """(ball or -1, other balls with members that may be linked) by vector.
        Members of a ball lie within half the threshold's angle of its centre."""
        if not len(self.balls):
            return np.full(len(x), -1), [[]] * len(x)
        angle = np.arccos(np.clip(x @ self.balls.T, -1, 1))
        most = math.acos(self.threshold)
        own = np.where(angle.min(1) <= most / 2 - 1e-7, angle.argmin(1), -1)
        near = angle <= 1.5 * most + 1e-7
        inside = own >= 0
        near[np.flatnonzero(inside), own[inside]] = False
        return own, [np.flatnonzero(r).tolist() for r in near]

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, coding error) of vectors in the given lists."""
        rest = x - self.centre(lists)
        found = [nearest(rest[:, p], book) for p, book in zip(self.parts, self.books)]
        return np.stack([f[0] for f in found], axis=1).astype(np.uint8), np.sqrt(sum(f[1] for f in found))

    def candidates(self, queries: np.ndarray, centre: np.ndarray, codes: np.ndarray, error: np.ndarray) -> np.ndarray:
        """Mask (queries x coded vectors of a list): may lie within the radius."""
        rest = queries - centre
        total = np.zeros((len(queries), len(codes)), np.float32)
        for m, (p, book) in enumerate(zip(self.parts, self.books)):
            total += squares(rest[:, p], book).astype(np.float32)[:, codes[:, m]]
        reach = (self.radius + error + 1e-4).astype(np.float32)
        return total <= (reach * reach)[None, :]


def unit(column) -> np.ndarray:
    """Rows of an Arrow list column, in double precision, divided by their norms."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # the largest component first, so no square overflows or vanishes
    x = x / np.abs(x).max(1, initial=1e-300, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def clean_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, k1, k2): v is null where it can link with nothing: null, empty
    or zero, a component null or not finite, or no id. k1 and k2 name v."""
    kind = "float" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    good = (F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
            & F.col(id_col).isNotNull())
    # adding zero makes -0.0 and 0.0 one number
    rows = vectors.select(F.col(id_col).alias("id"), F.when(good, F.transform(v, lambda x: x + F.lit(0).cast(kind))).alias("v"))
    return rows.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(1), F.col("v")))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label) of the long pairs (a, b): every node with the smallest
    one of its component, by alternating star contraction. A node with many
    links is met by broadcast, so none gathers in a task."""
    edges = stage(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    before = None
    while True:
        # each neighbour above a node goes to the node's smallest neighbour
        both = stage(spark, edges.unionAll(edges.select("b", "a")), "links-both")
        least = stage(spark, both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "links-least")
        large = join_hot(both, least, ["a"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(spark, large.distinct(), "links-large")
        # then a node and its neighbours below go to the smallest of them
        down = stage(spark, large.groupBy("a").agg(F.min("b").alias("m")), "links-down")
        small = join_hot(large, down, ["a"]).select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        edges = stage(spark, small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).filter("a != b").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum((F.hash("a", "b").cast("long")))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
                edges.select("b", F.col("b").alias("label")).distinct())
        before = state


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of each of n nodes' components under links (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _searcher(held):
    """Function of a task's block: coded vectors and queries of one list."""

    def run(key, table):
        index: Index = held.value
        cid, weight, error = (table.column(c).to_numpy() for c in ("cid", "weight", "error"))
        query, own = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("query", "own"))
        x = unit(table.column("v"))
        data, queries = np.flatnonzero(~query), np.flatnonzero(query)
        codes = np.frombuffer(b"".join(table.column("codes").take(pa.array(data)).to_pylist()), np.uint8).reshape(len(data), -1)
        centre = index.centre(np.array([key[0].as_py()]))
        gain = np.zeros(len(cid))
        links = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for lo in range(0, len(queries) if len(data) else 0, _SLICE):
            q = queries[lo: lo + _SLICE]
            # pairs within a list meet twice, and each vector itself
            may = index.candidates(x[q], centre, codes, error[data]) & (~own[q, None] | (cid[q, None] < cid[data]))
            some = np.flatnonzero(may.any(0))
            i, j = np.nonzero(may[:, some])
            if len(i) * 4 > len(q) * len(some):
                cosine = (x[q] @ x[data[some]].T)[i, j]
            else:
                cosine = np.einsum("ij,ij->i", x[q[i]], x[data[some[j]]])
            hit = cosine >= index.threshold
            a, b = q[i[hit]], data[some[j[hit]]]
            gain += np.bincount(a, weight[b], len(cid)) + np.bincount(b, weight[a], len(cid))
            links.append((a, b))
        name, at = np.unique(cid, return_inverse=True)
        root = name[_forest(*(at[np.concatenate(side)] for side in zip(*links)), len(name))]
        gain = np.bincount(at, gain, len(name)).astype(np.int64)
        return pa.table({"cid": name[gain > 0], "gain": gain[gain > 0], "root": root[gain > 0]})

    return run


_PLACED = "cid long, weight long, v {kind}, list long, ball int, others array<int>, near array<long>, codes binary, error double"


def _links(spark: SparkSession, found: DataFrame, threshold: float) -> DataFrame:
    """(cid, gain, root) of linked classes (cid, weight, v; staged, of one
    length): weights of vectors linked with a class, and a class of the same
    component. A class may have several rows."""
    n = found.count()
    sample = found.orderBy(F.xxhash64("v"), "cid").limit(TRAIN_VECTORS).select("v").toArrow()
    held = spark.sparkContext.broadcast(Index(unit(sample.column("v")), n, threshold))

    def place(batches):
        index: Index = held.value
        for b in batches:
            if not b.num_rows:
                continue
            x = unit(b.column("v"))
            near = index.lists(x, index.probes)
            ball, others = index.ball(x)
            codes, error = index.encode(x, near[:, 0])
            steps = pa.array(np.arange(len(x) + 1, dtype=np.int32) * near.shape[1])
            yield pa.RecordBatch.from_arrays([
                *b.columns, pa.array(near[:, 0]), pa.array(ball.astype(np.int32)), pa.array(others, pa.list_(pa.int32())),
                pa.ListArray.from_arrays(steps, pa.array(near.ravel())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                names=[x.split()[0] for x in _PLACED.split(", ")])

    placed = stage(spark, found.select("cid", "weight", "v").mapInArrow(
        place, _PLACED.format(kind=found.schema["v"].dataType.simpleString())), "pq-placed")

    # a ball's members are linked with one another: counted by weight, tied to the smallest
    inside = placed.filter("ball >= 0")
    balls = inside.groupBy("ball").agg(F.sum("weight").alias("total"), F.min("cid").alias("root"))
    tied = inside.join(F.broadcast(balls), "ball").select("cid", (F.col("total") - F.col("weight")).alias("gain"), "root")

    # a list's vectors stand apart by ball; queries go to those outside balls
    # and to the balls, but their own, that may hold a link
    data = placed.withColumn("at", F.col("list")).withColumn("pot", F.col("ball")).withColumn("query", F.lit(False)).withColumn("own", F.lit(False))
    asked = (placed.withColumn("at", F.explode(F.filter("near", lambda x: x >= F.col("list"))))
             .withColumn("pot", F.explode(F.concat(F.array(F.lit(-1)), "others")))
             .withColumn("query", F.lit(True)).withColumn("own", F.col("at") == F.col("list")))
    meets = stage(spark, data.groupBy("at", "pot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).join(
        asked.groupBy("at", "pot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("turns")), ["at", "pot"]), "pq-meets")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row into one of its side's blocks, once for each of the other's."""
        met = join_small(rows, meets, ["at", "pot"], "inner", MAX_BROADCAST_LISTS)
        return met.select("at", "pot", F.pmod(F.xxhash64("cid"), F.col(own)).cast("int").alias(own[:-1]),
                          F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:-1]),
                          "cid", "weight", "v", "codes", "error", "query", "own")

    meet = dealt(data, "blocks", "turns").unionByName(dealt(asked.withColumn("codes", F.lit(None).cast("binary")), "turns", "blocks"))
    found_links = meet.groupBy("at", "pot", "block", "turn").applyInArrow(_searcher(held), "cid long, gain long, root long")
    return stage(spark, found_links.unionAll(tied), "pq-links")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    Two rows are linked if the cosine of their vectors, in double precision, is
    at least ``threshold`` (above 0) and the index finds the pair; rows with
    equal vectors always are. Null, empty and zero vectors, those with a
    component that is null or not finite, and rows without an id link with
    nothing, nor do vectors of different length with each other: each length
    has an index of its own. ``component_id`` is the smallest id that links
    lead to, ``kept`` whether it is the row's own. Rows that repeat id and
    vector are linked like any others. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    rows = stage(spark, clean_rows(vectors, id_col, vector_col), "pq-rows")
    found = stage(spark, rows.filter("v is not null").groupBy("k1", "k2").agg(
        F.first("v").alias("v"), F.min("id").alias("least"), F.count("*").alias("weight")), "pq-classes")
    found = stage(spark, found.withColumn("cid", F.monotonically_increasing_id()), "pq-classes")
    links = spark.createDataFrame([], "cid long, gain long, root long")
    for (size,) in found.select(F.size("v")).distinct().collect():
        links = links.unionAll(_links(spark, stage(spark, found.filter(F.size("v") == size), "pq-length"), threshold))
    counts = links.groupBy("cid").agg(F.sum("gain").alias("gain"))
    labels = components(spark, links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = stage(spark, found.select("k1", "k2", "cid", "least", "weight").join(labels, F.col("cid") == F.col("node"), "left").join(counts, "cid", "left")
                  .withColumn("label", F.coalesce("label", "cid")), "pq-named")
    whole = stage(spark, named.groupBy("label").agg(F.min("least").alias("component_id")), "pq-components")
    settled = stage(spark, join_hot(named, whole, ["label"]).select(
        "k1", "k2", (F.col("weight") - 1 + F.coalesce("gain", F.lit(0))).alias("n_links"), "component_id"), "pq-settled")
    good, bad = rows.filter("v is not null").select("id", "k1", "k2"), rows.filter("v is null")
    out = join_hot(good, settled, ["k1", "k2"]).select("id", "n_links", "component_id").unionAll(
        bad.select("id", F.lit(0).cast("long"), "id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
