"""Nearest neighbours by largest inner product, found by counting collisions of single projections.

1. Equal vectors become one point with its smallest ids (a few more than are asked for: no more can be in a result). Points
   are dealt into shards by the size of their norm (a quarter of an octave) and a hash, queries into blocks by a hash; a task
   gets one shard and one block. Its data are a few MB for seconds of work, whatever the number of copies of a vector.
2. In a shard, one more entry makes all points equally long, so that the largest inner product is the smallest distance. The
   index is one sorted array of the points per projection (``PROJECTIONS`` random rotations' axes).
3. A query's windows, centred on its own projections, grow with a radius (virtual rehashing: the arrays stay, the windows
   widen, and only what has come into them is counted). Points within ``THRESHOLD`` or more windows are compared exactly. The
   radius starts at what a sample of ``FIT_QUERIES`` queries needs and grows by ``GROWTH`` until enough points are compared,
   then to the distance of the worst of them: everything that is nearer lies within this radius, and a point within the
   radius reaches the threshold with a probability of ``CERTAINTY``, whatever the data.
4. The best of all shards are merged. Recall is measured against brute force over all points for ``AUDIT_QUERIES`` queries; below
   ``AUDIT_TARGET`` the threshold is lowered and the search repeated, and if nothing is left to lower it raises.

The work is queries x rows x the part of the rows that windows reach: the method prunes comparisons, not shards. On vectors
that are spread evenly in 64 dimensions about a third of a shard's points are compared.

Edge cases: vectors that are null, empty, zero or hold null or non-finite entries take no part, nor do rows with a null id or
vectors of another length than most (on a tie, the shorter length). Rows with equal id and vector are one row. Rows that
repeat an id with another vector are rows of their own, as candidates and as queries; a query's own row is the one with its
id and vector. Equal scores are ordered by vec_id. Scores are exact sums (``fsum``) of products in double precision; beyond
its range they are infinite. With fewer candidates than asked for all are returned; an empty table gives an empty result.
Other columns than ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import Staging
from .common import slices

PROJECTIONS = 64
WIDTH = 1.75          # half a window, in radii
CERTAINTY = 0.96
GROWTH = 1.25
SHARD_ROWS = 16_384   # points that a task holds
BLOCK_QUERIES = 1024  # queries that a task holds
FIT_QUERIES = 16      # per shard and block
AUDIT_QUERIES = 256
AUDIT_TARGET, AUDIT_LEAST = 0.95, 0.9
ENTRY = "struct<score: double, vec_id: long, own: boolean>"


def axes(dims: int, count: int, seed: int = 11) -> np.ndarray:
    """``count`` unit directions, orthogonal within each rotation, scaled so that a unit vector's projections vary by 1."""
    random = np.random.default_rng(seed)
    rotations = [np.linalg.qr(random.normal(size=(dims, dims)))[0] for _ in range(-(-count // dims))]
    return np.concatenate(rotations, axis=1).T[:count] * math.sqrt(dims)


def collision_threshold(projections: int = PROJECTIONS, width: float = WIDTH, certainty: float = CERTAINTY) -> int:
    """The largest number of collisions that a point at exactly the radius reaches with this certainty."""
    near = math.erf(width / math.sqrt(2))
    reached = 0.0
    for count in range(projections, 0, -1):
        reached += math.comb(projections, count) * near ** count * (1 - near) ** (projections - count)
        if reached >= certainty:
            return count
    return 1


class SortedProjections:
    """One sorted array per projection over the points of a shard."""

    def __init__(self, points: np.ndarray, directions: np.ndarray):
        placed = (points @ directions.T).T
        self.order = np.argsort(placed, axis=1, kind="stable")
        self.values = np.take_along_axis(placed, self.order, axis=1)
        self.points, self.directions = points, directions

    def windows(self, centres: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, behind the last) place in every array, per query."""
        half = WIDTH * radius
        low = [np.searchsorted(row, centres[:, at] - half, "left") for at, row in enumerate(self.values)]
        high = [np.searchsorted(row, centres[:, at] + half, "right") for at, row in enumerate(self.values)]
        return np.stack(low, axis=1), np.stack(high, axis=1)

    def collisions(self, counts: np.ndarray, old: tuple[np.ndarray, np.ndarray], new: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Windows of each point after one query's windows have grown."""
        size = len(self.points)
        entering = int((new[1] - new[0] - old[1] + old[0]).sum())
        outside = len(self.order) * size - int((new[1] - new[0]).sum())
        bounds = zip(self.order, old[0].tolist(), old[1].tolist(), new[0].tolist(), new[1].tolist())
        if entering <= outside:
            parts = [part for row, a, b, low, high in bounds for part in (row[low:a], row[b:high])]
            return counts + np.bincount(np.concatenate(parts), minlength=size)
        # Wide windows: what lies outside is less.
        parts = [part for row, _, _, low, high in bounds for part in (row[:low], row[high:])]
        return len(self.order) - np.bincount(np.concatenate(parts), minlength=size)

    def nearest(self, queries: np.ndarray, wanted: int, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query: the points compared and their inner products, so that the ``wanted`` nearest found are among them."""
        size, count = len(self.points), len(queries)
        wanted = min(wanted, size)
        sample = self.points @ queries[:: max(1, count // FIT_QUERIES)].T
        likeness = -np.partition(-sample, wanted - 1, axis=0)[wanted - 1]
        radius = np.full(count, max(0.05, math.sqrt(max(0.0, 2 - 2 * likeness.max()))))
        centres = queries @ self.directions.T
        start = np.stack([np.searchsorted(row, centres[:, at]) for at, row in enumerate(self.values)], axis=1)
        old = (start, start.copy())
        counts = np.zeros((count, size), dtype=np.int16)
        compared = [np.zeros(0, dtype=np.int64)] * count
        products = [np.zeros(0)] * count
        active = np.arange(count)
        while len(active):
            low, high = self.windows(centres[active], radius[active])
            # Windows never shrink: neighbouring numbers may be rounded differently.
            low, high = np.minimum(low, old[0][active]), np.maximum(high, old[1][active])
            further = []
            for at, query in enumerate(active.tolist()):
                counts[query] = self.collisions(counts[query], (old[0][query], old[1][query]), (low[at], high[at]))
                reached = counts[query] >= threshold
                reached[compared[query]] = False
                fresh = np.flatnonzero(reached)
                compared[query] = np.concatenate((compared[query], fresh))
                products[query] = np.concatenate((products[query], self.points[fresh] @ queries[query]))
                if len(compared[query]) == size:
                    continue
                if len(compared[query]) < wanted:
                    # Twice the radius of the sphere that holds all points reaches all of them.
                    radius[query] *= GROWTH
                    further.append(query)
                    continue
                worst = -np.partition(-products[query], wanted - 1)[wanted - 1]
                needed = math.sqrt(max(0.0, 2 - 2 * worst))
                if needed > radius[query]:
                    radius[query] = needed
                    further.append(query)
            old[0][active], old[1][active] = low, high
            active = np.array(further, dtype=np.int64)
        return zip(compared, products)


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    flat = lists.combine_chunks()
    return flat.flatten().to_numpy().astype(np.float64).reshape(len(flat), -1)


def _product(a: np.ndarray, b: np.ndarray) -> float:
    with np.errstate(over="ignore", invalid="ignore"):
        products = a * b
        if np.isfinite(products).all():
            try:
                return math.fsum(products)
            except OverflowError:
                pass
        total = float(products.sum())
    return -math.inf if math.isnan(total) else total


def _lengths(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(largest absolute entry, length of the row divided by it): the length itself may leave the range of doubles."""
    largest = np.abs(matrix).max(axis=1)
    scaled = matrix / largest[:, None]
    return largest, np.sqrt((scaled * scaled).sum(axis=1))


def search_shard(rows: pa.Table, queries: pa.Table, wanted: int, threshold: int) -> list[list[tuple[float, int, bool]]]:
    """The ``wanted`` best (score, vec_id, is a copy of the query) of one shard for each query."""
    vectors, asked = _matrix(rows["vector"]), _matrix(queries["vector"])
    largest, lengths = _lengths(vectors)
    scale = largest.max()
    inside = lengths * (largest / scale)
    longest = inside.max()
    points = vectors / scale / longest
    rest = np.sqrt(np.maximum(0, 1 - (points * points).sum(axis=1)))
    points = np.concatenate((points, rest[:, None]), axis=1)
    own_largest, own_lengths = _lengths(asked)
    directed = np.concatenate((asked / own_largest[:, None] / own_lengths[:, None], np.zeros((len(asked), 1))), axis=1)
    index = SortedProjections(points, axes(points.shape[1], PROJECTIONS))
    names = list(zip(rows["k1"].to_pylist(), rows["k2"].to_pylist()))
    ids = rows["ids"].to_pylist()
    found = []
    for name, query, (compared, products) in zip(zip(queries["k1"].to_pylist(), queries["k2"].to_pylist()), asked,
                                                 index.nearest(directed, wanted, threshold)):
        # What rounding could have put behind is kept for the exact scores.
        least = -np.partition(-products, wanted - 1)[wanted - 1] - 1e-12 if len(products) > wanted else -np.inf
        entries = []
        for at in compared[products >= least].tolist():
            score = _product(vectors[at], query)
            entries += [(-score, one, names[at] == name) for one in ids[at]]
        found.append([(-score, one, own) for score, one, own in sorted(entries)[:wanted]])
    return found


def points_of(vectors: DataFrame, wanted: int, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(rows by id and vector: ``vec_id, k1, k2, vector``; points: ``k1, k2, vector, ids, band``)."""
    number = lambda x: ~F.isnan(x) & (F.abs(x) != float("inf"))
    good = F.forall("embedding", lambda x: F.coalesce(number(x), F.lit(False))) & F.exists("embedding", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & good
    # Zero has two signs; they are one number.
    zero = F.lit(0.0)
    rows = vectors.select("vec_id", "embedding").where(F.coalesce(usable, F.lit(False)))
    kind = dict(rows.dtypes)["embedding"][6:-1]
    rows = rows.select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.when(x == 0, zero.cast(kind)).otherwise(x)).alias("vector"))
    keyed = rows.select("vec_id", F.xxhash64("vector").alias("k1"), F.xxhash64("vector", F.lit(1)).alias("k2"), "vector")
    rows = staging.write(keyed.groupBy("vec_id", "k1", "k2").agg(F.first("vector").alias("vector")), "rows")
    lengths = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("vector") == (lengths["size"] if lengths else 0))
    # A task sends the smallest ids of a vector only.
    place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))
    few = rows.withColumn("_place", place).where(F.col("_place") <= wanted).drop("_place")
    points = few.groupBy("k1", "k2").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    largest = F.greatest(F.array_max("vector"), -F.array_min("vector")).cast("double")
    # Squares of entries in the range of 1 keep small and large vectors in the range of doubles.
    points = staging.write(points.withColumn("largest", largest), "measured")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest")))
    band = F.floor(4 * (F.log2("largest") + F.log2(squares) / 2) + 0.5).cast("int")
    return rows, staging.write(points.withColumn("band", band).drop("largest"), "points")


def _sharded(points: DataFrame) -> tuple[DataFrame, int]:
    """(points with ``shard``, number of shards): every band of norms is split by a hash."""
    bands = points.groupBy("band").count().orderBy("band").collect()  # a band per quarter of an octave: at most about 17,000
    parts = [-(-row["count"] // SHARD_ROWS) for row in bands]
    first = [sum(parts[:at]) for at in range(len(parts))]
    plan = points.sparkSession.createDataFrame([(row["band"], *some) for row, some in zip(bands, zip(parts, first))], "band int, parts int, first int")
    shard = F.col("first") + F.pmod(F.xxhash64("k1", "k2", F.lit("shard")), F.col("parts")).cast("int")
    return points.join(F.broadcast(plan), "band").select(shard.alias("shard"), "k1", "k2", "vector", "ids"), sum(parts)


def _found(points: DataFrame, asked: DataFrame, wanted: int, threshold: int, staging: Staging) -> DataFrame:
    """(k1, k2, entries: the ``wanted`` best of all points, best first) of every distinct query vector."""
    sharded, shards = _sharded(points)
    blocks = -(-asked.count() // BLOCK_QUERIES)
    # The stated queries meet all rows in blocks: every task has one block and one shard.
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = sharded.withColumn("block", spread(blocks))
    block = F.pmod(F.xxhash64("k1", "k2", F.lit("block")), F.lit(blocks)).cast("int")
    right = asked.withColumn("block", block).withColumn("shard", spread(shards))

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        some = search_shard(rows, queries, wanted, threshold) if rows.num_rows and queries.num_rows else []
        entries = [[{"score": score, "vec_id": one, "own": own} for score, one, own in best] for best in some]
        kind = pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64()), ("own", pa.bool_())]))
        return pa.table({"k1": queries["k1"].slice(0, len(some)), "k2": queries["k2"].slice(0, len(some)), "entries": pa.array(entries, kind)})

    parts = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        run, f"k1 long, k2 long, entries array<{ENTRY}>")
    best = staging.write(parts, "found").select("k1", "k2", F.explode("entries").alias("entry"))
    place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.desc("entry.score"), "entry.vec_id"))
    best = best.withColumn("place", place).where(F.col("place") <= wanted)
    return staging.write(best.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("place", "entry"))).alias("entries")).select(
        "k1", "k2", F.transform("entries", lambda one: one["entry"]).alias("entries")), "best")


def _audit(points: DataFrame, asked: DataFrame, wanted: int, staging: Staging) -> DataFrame:
    """(k1, k2, least, n): the ``wanted``-th best score of all points for a sample of queries, and how many there are, at most."""
    sample = asked.orderBy(F.xxhash64("k1", "k2", F.lit("audit"))).limit(AUDIT_QUERIES).toArrow()
    sent = points.sparkSession.sparkContext.broadcast((sample["k1"].to_numpy(), sample["k2"].to_numpy(), _matrix(sample["vector"]) if len(sample) else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k1, k2, queries = sent.value
        best = np.full((len(k1), wanted), -np.inf)
        with np.errstate(over="ignore", invalid="ignore"):
            for batch in slices(batches, 2048):
                scores = queries @ _matrix(pa.chunked_array([batch.column(0)])).T
                scores = np.repeat(np.nan_to_num(scores, nan=-np.inf, posinf=np.inf, neginf=-np.inf), batch.column(1).to_numpy(), axis=1)
                best = -np.sort(-np.concatenate((best, scores), axis=1), axis=1)[:, :wanted]
        query, place = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(k1[query]), pa.array(k2[query]), pa.array(best[query, place])], names=["k1", "k2", "score"])

    scores = points.select("vector", F.size("ids").alias("n")).mapInArrow(run, "k1 long, k2 long, score double")
    place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.desc("score")))
    kept = scores.withColumn("place", place).where(F.col("place") <= wanted)
    return staging.write(kept.groupBy("k1", "k2").agg(F.min("score").alias("least"), F.count("*").alias("n")), "audit")


def _recall(found: DataFrame, audit: DataFrame) -> float:
    """Mean over the sampled queries of the part of the true results that is found."""
    slack = F.abs("least") * 1e-12 + 1e-300  # the sums are rounded differently
    hits = F.size(F.filter("entries", lambda one: one["score"] >= F.col("least") - slack))
    row = found.join(audit, ["k1", "k2"]).agg(F.avg(F.least(F.lit(1.0), hits / F.col("n"))).alias("recall")).first()
    return 1.0 if row["recall"] is None else row["recall"]


def nearest_neighbours(vectors: DataFrame, staging: Staging, is_query: Callable[[Column], Column], count: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score, recall`` of the ``count`` nearest rows of each query; ``recall`` is the audited one."""
    # The query itself is among the points.
    wanted = count + 1
    rows, points = points_of(vectors, wanted, staging)
    queries = rows.where(is_query(F.col("vec_id")))
    asked = staging.write(queries.groupBy("k1", "k2").agg(F.first("vector").alias("vector")), "queries")
    schema = "query_id long, rank int, vec_id long, score double, recall double"
    if asked.isEmpty():
        return vectors.sparkSession.createDataFrame([], schema)
    audit = _audit(points, asked, wanted, staging)
    threshold = collision_threshold()
    while True:
        found = _found(points, asked, wanted, threshold, staging)
        recall = _recall(found, audit)
        if recall >= AUDIT_TARGET:
            break
        if threshold <= 1:
            if recall < AUDIT_LEAST:
                raise RuntimeError(f"recall of {recall:.3f} is below {AUDIT_LEAST}")
            break
        threshold = max(1, threshold - max(1, PROJECTIONS // 16))
    others = F.filter("entries", lambda one: ~(one["own"] & (one["vec_id"] == F.col("query_id"))))
    named = queries.select(F.col("vec_id").alias("query_id"), "k1", "k2").join(found, ["k1", "k2"])
    listed = named.select("query_id", F.posexplode(F.slice(others, 1, count)).alias("place", "entry"))
    return listed.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "entry.vec_id", "entry.score", F.lit(recall).alias("recall"))
