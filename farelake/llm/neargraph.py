"""Embedding near-dedup over a robust-pruned flat graph.

1. Equal vectors become one node (its smallest id, its number of copies).
2. Centroids are fitted on a bounded sample; every node joins the shards of its ``overlap`` nearest centroids. A shard over
   the size limit is dealt out as blocks, and every two of its blocks are a shard, so that no task holds more.
3. Each shard builds its part of the graph: nearest neighbours after robust pruning, and their back links. The adjacency
   lists of a node from all its shards are united.
4. Each shard searches for the neighbours of its nodes: greedily from its medoid and from the node's own list, then by
   expanding everything in range until nothing new is in range. United lists lead out of the shard: the nodes they lead to
   are compared next, round by round, until a round links nothing new.
5. Recall is audited against all nodes on a bounded sample of queries; below the target the overlap is doubled and
   the search repeated. Every link is verified in double precision: none below the threshold is reported.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
another length than the most common one; rows with a null id count as copies but are never named; repeated rows count as
copies; an empty table gives an empty result; labels and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import Staging
from .common import slices
from .components import connected_components

THRESHOLD = 0.95
SHARD = 1000          # nodes per shard aimed at
SHARD_LIMIT = 2048    # nodes that a task holds
MAX_CENTROIDS = 2048  # bounds the broadcast
FIT_ROWS = 20_000     # sample for the centroids
AUDIT_QUERIES = 256
AUDIT_TARGET = 0.98
CANDIDATES, DEGREE, ALPHA, BEAM = 32, 12, 1.2, 12
OVERLAP = 3


def _unit(vectors) -> np.ndarray:
    matrix = np.stack([np.asarray(vector, dtype=np.float64) for vector in vectors])
    return matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]


def fit_centroids(sample: np.ndarray, count: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    random = np.random.default_rng(seed)
    centres = sample[random.choice(len(sample), min(count, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        sizes = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(sizes[:, None] > 1e-9, sums / np.maximum(sizes, 1e-9)[:, None], centres)
    return centres


def robust_prune(units: np.ndarray, candidates: int = CANDIDATES, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Neighbours of each vector (-1: none): nearest first, without those much nearer to a kept neighbour."""
    count = len(units)
    near = units @ units.T
    np.fill_diagonal(near, -2)
    width = min(candidates, count - 1)
    if width < 1:
        return np.full((count, 1), -1)
    order = np.argpartition(-near, width - 1, axis=1)[:, :width]
    rows = np.arange(count)[:, None]
    order = np.take_along_axis(order, np.argsort(-near[rows, order], axis=1, kind="stable"), axis=1)
    distance = np.sqrt(np.maximum(2 - 2 * near, 0))
    kept = np.full((count, degree), -1)
    size = np.zeros(count, dtype=np.int64)
    for place in range(width):
        candidate = order[:, place]
        between = distance[np.maximum(kept, 0), candidate[:, None]]
        hidden = ((kept >= 0) & (alpha * between <= distance[rows[:, 0], candidate][:, None])).any(axis=1)
        good = np.flatnonzero(~hidden & (size < degree))
        kept[good, size[good]] = candidate[good]
        size[good] += 1
    return kept


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    """Edges (node, neighbour) of one shard, with back links while a node has few."""
    ids = shard["node"].to_numpy()
    kept = robust_prune(_unit(shard["vector"]))
    source, target = np.nonzero(kept >= 0)
    target = kept[source, target]
    back = pd.DataFrame({"a": target, "b": source})
    back = back[back.groupby("a").cumcount() < DEGREE]
    a, b = np.concatenate((source, back["a"])), np.concatenate((target, back["b"]))
    return pd.DataFrame({"node": ids[a], "neighbour": ids[b]}).drop_duplicates()


def greedy_range_search(units: np.ndarray, lists: np.ndarray, queries: np.ndarray, medoid: int, threshold: float,
                        beam: int = BEAM) -> np.ndarray:
    """Which vectors (columns) are in range of each query (rows): greedy search, then expansion of what is in range."""
    count, wanted = len(units), units[queries]
    rows = np.arange(len(queries))
    likeness = np.full((len(queries), count), -2.0)  # -2: not compared

    def visit(query: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Compare the pairs that are new; which of them are in range."""
        new = (node >= 0) & (likeness[query, np.maximum(node, 0)] == -2)
        query, node = query[new], node[new]
        pairs = np.unique(query * count + node)
        query, node = pairs // count, pairs % count
        likeness[query, node] = np.einsum("ij,ij->i", wanted[query], units[node])
        return pairs[likeness[query, node] >= threshold]

    visit(rows, np.full(len(rows), medoid))
    visit(rows, queries)
    expanded = np.zeros((len(queries), count), dtype=bool)
    width = min(beam, count)
    while True:
        # The best nodes so far; go on from the first of them that is not expanded.
        best = np.argpartition(-likeness, width - 1, axis=1)[:, :width]
        score = np.where(expanded[rows[:, None], best], -3, likeness[rows[:, None], best])
        pick = score.argmax(axis=1)
        live = score[rows, pick] > -2
        if not live.any():
            break
        query, node = rows[live], best[rows, pick][live]
        expanded[query, node] = True
        visit(np.repeat(query, lists.shape[1]), lists[node].ravel())
    query, node = np.nonzero((likeness >= threshold) & ~expanded)
    while len(query):
        expanded[query, node] = True
        fresh = visit(np.repeat(query, lists.shape[1]), lists[node].ravel())
        query, node = fresh // count, fresh % count
    return likeness >= threshold


def _search(threshold: float):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        """Links (a, b) inside a shard, and the pairs (a, b) that lead out of it and are yet to be compared."""
        ids = shard["node"].to_numpy()
        units = _unit(shard["vector"])
        place = {node: at for at, node in enumerate(ids.tolist())}
        inside = [[place[n] for n in some if n in place] for some in shard["neighbours"]]
        outside = [[n for n in some if n not in place] for some in shard["neighbours"]]
        lists = np.full((len(ids), max(1, *map(len, inside))), -1)
        for at, some in enumerate(inside):
            lists[at, :len(some)] = some
        medoid = int((units @ units.mean(axis=0)).argmax())
        links, open_ = [], []
        for start in range(0, len(ids), 256):
            queries = np.arange(start, min(start + 256, len(ids)))
            found = greedy_range_search(units, lists, queries, medoid, threshold)
            query, node = np.nonzero(found)
            own = queries[query]
            different = own != node
            links.append((ids[own[different]], ids[node[different]]))
            pairs = {(q, n) for q, at in zip(own.tolist(), node.tolist()) for n in outside[at]}
            open_ += [(ids[q], n) for q, n in pairs]
        frame = pd.DataFrame({"a": np.concatenate([a for a, _ in links]), "b": np.concatenate([b for _, b in links]), "linked": True})
        leads = pd.DataFrame(open_, columns=["a", "b"]).assign(linked=False)
        return pd.concat([frame, leads]).astype({"a": "int64", "b": "int64", "linked": bool})
    return run


def _cosine(a, b):
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return dot / (norm(a) * norm(b))


def nodes_of(vectors: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, distinct vectors as nodes)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    usable = F.coalesce((F.size("embedding") > 0) & ~bad & (norm > 0), F.lit(False))
    # Zero has two signs; they are one number.
    plain = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0).cast("float")).otherwise(x.cast("float")))
    rows = vectors.select("vec_id", F.when(usable, plain).alias("vector"))
    rows = staging.write(rows.select("vec_id", F.xxhash64("vector").alias("k1"), F.xxhash64("vector", F.lit(1)).alias("k2"), "vector"), "rows")
    sizes = rows.where("vector IS NOT NULL").groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    length = sizes["size"] if sizes else 0
    rows = rows.withColumn("usable", F.coalesce(F.size("vector") == length, F.lit(False)))
    nodes = rows.where("usable").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    return rows, staging.write(nodes, "nodes")


def _shards(nodes: DataFrame, centres: np.ndarray, overlap: int, staging: Staging) -> DataFrame:
    """(shard, node, vector)."""
    sent = nodes.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            near = _unit(batch.column(1).to_pylist()) @ sent.value.T
            width = min(overlap, near.shape[1])
            best = np.argpartition(-near, width - 1, axis=1)[:, :width]
            owner = pa.array(np.repeat(np.arange(len(near)), width))
            yield pa.RecordBatch.from_arrays([pa.array(best.ravel(), type=pa.int64()), batch.column(0).take(owner), batch.column(1).take(owner)],
                                             names=["centre", "node", "vector"])

    placed = staging.write(nodes.select("node", "vector").mapInArrow(assign, "centre long, node long, vector array<float>"), "placed")
    # A crowded centre: blocks of half the limit, and a shard for every two of them. A row per centre.
    blocks = placed.groupBy("centre").agg(F.count("*").alias("n")).select(
        "centre", F.when(F.col("n") <= SHARD_LIMIT, 1).otherwise(F.ceil(F.col("n") / (SHARD_LIMIT / 2.5))).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.concat_ws(
        "-", "centre", F.least(own, other), F.greatest(own, other)))
    return placed.join(F.broadcast(blocks), "centre").select(F.explode(pairs).alias("shard"), "node", "vector")


def find_links(nodes: DataFrame, staging: Staging, threshold: float = THRESHOLD, overlap: int = OVERLAP) -> DataFrame:
    """(a, b) with a < b of all different nodes found in range."""
    named = nodes.where("node IS NOT NULL")
    count = named.count()
    if count < 2:
        return nodes.sparkSession.createDataFrame([], "a long, b long")
    share = min(1.0, FIT_ROWS / count)
    dice = F.pmod(F.xxhash64("node", F.lit("fit")), F.lit(1_000_000))
    sample = named.where(dice < max(1, int(share * 1_000_000))).select("node", "vector").orderBy("node").collect() or named.select(
        "node", "vector").limit(1).collect()
    centres = fit_centroids(_unit([row["vector"] for row in sample]), min(MAX_CENTROIDS, max(1, -(-count * overlap // SHARD))))
    queries = _audit_pairs(named, count, threshold, staging)
    while True:
        shards = _shards(named, centres, overlap, staging)
        links = staging.write(_linked(named, shards, threshold, staging), "links")
        wanted, reached = queries.count(), queries.join(links, ["a", "b"]).count()
        if reached >= AUDIT_TARGET * wanted or overlap >= len(centres):
            return links
        overlap *= 2


def _audit_pairs(nodes: DataFrame, count: int, threshold: float, staging: Staging) -> DataFrame:
    """True links (a < b) of a bounded sample of queries, by comparing them with all nodes."""
    dice = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1_000_000_000))
    sample = nodes.where(dice < int(min(1.0, AUDIT_QUERIES / count) * 1_000_000_000)).select("node", "vector").collect()
    if not sample:
        return nodes.sparkSession.createDataFrame([], "a long, b long")
    sent = nodes.sparkSession.sparkContext.broadcast((np.array([row["node"] for row in sample]), _unit([row["vector"] for row in sample])))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = sent.value
        for batch in slices(batches, 1024):
            own = np.array(batch.column(0).to_pylist())
            query, node = np.nonzero(units @ _unit(batch.column(1).to_pylist()).T >= threshold)
            a, b = ids[query], own[node]
            keep = a != b
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep])], names=["a", "b"])

    return staging.write(nodes.select("node", "vector").mapInArrow(compare, "a long, b long").distinct(), "audit")


def _linked(nodes: DataFrame, shards: DataFrame, threshold: float, staging: Staging) -> DataFrame:
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = staging.write(shards.repartition(parts, "shard"), "shards")
    edges = shards.groupBy("shard").applyInPandas(_build, "node long, neighbour long")
    graph = staging.write(edges.groupBy("node").agg(F.collect_set("neighbour").alias("neighbours")), "graph")
    searched = shards.join(graph, "node", "left").withColumn("neighbours", F.coalesce("neighbours", F.array().cast("array<long>")))
    pairs = staging.write(searched.groupBy("shard").applyInPandas(_search(threshold), "a long, b long, linked boolean"), "pairs")
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    known = staging.write(ordered(pairs.where("linked")).distinct(), "known")
    left = nodes.select(F.col("node").alias("a"), F.col("vector").alias("va"))
    right = nodes.select(F.col("node").alias("b"), F.col("vector").alias("vb"))
    seen = known
    open_ = ordered(pairs.where("NOT linked")).distinct().join(known, ["a", "b"], "left_anti")
    while True:
        # Vectors travel with the pairs that lead out of a shard only.
        compared = open_.join(left, "a").join(right, "b").select("a", "b", (_cosine(F.col("va"), F.col("vb")) >= threshold).alias("linked"))
        compared = staging.write(compared, "compared")
        fresh = compared.where("linked").select("a", "b")
        if fresh.isEmpty():
            return known
        seen = seen.unionByName(compared.select("a", "b"))
        known = staging.write(known.unionByName(fresh), "known")
        both = fresh.unionByName(fresh.select(F.col("b").alias("a"), F.col("a").alias("b")))
        further = both.join(graph.withColumnRenamed("node", "b"), "b").select("a", F.explode("neighbours").alias("b")).where("a <> b")
        open_ = ordered(further).distinct().join(seen, ["a", "b"], "left_anti")


def near_duplicates(vectors: DataFrame, staging: Staging, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vec_id`` and ``embedding``."""
    rows, nodes = nodes_of(vectors, staging)
    links = find_links(nodes, staging, threshold)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = nodes.select(F.col("node").alias("b"), "n")
    others = both.join(sizes, "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    parts = connected_components(links, staging)
    classes = nodes.drop("vector").join(others, "node", "left").join(parts, "node", "left").select(
        "k1", "k2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    classes = staging.write(classes, "classes")
    linked = rows.where("usable").select("vec_id", "k1", "k2").join(classes, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
