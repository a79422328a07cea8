import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import none

from farelake.llm import collisions
from farelake.llm.registry import op11_nearest_neighbours
from farelake.session import Staging

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows, is_query, count):
    """{query id: [(score, id)]} of (id, vector) rows with distinct ids."""
    usable = [(i, v) for i, v in rows if i is not None and v and all(c is not None for c in v) and np.isfinite(v).all() and any(v)]
    found = {}
    for i, v in usable:
        if is_query(i):
            scored = sorted((-math.fsum(np.array(v) * np.array(w)), j) for j, w in usable if j != i)
            found[i] = [(-score, j) for score, j in scored[:count]]
    return found


def results(df):
    found = {}
    for row in sorted(df.collect(), key=lambda row: (row["query_id"], row["rank"])):
        found.setdefault(row["query_id"], []).append((row["score"], row["vec_id"]))
        assert row["rank"] == len(found[row["query_id"]])
    return found


def recall(found, wanted):
    hits = total = 0
    for query, best in wanted.items():
        least = best[-1][0]
        hits += min(len(best), sum(score >= least for score, _ in found[query]))
        total += len(best)
    return hits / total


def made(seed=0):
    """Clusters of near and exact copies, evenly spread ones, norms of several sizes."""
    random = np.random.default_rng(seed)
    vectors = [(random.normal(size=12) * random.choice([0.01, 1, 1, 1, 40])).tolist() for _ in range(500)]
    centre = random.normal(size=12)
    vectors += [(centre + 0.01 * random.normal(size=12)).tolist() for _ in range(60)] + [vectors[7]] * 300
    return list(enumerate(vectors))


def checked(found, wanted, least):
    assert found.keys() == wanted.keys()
    for query, best in found.items():
        true = dict((j, score) for score, j in wanted[query])
        assert len(best) == len(wanted[query])
        assert best == sorted(best, key=lambda one: (-one[0], one[1]))
        assert all(score == true[j] for score, j in best if j in true)
    assert recall(found, wanted) >= least


@pytest.mark.parametrize("shard,block", [(16_384, 1024), (100, 30)])
def test_against_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(collisions, "SHARD_ROWS", shard)
    monkeypatch.setattr(collisions, "BLOCK_QUERIES", block)
    rows = made()
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3).withColumns(
        {name: F.lit("own") for name in ("k1", "k2", "vector", "entries", "shard", "rank")})
    got = collisions.nearest_neighbours(table, Staging(spark), lambda i: i % 5 == 0)
    found = results(got)
    wanted = brute_force(rows, lambda i: i % 5 == 0, 20)
    checked(found, wanted, 0.95)
    assert found[565] == wanted[565]  # ties between copies go to the smaller ids
    audited = {row["recall"] for row in got.select("recall").distinct().collect()}
    assert len(audited) == 1 and 0.95 <= audited.pop() <= 1


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (3, [-1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [None, 1.0]), (10, [0.0, 1.0]), (None, [1.0, 0.0]), (20, [0.0, 0.0]), (40, [1.0, -0.0]), (60, None)]
    table = spark.createDataFrame([(i, v, 1) for i, v in [*rows, (0, [1.0, 0.0])]] + [(12, [1.0, 2.0, 3.0], 1)], SCHEMA)
    found = results(collisions.nearest_neighbours(table, Staging(spark), lambda i: i % 20 == 0, 4))
    assert found == brute_force(rows, lambda i: i % 20 == 0, 4)
    assert found[0] == [(1.0, 2), (1.0, 40), (0.5, 1), (0.0, 10)]
    # One id with two vectors is two rows.
    twice = spark.createDataFrame([(0, [1.0, 0.0], 1), (0, [0.0, 1.0], 1), (1, [3.0, 1.0], 1)], SCHEMA)
    rows = collisions.nearest_neighbours(twice, Staging(spark), lambda i: i % 20 == 0).select("query_id", "vec_id", "score").collect()
    assert sorted(map(tuple, rows)) == [(0, 0, 0.0), (0, 0, 0.0), (0, 1, 1.0), (0, 1, 3.0)]
    for some in (none(spark, SCHEMA), table.where("vec_id = 60"), table.where("vec_id = 1")):
        assert collisions.nearest_neighbours(some, Staging(spark), lambda i: i % 20 == 0).count() == 0


def test_far_ranges(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e300, 0.0]), (2, [1e-300, 1e-300]), (3, [-1e300, 1.0]), (4, [1.0, 1.0])]
    got = results(collisions.nearest_neighbours(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), Staging(spark), lambda i: i % 4 == 0))
    assert [j for _, j in got[0]] == [1, 4, 2, 3] and got[0][0][0] == math.inf
    assert [j for _, j in got[4]] == [0, 1, 2, 3]


def test_certainty_of_the_threshold():
    """Points at exactly the radius reach the threshold as often as stated, whatever their direction."""
    random = np.random.default_rng(4)
    threshold = collisions.collision_threshold()
    for dims in (3, 12, 65):
        directions = collisions.axes(dims, collisions.PROJECTIONS)
        assert directions.shape == (collisions.PROJECTIONS, dims)
        far = random.normal(size=(4000, dims))
        far /= np.linalg.norm(far, axis=1)[:, None]
        reached = (np.abs(far @ directions.T) <= collisions.WIDTH).sum(axis=1) >= threshold
        assert reached.mean() >= collisions.CERTAINTY - 0.02


def test_a_low_recall_lowers_the_threshold_and_raises(spark, monkeypatch):
    rows = [(i, np.random.default_rng(i).normal(size=8).tolist()) for i in range(120)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    asked = []
    monkeypatch.setattr(collisions, "_recall", lambda *_: 0.96 if len(asked) > 2 else 0.5)
    whole = collisions._found
    monkeypatch.setattr(collisions, "_found", lambda *given: asked.append(given[3]) or whole(*given))
    collisions.nearest_neighbours(table, Staging(spark), lambda i: i % 20 == 0)
    assert len(asked) == 3 and asked == sorted(asked, reverse=True)
    monkeypatch.setattr(collisions, "_recall", lambda *_: 0.5)
    monkeypatch.setattr(collisions, "collision_threshold", lambda: 2)
    with pytest.raises(RuntimeError):
        collisions.nearest_neighbours(table, Staging(spark), lambda i: i % 20 == 0)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    found = results(op11_nearest_neighbours(spark, folder))
    checked(found, brute_force([(row["vec_id"], row["embedding"]) for row in table.collect()], lambda i: i % 20 == 0, 20), 0.95)
