import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import none

from farelake.llm import neargraph
from farelake.llm.registry import op7_embedding_near_dedup
from farelake.session import Staging

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(vectors, threshold=neargraph.THRESHOLD):
    """{id: (links, component)} of (id, vector or None)."""
    usable = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in vectors
              if v is not None and all(x is not None for x in v) and np.isfinite(np.array(v, dtype=float)).all() and np.any(v)]
    ids = [i for i, _ in usable]
    matrix = np.stack([v / np.linalg.norm(v) for _, v in usable])
    near = matrix @ matrix.T >= threshold
    np.fill_diagonal(near, False)
    label = list(range(len(ids)))
    order = sorted(range(len(ids)), key=lambda at: ids[at])
    component = {}
    for at in order:
        if at in component:
            continue
        stack = [at]
        component[at] = ids[at]
        while stack:
            for other in np.flatnonzero(near[stack.pop()]):
                if other not in component:
                    component[other] = ids[at]
                    stack.append(other)
    found = {i: (0, i) for i, _ in vectors}
    found.update({ids[at]: (int(near[at].sum()), component[at]) for at in label})
    return found


def near(vector, random, spread):
    return (vector + spread * random.normal(size=len(vector)) / np.sqrt(len(vector))).tolist()


def made(seed=0, singles=300, groups=12, dims=16):
    random = np.random.default_rng(seed)
    vectors = [random.normal(size=dims).tolist() for _ in range(singles)]
    for _ in range(groups):
        centre = random.normal(size=dims)
        vectors += [near(centre, random, s) for s in random.uniform(0, 1.5, size=random.integers(2, 30))]
    vectors += [vectors[5]] * 40 + [(2 * np.array(vectors[6], dtype=np.float32)).tolist()]
    return list(enumerate(vectors))


@pytest.mark.parametrize("limit,shard", [(2048, 1000), (60, 50)])
def test_against_brute_force(spark, monkeypatch, limit, shard):
    monkeypatch.setattr(neargraph, "SHARD_LIMIT", limit)
    monkeypatch.setattr(neargraph, "SHARD", shard)
    vectors = made()
    table = spark.createDataFrame([(i, v, 1) for i, v in vectors], SCHEMA).repartition(4)
    rows = neargraph.near_duplicates(table, Staging(spark)).collect()
    wanted = brute_force(vectors)
    assert len(rows) == len(vectors)
    found, true = sum(row["n_links"] for row in rows), sum(n for n, _ in wanted.values())
    assert all(row["n_links"] <= wanted[row["vec_id"]][0] for row in rows)  # none below the threshold
    assert found >= 0.98 * true
    assert np.mean([row["component_id"] == wanted[row["vec_id"]][1] for row in rows]) >= 0.98
    assert all(row["kept"] == (row["component_id"] == row["vec_id"]) for row in rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [nan, 1.0]),
               (9, [inf, 1.0]), (10, [None, 1.0]), (11, [-1.0, 0.0]), (12, [1.0, -0.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in vectors] + [(13, [1.0, 0.0, 0.0], 1)], SCHEMA).withColumns(
        {"node": F.lit("own"), "n": F.lit(1), "vector": F.lit(2)})
    rows = {row["vec_id"]: (row["n_links"], row["component_id"]) for row in neargraph.near_duplicates(table, Staging(spark)).collect()}
    assert rows == {**{i: (0, i) for i in range(4, 14)}, 1: (3, 1), 2: (3, 1), 3: (3, 1), 12: (3, 1)}
    repeated = spark.createDataFrame([(1, [1.0, 0.0], 1)] * 2 + [(None, [1.0, 0.0], 1)], SCHEMA)
    assert sorted(map(str, neargraph.near_duplicates(repeated, Staging(spark)).select("vec_id", "n_links", "component_id").collect())) == sorted(
        ["Row(vec_id=1, n_links=2, component_id=1)"] * 2 + ["Row(vec_id=None, n_links=2, component_id=1)"])
    for some in (none(spark, SCHEMA), table.where("vec_id = 5")):
        assert neargraph.near_duplicates(some, Staging(spark)).count() == some.count()


def test_pruning_keeps_the_nearest():
    random = np.random.default_rng(2)
    units = random.normal(size=(80, 8))
    units /= np.linalg.norm(units, axis=1)[:, None]
    kept = neargraph.robust_prune(units, candidates=30, degree=8)
    likeness = units @ units.T - 3 * np.eye(80)
    assert (kept[:, 0] == likeness.argmax(axis=1)).all()
    distance = np.sqrt(2 - 2 * np.clip(units @ units.T, -1, 1))
    for node, some in enumerate(kept):
        some = some[some >= 0]
        for at, b in enumerate(some):  # none is hidden by one kept before it
            assert all(neargraph.ALPHA * distance[a, b] > distance[node, b] for a in some[:at])


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    wanted = brute_force([(row["vec_id"], row["embedding"]) for row in table.collect()])
    rows = op7_embedding_near_dedup(spark, folder).collect()
    assert {row["vec_id"]: (row["n_links"], row["component_id"]) for row in rows} == wanted
