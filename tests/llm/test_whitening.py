from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import none

from farelake.llm import whitening
from farelake.llm.registry import op12_embedding_whitening
from farelake.session import Staging

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows):
    """({(id, x): deviation}, n, covariance) of the usable (id, vector) rows, in whole numbers and fractions."""
    usable = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows
              if v and all(c is not None for c in v) and np.isfinite(v).all()]
    size = max({len(x) for _, x in usable}, key=lambda n: (sum(len(x) == n for _, x in usable), -n))
    usable = [(i, x) for i, x in usable if len(x) == size]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    y = [[n * c - s for c, s in zip(x, sums)] for x in fit]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n ** 3)) for j in range(size)] for i in range(size)])
    return [(i, x, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in usable], n, np.array(sums), cov


def compare(found, rows, components=4):
    usable, n, sums, cov = brute_force(rows)
    values = np.linalg.eigvalsh(cov)[::-1]
    width = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == len(usable) * width
    by_row = {}
    for row in found:
        by_row.setdefault((row["vec_id"], row["deviation"]), {}).setdefault(row["component"], []).append(row["whitened"])
        assert row["n"] == n and row["identity_error"] <= 1e-9
        assert row["explained"] == pytest.approx(values[row["component"] - 1] / np.trace(cov), rel=1e-9)
    assert sorted(by_row, key=str) == sorted({(i, deviation) for i, _, deviation in usable}, key=str)
    # The components as the rows show them: least squares from centred x to the projections.
    x = np.array([x for _, x, _ in usable], dtype=float) - sums / n
    z = np.array([[by_row[i, deviation][c][0] for c in range(1, width + 1)] for i, _, deviation in usable])
    for c in range(width):
        direction = np.linalg.lstsq(x, z[:, c] * np.sqrt(values[c]), rcond=None)[0]
        assert np.abs(cov @ direction - values[c] * direction).max() <= 1e-8 * values[0]
        assert np.linalg.norm(direction) == pytest.approx(1, abs=1e-8)


def test_against_brute_force(spark):
    random = np.random.default_rng(1)
    base = random.normal(size=(200, 5)) @ random.normal(size=(5, 5)) + [0, 1, -2, 3, 0.5]
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(500, base[3].tolist())] * 30 + [(None, base[4].tolist())]
    rows += [(600, None), (601, []), (602, [None] * 5), (603, [float("nan")] * 5), (604, [float("inf")] + [0.0] * 4), (605, [1.0]),
             (606, [1e300] * 5)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(5)
    table = table.withColumns({name: F.lit("own") for name in ("x", "component", "n", "whitened", "i", "j")})
    compare(whitening.whiten(table, Staging(spark)).collect(), rows[:-1])
    with_floats = table.withColumn("embedding", F.col("embedding").cast("array<float>"))
    short = [(i, None if v is None else np.array(v, dtype=np.float32).astype(float).tolist()) for i, v in rows[:231]]
    compare(whitening.whiten(with_floats.where("coalesce(vec_id, 0) < 600"), Staging(spark), 2).collect(), short, 2)


def test_square_sums_are_exact():
    random = np.random.default_rng(2)
    for scale, count in ((300, 11), (1 << 40, 5000), (1 << 60, 1 << 20)):
        x = random.integers(-scale, scale, (40, 4))
        sums = np.array([int(s) for s in x.astype(object).sum(axis=0)], dtype=object)
        y = [[count * int(c) - s for c, s in zip(row, sums)] for row in x]
        wanted = [[sum(r[i] ** 2 if i == j else (r[i] + r[j]) ** 2 for r in y) for j in range(i, 4)] for i in range(4)]
        assert whitening.square_sums(x, count, sums) == wanted


def test_no_variance(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 3, [(1, [1.0, 2.0]), (2, [1.001, 2.0])]):
        assert whitening.whiten(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), Staging(spark)).count() == 0
    assert whitening.whiten(none(spark, SCHEMA), Staging(spark)).count() == 0
    rows = [(i, [i / 2, 3.0, -i / 2]) for i in range(9)]  # one component
    compare(whitening.whiten(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), Staging(spark)).collect(), rows)


def test_huge_entries(spark):
    for power, fits in ((46, True), (54, False)):
        rows = [(i, [2.0 ** power * (i % (20 if fits else 2)), -(2.0 ** power) * (i * i % 7) / 8]) for i in range(20)]
        found = whitening.whiten(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), Staging(spark)).collect()
        if fits:
            compare(found, rows)
        else:  # more than 38 digits
            assert found and {row["deviation"] for row in found} == {None}


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    found = op12_embedding_whitening(spark, folder)
    assert dict(found.dtypes)["deviation"] == "bigint"
    compare(found.collect(), [(row["vec_id"], row["embedding"]) for row in table.collect()])
