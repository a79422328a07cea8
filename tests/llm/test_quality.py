import numpy as np
from pyspark.sql import functions as F
from tables import documents, none, prose

from farelake.llm import quality
from farelake.llm.registry import op1_quality_classifier


def junk(seed):
    return " | ".join(prose(seed).split()) + "###"


def labelled(spark):
    rows = [(100 + n, junk(n) if n % 2 else prose(n), None, None, None) for n in range(60)]
    labels = spark.createDataFrame([(100 + n, 1 - n % 2, 0) for n in range(60)] + [(None, 1, 0), (100, None, 0), (7777, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    return documents(spark, rows), labels


def test_separates_good_from_bad_and_scores_every_row(spark):
    docs, labels = labelled(spark)
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
    assert len(scored) == docs.count()
    for row in scored:
        assert 0 <= row["score"] <= 1
        if row["doc_id"] is not None and row["doc_id"] >= 100:
            assert (row["score"] >= 0.5) == (row["doc_id"] % 2 == 0)
    twins = [row["score"] for row in scored if row["doc_id"] in (3, 20, 21)]
    assert len(twins) == 4 and len(set(twins)) == 1


def test_keeps_columns_with_clashing_names(spark):
    docs, labels = labelled(spark)
    wide = docs.withColumns({"score": F.lit("own"), "quality": F.lit(9), "_llm": F.lit(1)})
    out = quality.score_quality(wide, quality.fit_quality(wide, labels), "_llm_score")
    assert out.columns == [*wide.columns, "_llm_score"]
    assert {row["score"] for row in out.collect()} == {"own"}


def test_without_one_of_the_labels_everything_is_accepted(spark):
    docs, labels = labelled(spark)
    for some in (labels.where("quality = 1"), labels.where("false")):
        scored = quality.score_quality(docs, quality.fit_quality(docs, some))
        assert {row["score"] for row in scored.collect()} == {0.5}
    assert quality.score_quality(none(spark), quality.fit_quality(none(spark), labels)).count() == 0


def test_loss_is_at_its_minimum():
    random = np.random.default_rng(1)
    rows = random.normal(size=(200, quality.FEATURES))
    labels = (rows[:, 0] + 0.5 * random.normal(size=200) > 0).astype(int)
    model = quality.fit_bradley_terry(rows, labels, pairs=2000)
    strength = (rows - model.centre) @ model.weights
    assert (strength[labels == 1][:, None] > strength[labels == 0][None]).mean() > 0.95
    # The threshold is as good as any other value of the strengths.
    right = lambda cut: ((strength >= cut) == (labels == 1)).sum()
    assert right(model.threshold) >= max(right(cut) for cut in strength) - 1


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = op1_quality_classifier(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = scored.join(labels, "doc_id").where("held_out")
    assert held.where("predicted = quality").count() >= 0.95 * held.count() > 0
    assert scored.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
