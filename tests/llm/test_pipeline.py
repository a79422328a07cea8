import inspect

import corpus_pipeline
from pyspark.sql import functions as F
from tables import documents, none
from test_linededup import shortest_runs
from test_nearcopies import kept

import __spark_entry__ as driver
from farelake.llm import decontaminate, linededup

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    names = [name for name in driver.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14)) and "pipeline" in driver.queries()
    assert [len(inspect.signature(stage).parameters) for _, stage in corpus_pipeline.STAGES] == [3] * 5


def test_stages_take_awkward_rows(spark):
    for docs in (documents(spark), none(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()


def test_stages_keep_clashing_columns(spark):
    own = {name: F.lit("own") for name in ("deleted_lines", "_llm_score", "_llm_cut", "_llm_matches", "_llm_copy", "set", "band", "line", "match")}
    docs = documents(spark).withColumns(own)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.where(" OR ".join(f"`{c}` <> 'own'" for c in own)).count() == 0, name
        assert out.count() > 0


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for (name, stage), check in zip(corpus_pipeline.STAGES, (None, lines, groups, leaks, None)):
        after = stage(spark, docs, FOLDER).cache()
        if check:
            before = {row["doc_id"]: row["text"] for row in docs.collect()}
            assert {row["doc_id"]: row["text"] for row in after.collect()} == check(spark, before), name
        docs = after
    wanted = {row["doc_id"]: (row["ids"], row["text"]) for row in docs.collect()}
    got = {row["doc_id"]: (row["ids"], row["text"]) for row in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == wanted and got


def lines(spark, texts):
    cut = shortest_runs(list(texts.items()), linededup.MIN_WORDS)
    return {i: "\n".join(line for at, line in enumerate(text.split("\n")) if at not in cut.get(i, ())) for i, text in texts.items()}


def groups(spark, texts):
    first = kept(texts)
    return {i: text for i, text in texts.items() if i in first}


def leaks(spark, texts):
    items = [(row["item_id"], row["text"]) for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    matcher = decontaminate.Matcher(items)
    return {i: text for i, text in texts.items() if not matcher.matches(text)}
