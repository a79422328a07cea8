import random

import pytest
from pyspark.sql import functions as F
from tables import documents, none, prose

from farelake.llm import decontaminate as d
from farelake.llm.registry import op3_decontamination


def distance(item, text):
    """Smallest edit distance of the item to a part of the text, and the last word of the first best part."""
    above, best = list(range(len(item) + 1)), None
    for at, word in enumerate(text):
        row = [0]
        for n, own in enumerate(item, 1):
            row.append(min(above[n - 1] + (own != word), above[n] + 1, row[n - 1] + 1))
        above = row
        if best is None or row[-1] < best[0]:
            best = (row[-1], at)
    return best


def edited(words, edits, pick):
    words = list(words)
    for _ in range(edits):
        at = pick.randrange(len(words))
        kind = pick.randrange(3)
        if kind == 0:
            words[at] = "changed"
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, "added")
    return words


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(seed):
    pick = random.Random(seed)
    vocabulary = [f"v{n}" for n in range(12 if seed % 2 else 400)]
    items = [(n, " ".join(pick.choice(vocabulary) for _ in range(pick.choice((3, 5, 9, 20, 37, 90))))) for n in range(12)]
    matcher = d.Matcher(items)
    for _ in range(25):
        words = [pick.choice(vocabulary) for _ in range(60)]
        n, item = pick.choice(items)
        words[30:30] = edited(item.split(), pick.randrange(0, 1 + len(item.split()) // 3), pick)
        found = {m[0]: m for m in matcher.matches(" ".join(words).upper() + "!")}
        for n, item in items:
            own = item.split()
            best = distance(own, words)
            if len(own) < d.MIN_WORDS or best[0] > d.budget(len(own)):
                assert n not in found
            else:
                assert found[n][1] == best[0] and found[n][3] == best[1]
                part = words[found[n][2]:found[n][3] + 1]
                assert distance(own, part)[0] == best[0]


def test_awkward_rows_and_blocks(spark):
    item = " ".join(prose(70, 30).split())
    docs = documents(spark, [(50, "start " + item.upper() + " end", None, None, None), (51, prose(71) + "\n" + prose(70, 30), None, None, None)])
    docs = docs.withColumn("item_id", F.lit("own"))
    benchmark = spark.createDataFrame([(1, item), (2, None), (None, item), (3, ""), (4, "w1x w2x"), (5, item), (6, prose(4))], "item_id long, text string")
    wanted = {50: [1, 5], 51: [1, 5], 4: [6]}
    for chars in (d.BLOCK_CHARS, 1):  # one block, and one for each item
        out = d.with_matches(docs, benchmark, chars=chars)
        assert out.columns == [*docs.columns, "_llm_matches"] and out.count() == docs.count()
        for row in out.collect():
            assert [m["item_id"] for m in row["_llm_matches"]] == wanted.get(row["doc_id"], [])
    assert d.with_matches(docs, benchmark.where("false")).where("size(_llm_matches) > 0").count() == 0
    assert d.with_matches(none(spark), benchmark).count() == 0


def test_whole_table_against_exact_passages(spark):
    folder = "/root/testdata/sf0.01"
    rows = op3_decontamination(spark, folder).collect()
    items = {row["item_id"]: " ".join(d.words_of(row["text"])) for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    exact = set()
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        text = f" {' '.join(d.words_of(row['text']))} "
        exact |= {(row["doc_id"], n) for n, item in items.items() if f" {item} " in text}
    assert exact and {(row["doc_id"], row["item_id"]) for row in rows if row["distance"] == 0} == exact
