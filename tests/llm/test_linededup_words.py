import random
from collections import defaultdict

import pytest

from farelake.llm import linededup
from farelake.llm.registry import op6_line_dedup
from farelake.session import Staging


def brute_force(texts, least):
    """{id: lines to delete} by looking at every run of lines in order; words are those of str.split()."""
    places, cut = defaultdict(list), defaultdict(set)
    for i, text in sorted(texts.items()):
        lines = text.split("\n")
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(len(line.split()) for line in lines[a:b + 1]) >= least:
                    places[tuple(lines[a:b + 1])].append((i, a, b))
    for found in places.values():
        for i, a, b in sorted(found)[1:]:
            cut[i] |= set(range(a, b + 1))
    return cut


@pytest.mark.parametrize("least", [1, 4, 9])
def test_tabs_padding_and_blank_lines_against_brute_force(spark, least):
    pick = random.Random(least)
    lines = ["", "a\tb\tc", "", "d" + " " * 30 + "e", "f g　h", " \t ", "  i ", "j k l"]
    texts = {n: "\n".join(pick.choice(lines[:pick.choice((3, 5, 8))]) for _ in range(pick.randrange(0, 22))) for n in range(40)}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = linededup.deduplicate_lines(table, Staging(spark), least, wordless=0).collect()
    assert {row["doc_id"]: set(row["deleted_lines"]) for row in rows if row["deleted_lines"]} == brute_force(texts, least)


def test_words_of_a_line_are_those_of_split_without_a_regular_expression(spark):
    """Matching a class of all white space took two thirds of the query's CPU."""
    white = [chr(i) for i in range(0x110000) if chr(i).isspace() and chr(i) != "\n"]
    lines = ["", " ", "  a", "a  ", "\x00", "é\u200bñ", "😀 😀", *white, *(f"a{c}b" for c in white), *(f"{c}{c}a {c}𝒳{c}" for c in white)]
    table = spark.createDataFrame([(7, "\n".join(lines))], "doc_id long, text string")
    found = linededup._lines(table)
    assert [row["words"] for row in found.orderBy("line").collect()] == [len(line.split()) for line in lines]
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_query_counts_words(spark, tmp_path):
    table = "\n".join("\t".join(f"c{row}x{n}" for n in range(6)) for row in range(10))
    padded = "\n".join(f"left{n}" + " " * 60 + f"right{n}" for n in range(4))
    blank = "own" + "\n" * 70
    held = "\n".join(f"w{n} " * 5 + "\n" * 60 for n in range(10))
    texts = [table, padded, blank, held]
    spark.createDataFrame([(n, texts[n % 4]) for n in range(8)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {row["doc_id"]: row["n_deleted"] for row in op6_line_dedup(spark, str(tmp_path)).collect()}
    assert rows == {**dict.fromkeys(range(4), 0), 4: 10, 5: 0, 6: 0, 7: held.count("\n") + 1}
