import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tables import documents, none, prose

from farelake.llm import linededup
from farelake.llm.registry import op6_line_dedup
from farelake.session import Staging


def weight(line):
    line = line.strip(" ")
    return max(1, line.count(" ") + 1)


def runs_of(lines, least):
    """All shortest runs with enough words, from each line on and up to each line."""
    for a in range(len(lines)):
        total = 0
        for b in range(a, len(lines)):
            total += weight(lines[b])
            if total >= least:
                yield a, b
                break
    for b in range(len(lines)):
        total = 0
        for a in range(b, -1, -1):
            total += weight(lines[a])
            if total >= least:
                yield a, b
                break


def brute_force(texts, least):
    """{id: lines to delete} by looking at every run of lines in order; texts: (id, text) with different ids."""
    ordered = [(i, text.split("\n")) for i, text in sorted(texts) if text is not None]
    places = defaultdict(list)
    for i, lines in ordered:
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(map(weight, lines[a:b + 1])) >= least:
                    places[tuple(lines[a:b + 1])].append((i, a, b))
    cut = defaultdict(set)
    for found in places.values():
        for i, a, b in sorted(found)[1:]:
            cut[i] |= set(range(a, b + 1))
    return cut


def shortest_runs(texts, least):
    """The same result from the shortest runs only: fast enough for whole tables."""
    ordered = [(i, text.split("\n")) for i, text in sorted(texts) if text is not None]
    first, cut = {}, defaultdict(set)
    for i, lines in ordered:
        for a, b in sorted(runs_of(lines, least)):
            first.setdefault(tuple(lines[a:b + 1]), (i, a))
            if first[tuple(lines[a:b + 1])] != (i, a):
                cut[i] |= set(range(a, b + 1))
    return cut


@pytest.mark.parametrize("least", [1, 4, 9, 40])
def test_against_brute_force(spark, least):
    pick = random.Random(least)
    lines = ["", "a", "b c", "d e f", "g h i j k", "  l m "]
    texts = [(n, "\n".join(pick.choice(lines[:pick.choice((2, 4, 6))]) for _ in range(pick.randrange(0, 14)))) for n in range(40)]
    wanted = brute_force(texts, least)
    assert wanted == shortest_runs(texts, least)
    table = spark.createDataFrame([*texts, (99, None)], "doc_id long, text string").repartition(3)
    rows = linededup.deduplicate_lines(table, Staging(spark), least).collect()
    assert len(rows) == len(texts) + 1
    given = dict(texts)
    for row in rows:
        if row["doc_id"] == 99:
            assert row["text"] is None
            continue
        cut = wanted.get(row["doc_id"], set())
        assert set(row["deleted_lines"]) == cut and row["deleted_lines"] == sorted(cut)
        kept = [line for at, line in enumerate(given[row["doc_id"]].split("\n")) if at not in cut]
        assert row["text"] == "\n".join(kept)


def test_awkward_rows(spark):
    docs = documents(spark).withColumns({"line": F.lit("own"), "words": F.lit(1), "n": F.lit(2)})
    out = linededup.deduplicate_lines(docs, Staging(spark))
    assert out.columns == [*docs.columns, "deleted_lines"]
    rows = out.collect()
    assert len(rows) == docs.count()
    by_id = defaultdict(list)
    for row in rows:
        by_id[row["doc_id"]].append(row)
    assert by_id[3][0]["text"] == prose(3) and by_id[20][0]["text"] == ""
    assert [row["text"] for row in by_id[21]] == ["", ""] and by_id[41][0]["text"] == ""
    assert by_id[30][0]["text"] is None and by_id[31][0]["text"] == "" and by_id[32][0]["text"] == " \n\t "
    assert linededup.deduplicate_lines(none(spark), Staging(spark)).count() == 0


def test_first_of_a_repeated_row_with_null_id_stays(spark):
    table = spark.createDataFrame([(None, prose(1)), (None, prose(1)), (4, prose(1))], "doc_id long, text string")
    rows = linededup.deduplicate_lines(table, Staging(spark)).collect()
    assert sorted(row["text"] for row in rows) == ["", prose(1), prose(1)]


def test_counts_of_an_emptied_document(spark, tmp_path):
    """Deleted and kept lines are all lines, also of a document that loses all of them."""
    passage = prose(5, 80)
    rows = [(1, passage), (2, passage), (3, passage + "\nown line"), (4, ""), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {row["doc_id"]: (row["n_deleted"], row["n_kept"]) for row in op6_line_dedup(spark, str(tmp_path)).collect()}
    lines = passage.count("\n") + 1
    assert found[1] == (0, lines) and found[2] == (lines, 0) and found[3] == (lines, 1) and found[4] == (0, 1)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    wanted, given = shortest_runs(texts, linededup.MIN_WORDS), dict(texts)
    rows = op6_line_dedup(spark, folder).collect()
    assert len(rows) == len(texts) and sum(row["n_deleted"] for row in rows) > 0
    for row in rows:
        cut = wanted.get(row["doc_id"], set())
        kept = "\n".join(line for at, line in enumerate(given[row["doc_id"]].split("\n")) if at not in cut)
        assert set(row["deleted_lines"]) == cut and row["text_crc32"] == zlib.crc32(kept.encode())
