import random

import pytest
from pyspark.sql import functions as F
from tables import WORDS, documents, none, prose

from farelake.llm import licenses
from farelake.llm.registry import op4_license_scan


def brute_force(text):
    """{license: best containment} over all windows of the scan's lengths at every word."""
    words, found = licenses.words_of(text or ""), {}
    for name, template in licenses.TEMPLATES.items():
        own = licenses.words_of(template)
        wanted = set(licenses.shingles_of(own))
        length = licenses.window_of(len(own))[0]
        size = min(len(own), licenses.SHINGLE)
        for at in range(len(words)):
            window = words[at:at + length]
            got = {" ".join(window[n:n + size]) for n in range(len(window) - size + 1)}
            share = len(got & wanted) / len(wanted)
            if share >= licenses.CONTAINMENT:
                found[name] = max(found.get(name, 0), share)
    return found


def edited(words, edits, pick):
    words = list(words)
    for _ in range(edits):
        words[pick.randrange(len(words))] = pick.choice(WORDS)
    return " ".join(words)


def test_against_brute_force(spark):
    pick = random.Random(4)
    texts = []
    for n in range(60):
        name, template = pick.choice(list(licenses.TEMPLATES.items()))
        notice = edited(template.split(), pick.choice((0, 0, 1, 2)), pick)
        texts.append((n, f"{prose(n)}\n{notice.upper() if n % 3 else notice}\n{prose(n + 100)}"))
    texts += [(60 + n, t) for n, t in enumerate(licenses.TEMPLATES.values())] + [(80, " ".join(licenses.TEMPLATES.values()))]
    texts += [(81, "license " * 300), (82, "All rights. Reserved"), (83, "all rights to be reserved")]
    rows = licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = {(row["doc_id"], row["license"]): row["containment"] for row in rows}
    wanted = {(n, name): share for n, text in texts for name, share in brute_force(text).items()}
    assert len(rows) == len(got) and set(got) == set(wanted)
    assert all(got[key] <= wanted[key] for key in got)
    assert sum(got[key] == wanted[key] for key in got) >= 0.9 * len(got)  # windows begin at steps: the best may be shorter by a word


def test_first_word(spark):
    rows = licenses.scan_licenses(spark.createDataFrame([(1, "one two. All rights reserved.")], "doc_id long, text string")).collect()
    assert [(row["license"], row["first_word"], row["windows"], row["containment"]) for row in rows] == [("all-rights-reserved", 2, 1, 1.0)]


@pytest.mark.parametrize("name", licenses.TEMPLATES)
def test_a_match_needs_one_of_the_words(name):
    words = licenses.words_of(licenses.TEMPLATES[name])
    shingles, needed = licenses.shingles_of(words), licenses.needed_words(words)
    without = [s for s in shingles if not needed & set(s.split())]
    assert len(without) < licenses.CONTAINMENT * len(shingles)
    worst = licenses.worst_similarity(len(words))
    assert 1 - (1 - worst ** licenses.ROWS) ** licenses.BANDS > 0.999


def test_awkward_rows(spark):
    notice = licenses.TEMPLATES["mit"]
    docs = documents(spark, [(70, notice, None, None, None)] * 2 + [(None, notice, None, None, None)]).withColumns(
        {"license": F.lit("own"), "start": F.lit(1), "band": F.lit(2)})
    rows = licenses.scan_licenses(docs).collect()
    assert sorted(str(row["doc_id"]) for row in rows) == ["70", "None"]
    assert licenses.scan_licenses(none(spark)).count() == 0
    assert licenses.scan_licenses(docs, {}).count() == 0 and licenses.scan_licenses(docs, {"x": "..."}).count() == 0


def test_runs_without_python(spark):
    plan = licenses.scan_licenses(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow"))


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {(row["doc_id"], row["license"]) for row in op4_license_scan(spark, folder).collect()}
    wanted = {(n, name) for n, text in texts.items() if "icense" in text or "ights" in text for name in brute_force(text)}
    assert got == wanted and got
