import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from tables import documents, none, prose

from farelake.llm import components, simhash
from farelake.llm.registry import op2_simhash_near_dedup
from farelake.session import Staging


def reference(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[n:n + 3]).encode(), 42) for n in range(max(1, len(words) - 2))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components_of(pairs):
    """{node: smallest id} by brute force; pairs are (id, fingerprint)."""
    values = sorted({fp for _, fp in pairs})
    parent = {fp: fp for fp in values}

    def root(fp):
        while parent[fp] != fp:
            fp = parent[fp]
        return fp

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 3 and root(a) != root(b):
                parent[root(b)] = root(a)
    smallest = {}
    for node, fp in pairs:
        if node is not None:
            smallest[root(fp)] = min(smallest.get(root(fp), node), node)
    return {fp: smallest.get(root(fp)) for fp in values}


@pytest.mark.parametrize("text", [None, "", " \t\r\n\x0b\x0c ", "One", "A b", "A b C", "É é ß Straße", "a b c d e", prose(1), "x " * 5000,
                                  "same same same same", "🙂 🙃 x"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == reference(text)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "_SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(prose(5)) % (1 << 64) == reference(prose(5))


def test_awkward_rows(spark):
    docs = documents(spark).withColumn("fp", F.lit("own")).withColumn("component", F.lit(0))
    rows = simhash.simhash_components(docs, Staging(spark)).collect()
    assert len(rows) == docs.count()
    given = [(row["doc_id"], row["fp"] % (1 << 64)) for row in rows]
    wanted = components_of(given)
    assert all(row["component_id"] == wanted[row["fp"] % (1 << 64)] for row in rows)
    assert {row["component_id"] for row in rows if row["doc_id"] in (30, 31, 32, 33)} == {30}
    assert simhash.simhash_components(none(spark), Staging(spark)).count() == 0


@pytest.mark.parametrize("block", [1024, 4])
def test_links_against_brute_force(spark, block):
    pick = random.Random(3)
    values = [pick.getrandbits(64) for _ in range(60)]
    for value in list(values):
        for _ in range(6):  # chains and clusters around the threshold, in all places of the word
            value ^= sum(1 << place for place in pick.sample(range(64), pick.randrange(1, 5)))
            values.append(value)
    centre = pick.getrandbits(64)
    values += [centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    values = list(dict.fromkeys(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4)
    links = simhash.fingerprint_links(table, Staging(spark), block)
    pairs = links.collect()
    found = {row["node"]: row["component"] for row in components.connected_components(links, Staging(spark)).collect()}
    wanted = components_of(list(zip(range(len(values)), values)))
    groups = {}
    for value, own in zip(values, signed):
        groups.setdefault(wanted[value], set()).add(found.get(own, own))
    assert all(len(group) == 1 for group in groups.values())
    assert len({next(iter(group)) for group in groups.values()}) == len(groups)
    assert len(pairs) < 32 * len(values)  # forests, not all links


def test_components(spark):
    pick = random.Random(1)
    edges = [(n, n + 1) for n in range(100, 160)] + [(7, n) for n in range(200, 400)] + [(5, 5), (None, 3), (400, 399), (400, 399)]
    edges += [(pick.randrange(1000, 1100), pick.randrange(1000, 1100)) for _ in range(60)]
    parent = {}

    def root(n):
        while parent.setdefault(n, n) != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    table = spark.createDataFrame(edges, "a long, b long")
    found = {row["node"]: row["component"] for row in components.connected_components(table, Staging(spark)).collect()}
    assert found == {n: root(n) for n in parent}
    assert components.connected_components(table.where("false"), Staging(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = documents(spark).withColumn("_llm", F.lit(1))
    kept = simhash.keep_first(docs, Staging(spark))
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [row["doc_id"] for row in rows]
    assert ids.count(3) == 1 and not {20, 21, 41} & set(ids)
    assert [i for i in ids if i in (30, 31, 32, 33)] == [30]
    assert ids.count(None) == 1  # the one with a text of its own
    assert set(range(12)) <= set(ids)
    assert simhash.keep_first(none(spark), Staging(spark)).count() == 0


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = op2_simhash_near_dedup(spark, folder).collect()
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    given = [(row["doc_id"], reference(texts[row["doc_id"]])) for row in rows]
    wanted = components_of(given)
    for row, (_, fp) in zip(rows, given):
        assert row["fingerprint"] == f"{fp:016x}" and row["component_id"] == wanted[fp]
