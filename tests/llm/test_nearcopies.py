import random
from collections import defaultdict
from itertools import combinations

import corpus_pipeline
import pyarrow as pa
import pytest
from tables import SCHEMA, documents, none

from farelake.llm import nearcopies
from farelake.session import Staging


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[at:at + 5]) for at in range(max(len(words) - 4, 1))) if words else frozenset()


def kept(texts):
    """The smallest id of each group by brute force; texts: {id: text}."""
    sets = {i: shingles(text) for i, text in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    places = defaultdict(set)
    for i, own in sets.items():
        for shingle in own or {()}:
            places[shingle].add(i)
    for a, b in {pair for at in places.values() for pair in combinations(sorted(at), 2)}:
        both = len(sets[a] & sets[b])
        if 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i for i in texts if find(i) == i}


def test_stage_against_brute_force_jaccard(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wanted = kept({row["doc_id"]: row["text"] for row in docs.collect()})
    out = corpus_pipeline.near_duplicate_stage(spark, docs, "/root/testdata/sf0.01")
    assert {row["doc_id"] for row in out.collect()} == wanted and len(wanted) < docs.count()


def test_edits_around_the_threshold(spark):
    base = [f"w{n}" for n in range(300)]
    texts = {n: " ".join("x" + str(n) if n and at % 300 in range(7, 7 + 29 * n, 29) else w for at, w in enumerate(base)) for n in range(9)}
    texts |= {20: "one two three", 21: "One  two\tthree", 22: "one two four", 23: "", 24: " \n"}
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA).repartition(3)
    out = nearcopies.keep_first(table, Staging(spark))
    assert {row["doc_id"] for row in out.collect()} == kept(texts)


def test_chain_through_a_band_is_joined_after_the_first_comparison(spark):
    base = [f"v{n}" for n in range(400)]
    # Each step replaces four more words: neighbours are near copies, the ends are not.
    texts = {n: " ".join("y" + w if at % 20 == 3 and at < 80 * n else w for at, w in enumerate(base)) for n in range(5)}
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA)
    assert {row["doc_id"] for row in nearcopies.keep_first(table, Staging(spark)).collect()} == kept(texts) == {0}


def copies_of(base, count, changed, seed=0):
    """Copies with some words changed: near the base, but not near each other."""
    pick = random.Random(seed)
    return [" ".join(f"z{n}-{at}" if at in places else w for at, w in enumerate(base))
            for n in range(count) for places in [set(pick.sample(range(len(base)), changed))]]


@pytest.mark.parametrize("block,with_base", [(1024, True), (1024, False), (40, False)])
def test_a_large_group_makes_few_rows(spark, monkeypatch, block, with_base):
    """Rows of every step stay linear in the size of a group whose members are near its base, or near nothing."""
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    base = [f"u{n}" for n in range(200)]
    texts = dict(enumerate([" ".join(base)] * with_base + copies_of(base, 300, 4)))
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA).repartition(4)
    written = {}

    class Counted(Staging):
        def write(self, df, name):
            stored = super().write(df, name)
            written[name] = max(written.get(name, 0), stored.count())
            return stored

    assert {row["doc_id"] for row in nearcopies.keep_first(table, Counted(spark)).collect()} == kept(texts)
    bands = nearcopies.BANDS * len(texts)
    assert written["candidates"] <= bands and written["links"] <= len(texts) and max(written.values()) <= bands


def test_forest_joins_what_links_join():
    pick = random.Random(5)
    base = [f"t{n}" for n in range(60)]
    texts = copies_of(base, 12, 1) + copies_of(base, 12, 3, 1) + ["a b c d e f"] * 2
    sets = [shingles(text) for text in texts]
    parts = [pick.randrange(20) for _ in texts]
    values = [nearcopies.shingles(text).view("<i8") for text in texts]

    def components(links):
        label = list(parts)
        for _ in texts:
            for a, b in links:
                label = [min(label[a], label[b]) if one in (label[a], label[b]) else one for one in label]
        return label

    true = [(a, b) for a, b in combinations(range(len(texts)), 2) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    found = nearcopies.forest(list(range(len(texts))), parts, values)
    assert set(found) <= set(true) and len(found) < len(set(parts))
    assert components(found) == components(true)


def test_awkward_rows(spark):
    docs = documents(spark)
    out = nearcopies.keep_first(docs, Staging(spark))
    assert out.columns == docs.columns
    ids = sorted((row["doc_id"] for row in out.collect()), key=str)
    assert 3 in ids and 20 not in ids and 21 not in ids and 40 in ids and 41 not in ids and ids.count(None) == 1
    assert nearcopies.keep_first(none(spark), Staging(spark)).count() == 0


def test_anchors_join_close_copies_without_bands(spark, monkeypatch):
    """Copies within three bits are found by the SimHash anchors alone, and verified; the others then stay apart."""
    mark = nearcopies._mark

    def without_bands(batches):
        for batch in mark(batches):
            at = batch.schema.get_field_index("bands")
            yield batch.set_column(at, "bands", pa.array([[]] * batch.num_rows, pa.list_(pa.int64())))

    monkeypatch.setattr(nearcopies, "_mark", without_bands)
    pick = random.Random(3)
    words = {group: [f"g{group}w{pick.randrange(10 ** 6)}" for _ in range(1500)] for group in range(4)}
    texts = {10 * group + n: " ".join(own[:1500 - n]) for group, own in words.items() for n in range(3)}
    # Half of the words go: far more than three bits, and no near copy.
    texts |= {50 + group: " ".join(own[:750]) for group, own in words.items()}
    prints = {i: nearcopies.fingerprint_of([nearcopies.shingles(text)]) for i, text in texts.items()}
    apart = {i: ((prints[i] ^ prints[i // 10 * 10]) % 2 ** 64).bit_count() for i in texts if i < 40}
    assert max(apart.values()) <= 3
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA).repartition(3)
    out = nearcopies.keep_first(table, Staging(spark))
    assert {row["doc_id"] for row in out.collect()} == kept(texts) == {0, 10, 20, 30, 50, 51, 52, 53}
