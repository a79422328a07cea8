import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tables import documents, none
from tokenizers import Tokenizer

from farelake.llm import alignment
from farelake.llm.registry import op13_token_alignment
from farelake.session import Staging

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = ["plain words", "tabs\tand\n\nlines  with   spaces", "naïve café 東京タワー 🙂🙂 done", "<|endoftext|> and <s>", "already ▁ marked", "a" * 700,
         " " * 90, "x", "\x00 zero", "ﬁne ½ ①", "İstanbul ẞ", "🙂" * 300, "1234567890 " * 40, "deee" * 400 + "🙂"]


class Plain:
    """The contract, byte by byte."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        hidden = [n for n in range(256) if n not in shown]
        self.alphabet = {chr(n): n for n in shown} | {chr(256 + at): n for at, n in enumerate(hidden)}

    def ranges(self, pieces):
        found, at = [], 0
        for number, raw in pieces:
            found.append((number, at, at + len(raw)))
            at += len(raw)
        return found, b"".join(raw for _, raw in pieces)

    def groups(self, text):
        if not text:
            return [], [], []
        a, raw_a = self.ranges([(n, bytes(self.alphabet[c] for c in self.a.id_to_token(n))) for n in self.a.encode(" " + text, add_special_tokens=False).ids])
        names = [(n, self.b.id_to_piece(n)) for n in self.b.encode(text)]
        b, raw_b = self.ranges([(n, bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode()) for n, p in names])
        if raw_a != raw_b or raw_a != (" " + text).encode():
            return [], [], []
        cuts = sorted({end for *_, end in a} & {end for *_, end in b})
        parts = [([], []) for _ in cuts]
        for side, some in enumerate((a, b)):
            for n, _, end in some:
                parts[bisect_left(cuts, end)][side].append(n)
        return a, b, parts

    def corpus(self, texts):
        """One result per text."""
        found = [self.groups(text) for text in texts]
        links = [Counter((x, y) for some_a, some_b in parts for x in some_a for y in some_b) for *_, parts in found]
        counts = Counter(pair for some in links for pair in some)
        most = defaultdict(int)
        for (x, _), n in counts.items():
            most[x] = max(most[x], n)
        rows = []
        for (a, b, parts), some in zip(found, links):
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in parts)
            rows.append((len(a), len(b), len(parts), sum(some.values()), sum(n for (x, y), n in some.items() if counts[x, y] == most[x]),
                         sum(n * counts[pair] for pair, n in some.items()), hashlib.sha256(text.encode()).hexdigest() if parts else ""))
        return rows


def test_kept_words_give_the_library_ids():
    """Any text: words that are kept, words that are not, texts for the library."""
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    pick = random.Random(3)
    signs = [" ", " ", " ", "\n", "\t", "\r", "'", "'s", "'ll", "a", "be", "É", "ß", "ſ", "x", "7", "42", "!", "...", "×", "\x1c", "\x85", "\u00a0", "²", "字"]
    texts = ["".join(pick.choices(signs, k=pick.randrange(1, 30))) for _ in range(4000)] + TEXTS
    side = alignment.ByteLevelSide(BYTES)
    for kept in (1000, 0):
        side.KEPT = kept
        for at in range(0, len(texts), 500):
            some = texts[at:at + 500]
            wanted = [tokenizer.encode(" " + text, add_special_tokens=False).ids for text in some]
            assert [ids.tolist() for ids in side.encode(some)] == wanted


def compared(rows, texts):
    return Counter(tuple(row[name] for name in RESULT) for row in rows), Counter(Plain().corpus(texts))


@pytest.mark.parametrize("frequent", [alignment.FREQUENT_PAIRS, 40, 0])
def test_corpus_against_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "LONG_GROUP", 6)
    table = documents(spark, [(100 + at, text, None, None, None) for at, text in enumerate(TEXTS)])
    table = table.where("doc_id IS NULL OR doc_id < 40 OR doc_id >= 100").withColumns(
        {name: F.lit("own") for name in ("row", "pair", "times", "n", "best", "groups_sha256")})
    aligned = alignment.align_documents(table, BYTES, PIECES, ("pairs", "digest")).withColumn("row", F.monotonically_increasing_id())
    staging = Staging(spark)
    aligned = staging.write(aligned, "aligned")
    found = aligned.join(alignment.link_statistics(aligned, 32_000, staging, frequent), "row").collect()
    got, wanted = compared(found, [row["text"] for row in table.collect()])
    assert got == wanted


def test_groups_and_overlaps(spark):
    table = spark.createDataFrame([(at, text) for at, text in enumerate([*TEXTS, None, ""])], "doc_id long, text string")
    plain = Plain()
    for row in alignment.align_documents(table, BYTES, PIECES, ("groups", "overlaps")).collect():
        text = ([*TEXTS, None, ""])[row["doc_id"]]
        a, b, parts = plain.groups(text)
        assert row["a_ids"] == [n for n, *_ in a] and row["b_ids"] == [n for n, *_ in b]
        assert list(zip(row["group_a"], row["group_b"])) == [(len(x), len(y)) for x, y in parts]
        assert row["group_end"] == sorted({end for *_, end in a} & {end for *_, end in b})
        wanted = [(i, j) for i, (_, low, high) in enumerate(a) for j, (_, start, end) in enumerate(b) if low < end and start < high]
        assert list(zip(row["overlap_a"], row["overlap_b"])) == wanted
    with pytest.raises(ValueError):
        alignment.align_documents(table, BYTES, PIECES, ("links",))


def test_empty_and_long(spark):
    assert alignment.align_corpus(none(spark), BYTES, PIECES, Staging(spark)).count() == 0
    blank = spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id long, text string")
    rows = alignment.align_corpus(blank, BYTES, PIECES, Staging(spark)).collect()
    assert sorted(str(row["doc_id"]) for row in rows) == ["1", "1", "None"]
    assert {tuple(row[name] for name in RESULT) for row in rows} == {(0, 0, 0, 0, 0, 0, "")}
    text = "stone 🙂 garden " * 60_000
    rows = alignment.align_corpus(spark.createDataFrame([(1, text), (2, "stone")], "doc_id long, text string"), BYTES, PIECES, Staging(spark)).collect()
    got, wanted = compared(rows, ["stone 🙂 garden " * 60, "stone"])
    assert max(row["n_groups"] for row in rows) >= 1000 * (max(key[2] for key in wanted) - 60)
    assert min(row["n_a"] for row in rows) == 1


def test_held_pairs_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HELD_PAIRS", 50)
    table = documents(spark).where("doc_id < 40")
    staging = Staging(spark)
    aligned = staging.write(alignment.align_documents(table, BYTES, PIECES, ("pairs",)), "aligned")
    counts = {row["pair"]: row["n"] for row in alignment.pair_counts(aligned, 32_000).collect()}
    assert counts == Counter(pair for row in aligned.collect() for pair in row["pair"])


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = op13_token_alignment(spark, folder).collect()
    assert {row["doc_id"]: tuple(row[name] for name in RESULT) for row in rows} == dict(
        zip([row["doc_id"] for row in docs], Plain().corpus([row["text"] for row in docs])))
