import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tables import LONG, documents, none, prose
from tokenizers import Tokenizer

from farelake.llm import simple8b
from farelake.llm.registry import op8_token_output
from farelake.session import Staging

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 49407), st.integers(0, (1 << 64) - 1)), max_size=600))
def test_round_trip(values):
    ids = np.array(values, dtype=np.uint64)
    assert (simple8b.unpack(simple8b.pack(ids)) == ids).all()


@pytest.mark.parametrize("size", [0, 1, 4095, 4096, 4097, 20_000])
@pytest.mark.parametrize("top", [1, 2, 49408, 1 << 30, (1 << 30) + 9, (1 << 64) - 1])
def test_blocks(size, top):
    ids = np.random.default_rng(size).integers(0, top, size, dtype=np.uint64)
    payload = simple8b.pack(ids)
    assert (simple8b.unpack(payload) == ids).all()
    if size > 4096:  # a block is decoded on its own
        assert (simple8b.unpack(payload, [1]) == ids[4096:8192]).all()
        if top == 49408:
            assert len(payload) < 3 * size


def greedy(ids):
    """(selector, ids) of every word, one after another: the first selector whose ids all fit."""
    words = []
    for start in range(0, len(ids), simple8b.BLOCK_IDS):
        block = ids[start:start + simple8b.BLOCK_IDS]
        while block:
            number, count = next(((number, count) for number, (count, bits) in enumerate(simple8b.SELECTORS)
                                  if max(block[:count]) < 1 << bits), (simple8b.ESCAPE, 1))
            words.append((number, block[:count]))
            block = block[count:]
    return words


def test_words_hold_as_many_ids_as_fit():
    random = np.random.default_rng(5)
    ids = np.concatenate([np.zeros(4000), random.integers(0, 2, 600), 2.0 ** random.uniform(0, 34, 3000), np.ones(1000)]).astype(np.uint64)
    payload, words = simple8b.pack(ids), greedy(ids.tolist())
    escapes = sum(number == simple8b.ESCAPE for number, _ in words)
    n_blocks = -(-len(ids) // simple8b.BLOCK_IDS)
    assert len(payload) == 8 + 24 * n_blocks + 8 * (len(words) + escapes)
    assert (simple8b.unpack(payload) == ids).all()


def test_blocks_are_decoded_together():
    def calls(blocks):
        payload, made = simple8b.pack(np.resize(ids, blocks * simple8b.BLOCK_IDS)), 0

        def count(frame, event, arg):
            nonlocal made
            made += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            simple8b.unpack(payload)
        finally:
            sys.setprofile(None)
        return made

    ids = (2 ** np.random.default_rng(3).uniform(0, 15.5, simple8b.BLOCK_IDS)).astype(np.uint64)
    assert calls(16) - calls(1) < 15 * 20


def test_damage_is_found():
    payload = bytearray(simple8b.pack(np.arange(100, dtype=np.uint64)))
    payload[-1] ^= 1
    with pytest.raises(ValueError):
        simple8b.unpack(bytes(payload))
    with pytest.raises(ValueError):
        simple8b.unpack(b"xxxx" + bytes(payload[4:]))


TEXTS = ["Hello, World!", "it's we're 'quoted'", "naïve café é İstanbul ΣΑΣ", "a\x1cb \x1f c", "x<|endoftext|>, y <|startoftext|>.",
         "a|b|c ### $$$word%%% 12,345.67", " nbsp wide　", "", " \n\t", "漢字 🙂🙃!!", "word.́ end", "A" * 5000, "ſtrange ﬁne ½",
         "İ,", "ADANALİ.", "HACİ, dedi", "ẞ! Ǆ? ŉ;", "É, ÀÉ. œ:"]


@pytest.mark.parametrize("kept", [0, 200_000])
def test_encoder_equals_the_library(monkeypatch, kept):
    monkeypatch.setattr(simple8b.WordEncoder, "KEPT", kept)
    tokenizer, encoder = Tokenizer.from_file(PATH), simple8b.WordEncoder(PATH)
    for texts in (TEXTS, [prose(1), LONG, *TEXTS], TEXTS[::-1]):
        for text, raw in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(raw, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:40]


def test_a_word_is_looked_up_once_for_many_texts():
    class Kept(dict):
        asked = 0

        def get(self, *args):
            self.asked += 1
            return super().get(*args)

    encoder = simple8b.WordEncoder(PATH)
    encoder.kept = Kept()
    texts = ["the same, the\x85same ", "", " the\u3000\u2003same", "the\x1csame", "\tsame\n"] * 200
    assert encoder.encode(texts) == encoder._encode(texts)
    assert encoder.kept.asked <= 5


def expected(rows):
    tokenizer, start = Tokenizer.from_file(PATH), 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


@pytest.mark.parametrize("segment", [1 << 16, 50])
def test_files(spark, monkeypatch, segment):
    monkeypatch.setattr(simple8b, "SEGMENT_IDS", segment)
    docs = documents(spark).where("doc_id IS NOT NULL").withColumns({"part": F.lit("own"), "first": F.lit(1)})
    path = Staging(spark).path
    simple8b.write_corpus(docs, path, lambda: simple8b.WordEncoder(PATH))
    rows = sorted(simple8b.read_corpus(spark, path).collect(), key=lambda row: row["start"])
    got = [(row["doc_id"], row["start"], len(row["ids"]) // 4, zlib.crc32(row["ids"])) for row in rows]
    assert got == list(expected(sorted((row["doc_id"], row["text"]) for row in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())))


def test_null_ids_come_first(spark):
    docs = spark.createDataFrame([(1, "b"), (None, "a"), (None, None)], "doc_id long, text string")
    path = Staging(spark).path
    simple8b.write_corpus(docs, path, lambda: simple8b.WordEncoder(PATH))
    rows = sorted(simple8b.read_corpus(spark, path).collect(), key=lambda row: row["start"])
    assert [row["doc_id"] for row in rows] == [None, None, 1]


def test_empty_table(spark):
    path = Staging(spark).path
    simple8b.write_corpus(none(spark), path, lambda: simple8b.WordEncoder(PATH))
    assert simple8b.read_corpus(spark, path).count() == 0


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(row) for row in op8_token_output(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == list(expected(sorted(tuple(row) for row in texts)))
