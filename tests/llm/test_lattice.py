import weakref
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tables import documents, none, prose

from farelake.llm import lattice
from farelake.llm.common import once_per_worker
from farelake.llm.registry import op10_sentencepiece
from farelake.session import Staging

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello  wörld\n\n foo\t bar the thntreation", " leading", "trailing  ", "   ", "\n", "a\nb", "don't stop; (really)... #1 $2.50 a_b",
    "aaaaaaaa bbbbbbb", "漢字とかな and русский текст", "🙂🙃", "x" * 59, "y" * 60, "ab" * 400, "é combining", "1234567890 12,345.67",
    "###$$$ word### $$$word", "if(x==y){return;} // code", "\x00\x01", " nbsp wide", "\r\n", "http://a.b/c?d=e&f=g", "▁mark",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("hot", [lattice.HOT_UNITS, 3, 0])
def test_ids_equal_the_library(spark, library, hot):
    docs = documents(spark, [(1000 + n, text, None, None, None) for n, text in enumerate(TEXTS)]).withColumns(
        {"unit": F.lit("own"), "n": F.lit(1), "piece": F.lit(2)})
    given = {row["doc_id"]: row["text"] for row in docs.where("doc_id IS NOT NULL").collect()}
    out = lattice.digests(lattice.decode(lattice.encode(docs, PATH, Staging(spark), hot), PATH), PATH)
    assert out.columns == [*docs.columns, "ids", "decoded", "ids_crc32", "decoded_crc32"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for row in rows:
        if row["doc_id"] is None:
            assert row["ids"] in (None, library.encode(prose(40)))
            continue
        text = given[row["doc_id"]]
        if text is None:
            assert row["ids"] is None and row["decoded"] is None
            continue
        assert row["ids"] == library.encode(text), text[:50]
        assert row["decoded"] == text.replace("▁", " ") and row["decoded_crc32"] == zlib.crc32(row["decoded"].encode())


def test_empty_table(spark):
    assert lattice.encode(none(spark), PATH, Staging(spark)).count() == 0


def test_best_path_of_a_probability_model(spark):
    scores = {"▁": -3.0, "a": -2.0, "b": -2.1, "ab": -3.5, "ba": -3.3, "aba": -6.1, "▁a": -4.0, "bab": -5.0, "▁ab": -6.5}
    pieces = [*(f"<0x{byte:02X}>" for byte in range(256)), *scores]
    model = lattice.PieceModel(tuple(pieces), tuple([0.0] * 256 + list(scores.values())), tuple(p in scores for p in pieces),
                               tuple(range(256)), merges=False)
    units = ["▁a", "▁abab", "▁babab", "▁abba", "b", "▁abc", "abababab"]

    def best(unit):
        paths = {0: (0.0, [])}
        for end in range(1, len(unit) + 1):
            options = []
            for start in range(end):
                part = unit[start:end]
                if start in paths and (part in scores or len(part) == 1):
                    ids = [pieces.index(part)] if part in scores else list(part.encode())
                    options.append((paths[start][0] + scores.get(part, -1e10), paths[start][1] + ids))
            if options:
                paths[end] = max(options, key=lambda option: option[0])
        return paths[len(unit)][1]

    rows = lattice.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), model).collect()
    assert {row["unit"]: row["ids"] for row in rows} == {unit: best(unit) for unit in units}
    encoder = lattice.UnitEncoder(model, {})
    assert [np.frombuffer(encoder.of_unit(unit), dtype="<i4").tolist() for unit in units] == [best(unit) for unit in units]


def test_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = op10_sentencepiece(spark, folder).collect()
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]])
        code = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert (row["n_tokens"], row["ids_crc32"], row["round_trip"]) == (len(ids), code, True)


def test_rows_of_ids_are_decoded_together(library):
    """One list of ids per row took a third of the query's CPU."""
    surface, texts = lattice.Surface(lattice.load_model(PATH)), ["", "plain words", "  two  spaces ", "😀é́\n", "last"]
    rows = pa.array([[1, 2], None, *map(library.encode, texts), None, []], type=pa.list_(pa.int32())).slice(1)
    assert surface.texts(rows) == [None, *(text.encode() for text in texts), None, b""]
    assert surface.texts(rows.slice(0, 1)) == [None]


def test_a_worker_lets_go_of_what_it_kept_before_it_makes_the_next():
    """Two encoders in one worker went beyond the memory of an executor."""
    class Kept:
        pass

    def next_one():
        return "gone" if first() is None else "still held"

    first = weakref.ref(once_per_worker("test-slot", 1, Kept))
    assert first() is not None
    assert once_per_worker("test-slot", 2, next_one) == "gone"
