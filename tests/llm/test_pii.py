import re
from datetime import date

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tables import documents, none

from farelake.llm import pii
from farelake.llm.registry import op9_pii

FEISTEL = pii.Feistel(b"test")


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 256, 1000])
def test_permutation(size):
    assert sorted(FEISTEL.permute(n, size, "t") for n in range(size)) == list(range(size))


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 10 ** 18), st.data())
def test_permutation_of_large_sizes(size, data):
    a, b = data.draw(st.integers(0, size - 1)), data.draw(st.integers(0, size - 1))
    x, y = FEISTEL.permute(a, size, "t"), FEISTEL.permute(b, size, "t")
    assert 0 <= x < size and (x == y) == (a == b)


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


CASES = {
    "card": ["4111 1111 1111 1111", "4981021525375367", "5500-0000-0000-0004"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
    "ssn": ["123-45-6789"],
    "phone": ["+1 (437) 555-0689", "+49 30 1234 5678", "(437) 555-0689", "437-555-0689"],
    "ipv4": ["217.75.41.129", "0.0.0.0"],
    "date": ["2024-02-29", "31/12/1999", "12/31/1999", "01.02.2003"],
    "email": ["that.30@mail1.example.com", "A.b-C_9@x.org"],
}


@pytest.mark.parametrize("kind,value", [(k, v) for k, values in CASES.items() for v in values])
def test_formats(kind, value):
    text = f"see {value}, or {value}."
    out, spans = pii.pseudonymise(text, FEISTEL)
    assert [k for k, _, _ in spans] == [kind, kind] and text[spans[0][1]:spans[0][2]] == value
    fresh = out[4:out.index(",")]
    assert out == f"see {fresh}, or {fresh}."  # equal values have equal pseudonyms
    assert fresh != value and pii.pseudonymise(text, pii.Feistel(b"other"))[0] != out
    shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s)))
    if kind == "ipv4":
        assert all(0 <= int(n) <= 255 for n in fresh.split("."))
    else:
        assert shape(fresh) == shape(value)
    # The pseudonym is a valid value of its kind again.
    assert [k for k, _, _ in pii.pseudonymise(f"see {fresh},", FEISTEL)[1]] == [kind]
    if kind == "card":
        assert luhn(fresh)
    if kind == "date" and value[4] == "-":
        date.fromisoformat(fresh)


@pytest.mark.parametrize("text", [
    "4111 1111 1111 1112", "0000000000000000", "GB83WEST12345698765432", "666-12-3456", "123-00-4567", "256.1.1.1", "1.2.3.4.5", "01.2.3.4",
    "2024-02-30", "2024-13-01", "1899-12-31", "user@", "@host.com", "a@b", "version 1.2.3", "1234567", "", "no numbers"])
def test_what_fails_validation_stays(text):
    assert pii.pseudonymise(text, FEISTEL) == (text, [])


def test_one_date_in_two_formats_keeps_one_meaning():
    a, b = (pii.pseudonymise(text, FEISTEL)[0] for text in ("1999-12-31", "31/12/1999"))
    assert a.split("-") == b.split("/")[::-1]


def test_long_texts():
    text = "a" * 300_000 + " 1" * 100_000 + "@" * 1000 + " 217.75.41.129" * 3000
    assert len(pii.pseudonymise(text, FEISTEL)[1]) == 3000


def test_awkward_rows(spark):
    docs = documents(spark, [(60, "mail a.b1@c2.org", None, None, None)]).withColumn("kind", F.lit("own"))
    out = pii.pseudonymise_documents(docs, b"key")
    assert out.columns == [*docs.columns, "pii_spans"] and out.count() == docs.count()
    before = sorted(docs.select("doc_id", "text").collect(), key=str)
    for old, new in zip(before, sorted(out.select("doc_id", "text", "pii_spans").collect(), key=str)):
        assert old["doc_id"] == new["doc_id"]
        assert (old["text"] == new["text"]) == (not new["pii_spans"])
    assert pii.pseudonymise_documents(none(spark), b"key").count() == 0


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op9_pii(spark, folder).collect()
    assert len(rows) == len(texts) and sum(row["n_values"] for row in rows) > 0
    for row in rows:
        private = re.findall(r"[\w.]+@[\w.]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}", texts[row["doc_id"]])
        private += [n for n in re.findall(r"(?<!\d)\d{16}(?!\d)", texts[row["doc_id"]]) if luhn(n)]
        assert not any(value in row["text"] for value in private)
