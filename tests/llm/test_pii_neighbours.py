import re

import pytest

from farelake.llm import pii

FEISTEL = pii.Feistel(b"test")


@pytest.mark.parametrize("kind,value,text", [
    ("card", "4111 1111 1111 1111", "paid by {} 12/25"),
    ("card", "4111-1111-1111-1111", "paid by {} 123"),
    ("card", "4111 1111 1111 1111", "no 12 {}"),
    ("card", "378282246310005", "amex {} 1234"),
    ("iban", "BE71 0961 2345 6769", "to {} USD"),
    ("iban", "BE71096123456769", "to {} BIC"),
    ("iban", "DE89 3704 0044 0532 0130 00", "to {} EUR 100"),
    ("iban", "BE71 0961 2345 6769", "ref AB12 {}"),
    ("date", "3/7/1985", "born {}"), ("date", "1985-7-3", "born {}"), ("date", "13.7.1985", "born {}."),
])
def test_value_beside_characters_of_its_alphabet(kind, value, text):
    given = text.format(value)
    out, spans = pii.pseudonymise(given, FEISTEL)
    at = given.index(value)
    assert (kind, at, at + len(value)) in spans and value not in out
    before, after = text.split("{}")
    assert out.startswith(before) and out.endswith(after)
    fresh = out[len(before):len(out) - len(after)]
    assert (kind, at, at + len(fresh)) in pii.pseudonymise(out, FEISTEL)[1]
    if kind == "date":
        assert re.sub(r"\d", "", fresh) == re.sub(r"\d", "", value) and not re.search(r"\b0", fresh)


def test_short_and_long_dates_keep_one_meaning():
    short, long = (re.split("/", pii.pseudonymise(text, FEISTEL)[0]) for text in ("3/7/1985", "03/07/1985"))
    assert list(map(int, short)) == list(map(int, long))
