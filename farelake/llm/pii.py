"""Format-preserving pseudonyms for personal numbers, dates and addresses (keyed Feistel permutations).

Found and validated: IBANs (mod 97), card numbers (Luhn), US social security numbers, phone numbers, IPv4 addresses, dates
from 1900 to 2099 and e-mail addresses. A value is read as a number below the size of its format, permuted by a Feistel
network with the caller's key, and written in its own format: separators, letter case and check digits stay right. The
permutation depends on the key and the format only, so equal values have equal pseudonyms in all documents and different
values have different ones. Numbers that fail validation are left as they are.

Of a card or IBAN every admissible length is tried from each start, longest first, and after a start with no valid value
the scan goes on one character further; so an expiry date, a security code, a currency or a word behind the value does not
hide it. Days and months have one digit or two; beside a one-digit one they are written without a leading zero again.

Edge cases: a null text stays null with no spans; an empty text stays empty; overlapping candidates go to the first of the
list above; repeated rows are treated alike; an empty table gives an empty result; all other columns are kept.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import append_columns, free_name

ROUNDS = 10
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


class Feistel:
    """Keyed permutations of 0 … size - 1."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, number: int, value: int, size: int) -> int:
        data = tweak + b"|%d|%d" % (number, value)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big") % size

    def permute(self, value: int, size: int, tweak: str, valid: Callable[[int], bool] = lambda _: True) -> int:
        """Steps through the permutation of a rectangle until it is inside the size and valid again (cycle walking)."""
        if size < 2:
            return value
        height = math.isqrt(size - 1) + 1
        width = -(-size // height)
        mark = f"{tweak}|{size}".encode()
        while True:
            left, right = divmod(value, width)
            for number in range(0, ROUNDS, 2):
                left = (left + self._round(mark, number, right, height)) % height
                right = (right + self._round(mark, number + 1, left, width)) % width
            value = left * width + right
            if value < size and valid(value):
                return value


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _refill(text: str, digits: str) -> str:
    """The text with its digits replaced one by one."""
    fresh = iter(digits)
    return "".join(next(fresh) if c in "0123456789" else c for c in text)


def luhn_digit(payload: str) -> str:
    total = 0
    for place, c in enumerate(reversed(payload)):
        n = int(c) * (2 if place % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _card(text: str, feistel: Feistel) -> str | None:
    digits = _digits(text)
    if len(set(digits)) == 1 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    size = len(digits) - 1
    fresh = f"{feistel.permute(int(digits[:-1]), 10 ** size, 'card'):0{size}d}"
    return _refill(text, fresh + luhn_digit(fresh))


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _mixed(characters: str) -> tuple[int, int]:
    """Value and size of letters and digits as a number with one base per place."""
    value, size = 0, 1
    for c in characters:
        base, digit = (10, int(c)) if c in "0123456789" else (26, ord(c.lower()) - 97)
        value, size = value * base + digit, size * base
    return value, size


def _unmixed(value: int, characters: str) -> str:
    out = []
    for c in reversed(characters):
        if c in "0123456789":
            value, digit = divmod(value, 10)
            out.append(str(digit))
        else:
            value, digit = divmod(value, 26)
            out.append(chr(digit + (97 if c.islower() else 65)))
    return "".join(reversed(out))


def _iban(text: str, feistel: Feistel) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    account = plain[4:]
    value, size = _mixed(account)
    shape = "".join("d" if c.isdigit() else "l" for c in account)
    fresh = _unmixed(feistel.permute(value, size, f"iban|{plain[:2]}|{shape}"), account)
    check = 98 - _mod97(fresh + plain[:2] + "00")
    letters = iter(plain[:2] + f"{check:02d}" + fresh)
    return "".join(c if c == " " else next(letters) for c in text)


def _ssn_valid(value: int) -> bool:
    area, group, serial = value // 1_000_000, value // 10_000 % 100, value % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(text: str, feistel: Feistel) -> str | None:
    value = int(_digits(text))
    return _refill(text, f"{feistel.permute(value, 10 ** 9, 'ssn', _ssn_valid):09d}") if _ssn_valid(value) else None


def _ipv4(text: str, feistel: Feistel) -> str | None:
    parts = text.split(".")
    if any(int(part) > 255 or (len(part) > 1 and part[0] == "0") for part in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, feistel.permute(value, 1 << 32, "ipv4").to_bytes(4, "big")))


def _phone(text: str, feistel: Feistel) -> str | None:
    digits = _digits(text)
    if not 7 <= len(digits) <= 15:
        return None
    # The country code, up to the first separator, stays.
    country = len(_digits(re.match(r"\+\d{1,3}(?=\D)|\+\d{1,3}|", text)[0])) if text[0] == "+" else 0
    if len(digits) - country > 10:
        country = len(digits) - 10
    rest = digits[country:]
    return _refill(text, digits[:country] + f"{feistel.permute(int(rest), 10 ** len(rest), 'phone|' + digits[:country]):0{len(rest)}d}")


_FIRST_DAY, _LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def _date(text: str, feistel: Feistel) -> str | None:
    numbers = [int(n) for n in re.findall(r"\d+", text)]
    # Year first, or day first, or else month first.
    orders = [(0, 1, 2)] if numbers[0] > 999 else [(2, 1, 0), (2, 0, 1)]
    for order in orders:
        try:
            day = date(*(numbers[place] for place in order)).toordinal()
        except ValueError:
            continue
        if not _FIRST_DAY <= day <= _LAST_DAY:
            return None
        fresh = date.fromordinal(_FIRST_DAY + feistel.permute(day - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, "date"))
        parts = [0, 0, 0]
        for place, value in zip(order, (fresh.year, fresh.month, fresh.day)):
            parts[place] = value
        given = re.findall(r"\d+", text)
        short = any(len(part) == 1 for part in given)
        widths = [4 if place == order[0] else 1 if short and given[place][0] != "0" else 2 for place in range(3)]
        texts = iter(f"{value:0{width}d}" for value, width in zip(parts, widths))
        return re.sub(r"\d+", lambda _: next(texts), text)
    return None


def _email(text: str, feistel: Feistel) -> str | None:
    """All letters and digits but those of the top-level domain."""
    name, _, top = text.rpartition(".")
    characters = "".join(c for c in name if c.isalnum())
    value, size = _mixed(characters)
    shape = re.sub("[a-zA-Z]", "l", re.sub("[0-9]", "d", name))
    fresh = iter(_unmixed(feistel.permute(value, size, f"email|{shape}"), characters))
    return "".join(next(fresh) if c.isalnum() else c for c in name) + "." + top


_CARD = re.compile(r"(?<!\d)\d(?:[ -]?\d){12,18}", re.ASCII)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?= ?[A-Z0-9])", re.ASCII)
_IBAN_OF = {n: re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){%d}%s(?![A-Za-z0-9])" % (n // 4 - 1, f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else ""), re.ASCII)
            for n in range(34, 14, -1)}
# Characters of an IBAN by country; for other countries every length is tried.
_IBAN_LENGTH = {country: length for length, countries in {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "HR CH LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", re.ASCII)
_IPV4 = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)", re.ASCII)
_PHONE = re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)"
                    r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-]*\d)", re.ASCII)
_DATE = re.compile(r"(?<![\d./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![./-]?\d)", re.ASCII)
_DIGIT = re.compile(r"\d", re.ASCII)
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z", re.ASCII)
_DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])", re.ASCII)


def _card_ends(text: str, match: re.Match) -> Iterator[int]:
    places = [at for at in range(*match.span()) if text[at] in "0123456789"]
    for last in reversed(places[12:]):
        if text[last + 1:last + 2] not in tuple("0123456789"):
            yield last + 1


def _iban_ends(text: str, match: re.Match) -> Iterator[int]:
    length = _IBAN_LENGTH.get(match[0][:2])
    for n in [length] if length else _IBAN_OF:
        if whole := _IBAN_OF[n].match(text, match.start()):
            yield whole.end()


def _one_end(text: str, match: re.Match) -> Iterator[int]:
    yield match.end()


# IBANs come first: the digits of one may hold a number that passes as a card.
_FORMATS = (("iban", _IBAN, _iban_ends, _iban), ("card", _CARD, _card_ends, _card), ("ssn", _SSN, _one_end, _ssn),
            ("phone", _PHONE, _one_end, _phone), ("ipv4", _IPV4, _one_end, _ipv4), ("date", _DATE, _one_end, _date))


def pseudonymise(text: str, feistel: Feistel) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and the (kind, start, end) of what was replaced, places in the given text."""
    found: list[tuple[int, int, str, str]] = []

    def free(start: int, end: int) -> bool:
        after = bisect.bisect(found, (start,))
        return (not after or found[after - 1][1] <= start) and (after == len(found) or found[after][0] >= end)

    at = text.find("@")
    while at >= 0:  # addresses are looked for around each sign, so that long words cost nothing
        local, domain = _LOCAL.search(text, max(0, at - 64), at), _DOMAIN.match(text, at + 1)
        if local and domain:
            start = local.start() + len(local[0]) - len(local[0].lstrip(".%+-"))
            if start < at and text[at - 1] != "." and free(start, domain.end()):
                bisect.insort(found, (start, domain.end(), "email", _email(text[start:domain.end()], feistel)))
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        for kind, pattern, ends, convert in _FORMATS:
            match = pattern.search(text)
            while match:
                start, after = match.start(), match.start() + 1
                for end in ends(text, match):
                    if free(start, end) and (fresh := convert(text[start:end], feistel)) is not None:
                        bisect.insort(found, (start, end, kind, fresh))
                        after = end
                        break
                match = pattern.search(text, after)
    if not found:
        return text, []
    parts, last = [], 0
    for start, end, _, fresh in found:
        parts += [text[last:start], fresh]
        last = end
    return "".join(parts) + text[last:], [(kind, start, end) for start, end, kind, _ in found]


def pseudonymise_documents(docs: DataFrame, key: bytes, spans: str = "pii_spans") -> DataFrame:
    """All rows and columns with the pseudonyms in ``text``; adds the replaced spans, in place of an own column of that name."""
    docs = docs.drop(spans)
    text_field = free_name(docs, "_llm_pseudonyms")

    def run(texts):
        feistel = Feistel(key)
        done = [(None, []) if text is None else pseudonymise(text, feistel) for text in texts]
        return [pa.array([text for text, _ in done], type=pa.string()), pa.array(
            [[{"kind": k, "start": a, "end": b} for k, a, b in some] for _, some in done], type=_ARROW_SPANS)]

    added = append_columns(docs, "text", [T.StructField(text_field, T.StringType()), T.StructField(spans, SPANS)], run)
    return added.withColumn("text", added[text_field]).drop(text_field)
