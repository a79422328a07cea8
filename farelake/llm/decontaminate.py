"""Benchmark decontamination: pigeonhole edit matching.

Texts are sequences of words (letters and digits, lower case). An item of m words may be off by k = floor(m / 5) word
edits, a similarity of 0.8 or more. Cut into k + 1 pieces, an item with at most k edits keeps one piece whole, so every
match lies around an exact hit of a piece. An automaton finds the hits of all pieces in one pass over a text; Myers'
bit-parallel algorithm then finds the smallest distance of the item to any part of the text around the hits.

The benchmark is read in blocks of bounded size, each sent to the tasks once; any number of items takes as many passes as
it has blocks. Items of fewer than ``MIN_WORDS`` words are no evidence of copying and are not searched.

Edge cases: null and empty texts contain nothing; null items and items without words are skipped; items with equal words
are all reported; repeated documents are reported each; an empty table gives an empty result. Ties between places of an
item in one text go to the smallest distance, then the first place.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import append_columns

MIN_WORDS = 5
BLOCK_CHARS = 4_000_000  # of benchmark text in one pass
_WORD = re.compile(r"[^\W_]+")
MATCH = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
    T.StructField("first_word", T.IntegerType()), T.StructField("last_word", T.IntegerType())]))
_ARROW_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("first_word", pa.int32()),
                                   ("last_word", pa.int32())]))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def budget(words: int) -> int:
    return words // 5


def pieces(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(place, words) of budget + 1 pieces of nearly equal length."""
    parts = budget(len(words)) + 1
    for part in range(parts):
        first, last = part * len(words) // parts, (part + 1) * len(words) // parts
        yield first, words[first:last]


class Pattern:
    """Myers' bit vectors of a word sequence; Python's integers hold any length."""

    def __init__(self, words: list[str]):
        self.size = len(words)
        self.places: dict[str, int] = defaultdict(int)
        for place, word in enumerate(words):
            self.places[word] |= 1 << place

    def distances(self, text: list[str]) -> Iterator[int]:
        """Smallest edit distance of the pattern to a part of the text that ends at each word."""
        top, full = 1 << (self.size - 1), (1 << self.size) - 1
        plus, minus, score = full, 0, self.size
        get = self.places.get
        for word in text:
            equal = get(word, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (full & ~(horizontal | plus))
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = (up << 1) & full
            down = (down << 1) & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
            yield score


class Matcher:
    """Finds the items of one benchmark block in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[tuple[int, list[str]]] = []
        found: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if len(words) < MIN_WORDS:
                continue
            for place, piece in pieces(words):
                found[" " + " ".join(piece) + " "].append((len(self.items), place, len(piece)))
            self.items.append((item_id, words))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if found:
            self.automaton.make_automaton()
        self.forward = [Pattern(words) for _, words in self.items]
        self.backward = [Pattern(words[::-1]) for _, words in self.items]

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        if not self.items:
            return []
        words = words_of(text)
        joined = " " + " ".join(words) + " "
        hits: dict[int, set[int]] = defaultdict(set)
        seen, count = 0, 0
        for end, (length, owners) in self.automaton.iter(joined):
            begin = end - length + 1
            # Hits end in order, but a longer piece may begin earlier than the one before it.
            count += joined.count(" ", seen, begin) if begin >= seen else -joined.count(" ", begin, seen)
            seen = begin
            for item, place, _ in owners:
                hits[item].add(count - place)
        return sorted(match for item, diagonals in hits.items() if (match := self._verify(item, sorted(diagonals), words)))

    def _verify(self, item: int, diagonals: list[int], words: list[str]):
        item_id, item_words = self.items[item]
        size, most = len(item_words), budget(len(item_words))
        best = None
        low, high = diagonals[0] - most, diagonals[0] + size + most
        spans = []
        for diagonal in diagonals[1:]:
            if diagonal - most > high:
                spans.append((low, high))
                low = diagonal - most
            high = diagonal + size + most
        spans.append((low, high))
        for low, high in spans:
            low, high = max(low, 0), min(high, len(words))
            for at, distance in enumerate(self.forward[item].distances(words[low:high])):
                if distance <= most and (best is None or distance < best[0]):
                    best = (distance, low + at)
        if best is None:
            return None
        distance, last = best
        floor = max(0, last + 1 - size - most)
        back = self.backward[item].distances(words[floor:last + 1][::-1])
        first = last - next(at for at, value in enumerate(back) if value == distance)
        return item_id, distance, first, last


def benchmark_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``chars`` characters, one block at a time on the driver."""
    block, size = [], 0
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1])
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def with_matches(docs: DataFrame, benchmark: DataFrame, column: str = "_llm_matches", chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows and columns of ``docs`` with the benchmark items that each whole text contains."""
    parts = []
    for number, block in enumerate(benchmark_blocks(benchmark, chars)):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        cache: dict[str, Matcher] = {}

        def run(texts, sent=sent, cache=cache):
            matcher = cache.get("matcher") or cache.setdefault("matcher", Matcher(sent.value))
            return [pa.array([matcher.matches(text) for text in texts], type=_ARROW_MATCH)]

        part = f"{column}_{number}"
        docs = append_columns(docs, "text", [T.StructField(part, MATCH)], run)
        parts.append(part)
    found = F.concat(*parts) if parts else F.array().cast(MATCH)
    return docs.withColumn(column, found).drop(*parts)
