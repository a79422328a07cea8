"""Language identification: known words first, then ever shorter character n-grams.

The model holds, per language, the log frequencies of its most frequent words and of the character n-grams of its words.
A word of a text that is known in some language adds its log frequency in every language; any other word adds the mean log
frequency of its longest known n-grams: those of four characters, or else of three, two, one. The language with the largest
sum wins; the score is its share of the likelihoods, all languages being equally likely before.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as is every text if there is nothing to learn
from. Ties go to the first language in alphabetical order. Null languages are not learned from. Repeated rows are predicted
alike; an empty table gives an empty result; only doc_id, text and lang are read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import Staging
from .common import append_columns, once_per_worker, slices

UNKNOWN = "und"
LONGEST = 4
# The model's size: documents per language that are learned from (about, by a hash of the id), words and n-grams kept.
FIT_DOCS = 5_000
WORDS = 30_000
GRAMS = 20_000
ENTRIES = 1_000_000  # of all languages together
_WORD = re.compile(r"[^\W\d_]+")
SMOOTHING = 0.5


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams_of(word: str, size: int) -> list[str]:
    """n-grams of the word between its borders; a single character is one of the word itself."""
    marked = word if size == 1 else f"^{word}$"
    return [marked[at:at + size] for at in range(len(marked) - size + 1)]


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, np.ndarray]   # log frequency in each language
    grams: dict[str, np.ndarray]
    seen: dict[str, np.ndarray | None] = field(default_factory=dict)

    def of_unseen(self, word: str) -> np.ndarray | None:
        for size in range(LONGEST, 0, -1):
            found = [self.grams[gram] for gram in grams_of(word, size) if gram in self.grams]
            if found:
                return np.mean(found, axis=0)
        return None

    def of_word(self, word: str) -> np.ndarray | None:
        known = self.words.get(word)
        if known is not None:
            return known
        if word not in self.seen:
            if len(self.seen) >= 100_000:
                self.seen.clear()
            self.seen[word] = self.of_unseen(word)
        return self.seen[word]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text))
        if not self.languages or not any(c.isalpha() for word in counts for c in word):
            return UNKNOWN, 0.0
        rows, times = [], []
        for word, n in counts.items():
            row = self.of_word(word)
            if row is not None:
                rows.append(row)
                times.append(n)
        total = np.array(times) @ np.stack(rows) if rows else np.zeros(len(self.languages))
        weight = np.exp(total - total.max())
        best = int(total.argmax())
        return self.languages[best], float(weight[best] / weight.sum())


def _log_table(rows: list, languages: list[str], totals: dict[str, int]) -> dict[str, np.ndarray]:
    """Rows (language, entry, count) as log frequencies with additive smoothing."""
    place = {language: at for at, language in enumerate(languages)}
    counts: dict[str, np.ndarray] = {}
    for language, entry, n in rows:
        counts.setdefault(entry, np.zeros(len(languages)))[place[language]] += n
    whole = np.array([max(totals.get(language, 0), 1) for language in languages]) + SMOOTHING * max(len(counts), 1)
    return {entry: np.log((n + SMOOTHING) / whole) for entry, n in counts.items()}


def _most_frequent(counts: DataFrame, languages: list[str], most: int) -> tuple[list, dict[str, int]]:
    """The ``most`` entries of each language with the highest counts (of equal counts the first ones), and all counts' sums."""
    by_count = counts.groupBy("lang", "n").agg(F.count("*").alias("entries"))
    sizes: dict[str, list] = {language: [] for language in languages}
    for row in by_count.collect():  # a row per language and different count
        sizes[row["lang"]].append((row["n"], row["entries"]))
    chosen, rest = F.lit(False), []
    for language in languages:
        taken, above = 0, 0
        own = F.col("lang") == language
        for n, entries in sorted(sizes[language], reverse=True):
            if taken + entries > most:
                # The class of counts that is cut: each task sends the first entries of it.
                rest += [tuple(row) for row in counts.where(own & (F.col("n") == n)).orderBy("entry").limit(most - taken).collect()]
                above = n
                break
            taken += entries
        chosen = chosen | (own & (F.col("n") > above))
    totals = {language: sum(n * entries for n, entries in some) for language, some in sizes.items()}
    return [*(tuple(row) for row in counts.where(chosen).collect()), *rest], totals


def fit_languages(docs: DataFrame, fit_docs: int = FIT_DOCS) -> LanguageModel:
    """Learn from ``doc_id``, ``text`` and ``lang`` of the given rows."""
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {row["lang"]: row["n"] for row in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], {}, {})
    dice = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000))
    chosen: Column = F.lit(False)
    for language, n in sizes.items():
        chosen = chosen | ((F.col("lang") == language) & (dice < int(min(1.0, fit_docs / n) * 1_000_000)))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def counted():
            for language, some in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(some), type=pa.string()), pa.array(some.keys(), type=pa.string()),
                     pa.array(some.values(), type=pa.int64())], names=["lang", "entry", "n"])
            counts.clear()

        for batch in slices(batches):
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(language, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > 200_000:  # sent on and begun anew: the table is bounded
                yield from counted()
        yield from counted()

    parts = usable.where(chosen).select("lang", "text").mapInArrow(count_words, "lang string, entry string, n long")
    staging = Staging(docs.sparkSession)
    words = staging.write(parts.groupBy("lang", "entry").agg(F.sum("n").alias("n")), "words")
    marked = words.select("lang", "n", "entry", F.concat(F.lit("^"), "entry", F.lit("$")).alias("marked"))
    singles = marked.select("lang", "n", F.explode(F.split("entry", "")).alias("entry")).where("entry <> ''")
    grams = singles
    for size in range(2, LONGEST + 1):
        starts = marked.where(F.length("marked") >= size).select("lang", "n", "marked", F.explode(
            F.sequence(F.lit(1), F.length("marked") - (size - 1))).alias("at"))
        grams = grams.unionByName(starts.select("lang", "n", F.substring("marked", F.col("at"), F.lit(size)).alias("entry")))
    grams = staging.write(grams.groupBy("lang", "entry").agg(F.sum("n").alias("n")), "n-grams")
    share = ENTRIES // len(languages)
    word_rows, word_totals = _most_frequent(words.select("lang", "entry", "n"), languages, min(WORDS, share))
    gram_rows, gram_totals = _most_frequent(grams.select("lang", "entry", "n"), languages, min(GRAMS, share))
    # n-grams of one length share one total: it is that of their length in the language, up to a factor common to all.
    model = LanguageModel(languages, _log_table(word_rows, languages, word_totals), _log_table(gram_rows, languages, gram_totals))
    staging.drop()
    return model


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Append lang_pred and score."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.words, model.grams))
    key = uuid.uuid4().hex

    def run(texts):
        model = once_per_worker("languages", key, lambda: LanguageModel(*sent.value))
        found = [model.predict(text) for text in texts]
        return [pa.array([f[0] for f in found], type=pa.string()), pa.array([f[1] for f in found], type=pa.float64())]

    return append_columns(docs, "text", [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], run)
