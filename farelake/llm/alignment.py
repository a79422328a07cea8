"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

1. Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (SentencePiece) the text, which it puts a space
   before. A token's bytes give its range in that common byte string; the documents of a batch lie end to end, so a
   position belongs to one document.
2. ``pandas.merge_asof``, keyed by document, finds for the start of every token the token of the other side that covers it;
   the union of both directions is all pairs of tokens that overlap.
3. Overlapping tokens with equal ends close a group. Two token occurrences are linked if they share a group.
4. How many documents hold an id pair linked is counted over the corpus: distinct pairs per document, summed in the task
   before they are shuffled. A document's links then look up these counts: the most frequent pairs (``FREQUENT_PAIRS``, a
   bound of the broadcast) where they occur, all others by an equi-join, in which no pair is hot any more.

Texts that are null, empty, or whose tokens of either side do not add up to the space and the text (the second tokenizer
changes some texts, for example U+2581 to a space) have no tokens: all numbers are 0, all lists empty, the digest is ''.
Special tokens' strings inside a text are plain text. Rows with a null id are aligned like others; repeated rows count as
documents of their own; an empty table gives an empty result; other columns than ``doc_id`` and ``text`` are not read.
A text is aligned whole, in memory; batches of texts are cut at about ``BATCH_BYTES``. A long group links distinct ids
with their numbers, so a run that never ends together on both sides costs its distinct ids, not its occurrences squared.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import Staging
from .common import once_per_worker

BATCH_BYTES = 1 << 20
FREQUENT_PAIRS = 1 << 17
HELD_PAIRS = 1 << 21    # pairs that a task holds while it counts them
LONG_GROUP = 4096       # occurrence pairs of a group beyond which distinct ids are counted first
OUTPUTS = ("groups", "overlaps", "pairs", "digest")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes are themselves, the others follow 255."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + at): byte for at, byte in enumerate(others)}


class ByteLevelSide:
    """A byte-level BPE file of the tokenizers library; texts get a space before them.

    Its pre-tokenizer splits a text into words that are encoded one by one, so the ids of words are kept. Texts with other
    characters than ``PLAIN`` go to the library whole: there its classes of letters, numbers and spaces decide.
    """

    KEPT = 400_000  # words kept in a worker
    LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
    PLAIN = re.compile(rf"[\t\n\r -~{LETTERS}]*")
    WORDS = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
    SPACED = re.compile(rf" [{LETTERS}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # A task is one thread; the library's own threads would contend with the other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        entries = [self.tokenizer.id_to_token(number) or "" for number in range(self.tokenizer.get_vocab_size())]
        self.pieces = [bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode() for entry in entries]
        self.lengths = np.array([len(piece) for piece in self.pieces], dtype=np.int64)
        self.kept: dict[str, bytes | None] = {}

    def _library(self, texts: list[str]) -> list[bytes | None]:
        """Ids as 32-bit numbers; None where they don't spell the text."""
        found = []
        for text, one in zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = one.ids
            found.append(np.array(ids, dtype="<i4").tobytes() if b"".join(map(self.pieces.__getitem__, ids)) == text.encode() else None)
        return found

    def _learn(self, words: list[str]) -> dict[str, bytes | None]:
        spaced = [word for word in words if self.SPACED.fullmatch(word)]
        others = [word for word in words if not self.SPACED.fullmatch(word)]
        fresh = dict(zip(others, self._library(others)))
        for at in range(0, len(spaced), 1000):
            some = spaced[at:at + 1000]
            raw = self._library(["".join(some)])[0]
            # Words of letters after a space stay apart, so every word ends with a token.
            token_ends = np.cumsum(self.lengths[np.frombuffer(raw, dtype="<i4")]) if raw is not None else np.zeros(0)
            word_ends = np.cumsum([len(word.encode()) for word in some])
            stops = 4 * (np.searchsorted(token_ends, word_ends) + 1)
            if raw is None or not np.isin(word_ends, token_ends).all():
                fresh.update(zip(some, self._library(some)))
            else:
                fresh.update(zip(some, (raw[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist()))))
        if len(self.kept) < self.KEPT:
            self.kept.update(fresh)
        return fresh

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """The ids of each text; None where they don't spell a space and the text."""
        look = self.kept.get
        words = [self.WORDS.findall(" " + text) if self.PLAIN.fullmatch(text) else None for text in texts]
        found = [None if some is None else list(map(look, some)) for some in words]
        gaps = [[] if some is None else [at for at, ids in enumerate(some) if ids is None] for some in found]
        unseen = {words[row][at] for row, places in enumerate(gaps) for at in places}
        fresh = self._learn(list(unseen)) if unseen else {}
        whole = iter(self._library([" " + text for text, some in zip(texts, words) if some is None]))
        encoded = []
        for row, places in enumerate(gaps):
            for at in places:
                found[row][at] = fresh[words[row][at]]
            raw = next(whole) if found[row] is None else None if None in found[row] else b"".join(found[row])
            encoded.append(None if raw is None else np.frombuffer(raw, dtype="<i4").astype(np.int64))
        return encoded


class PieceSide:
    """A SentencePiece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [bytes([int(model.id_to_piece(n)[3:5], 16)]) if model.is_byte(n) else model.id_to_piece(n).replace("▁", " ").encode()
                       for n in range(model.get_piece_size())]
        self.lengths = np.array([len(piece) for piece in self.pieces], dtype=np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """The ids of each text; None where they don't spell a space and the text."""
        spell = self.pieces.__getitem__
        return [np.array(ids, dtype=np.int64) if b"".join(map(spell, ids)) == b" " + text.encode() else None
                for text, ids in zip(texts, self.model.encode(texts, num_threads=1))]


def tokens(encoded: list[np.ndarray], lengths: np.ndarray) -> pd.DataFrame:
    """(doc, id, start, end) of the tokens of documents that lie end to end."""
    ids = np.concatenate([np.zeros(0, dtype=np.int64), *encoded])
    ends = np.cumsum(lengths[ids])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(encoded)), [len(one) for one in encoded]), "id": ids,
                         "start": ends - lengths[ids], "end": ends})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of tokens that share a byte."""
    def covering(own: pd.DataFrame, other: pd.DataFrame) -> np.ndarray:
        """The other side's token over the start of each own token."""
        right = pd.DataFrame({"doc": other["doc"], "start": other["start"], "at": np.arange(len(other))})
        return pd.merge_asof(own[["doc", "start"]], right, on="start", by="doc")["at"].to_numpy(np.int64)

    over_a, over_b = covering(a, b), covering(b, a)
    # Pairs with equal starts are found from both sides.
    new = a["start"].to_numpy()[over_b] != b["start"].to_numpy()
    return np.concatenate((np.arange(len(a)), over_b[new])), np.concatenate((over_a, np.flatnonzero(new)))


@dataclass
class Aligned:
    """Tokens of a batch with the number of their group; groups are numbered through the batch, in order."""

    a: pd.DataFrame
    b: pd.DataFrame
    pairs: tuple[np.ndarray, np.ndarray]
    group_a: np.ndarray
    group_b: np.ndarray
    group_doc: np.ndarray


def align(a: pd.DataFrame, b: pd.DataFrame) -> Aligned:
    """Overlaps, and the groups that equal ends cut the tokens into."""
    left, right = overlaps(a, b)
    closing = a["end"].to_numpy()[left] == b["end"].to_numpy()[right]

    def groups(count: int, last: np.ndarray) -> np.ndarray:
        closes = np.zeros(count, dtype=np.int64)
        closes[last] = 1
        return np.cumsum(closes) - closes

    group_a, group_b = groups(len(a), left[closing]), groups(len(b), right[closing])
    return Aligned(a, b, (left, right), group_a, group_b, a["doc"].to_numpy()[np.sort(left[closing])])


def linked_pairs(found: Aligned, docs: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links per document; document, pair, number of links) of the distinct linked pairs, in order; a pair is a * width + b."""
    groups = len(found.group_doc)
    n_a, n_b = np.bincount(found.group_a, minlength=groups), np.bincount(found.group_b, minlength=groups)
    links = np.zeros(docs, dtype=np.int64)
    np.add.at(links, found.group_doc, n_a * n_b)
    ids_a, ids_b = found.a["id"].to_numpy(), found.b["id"].to_numpy()
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    step = int(ids_a.max(initial=0) + 1) * width
    long_ = n_a * n_b > LONG_GROUP
    # Every token of A meets all of its group's tokens of B.
    repeats = np.where(long_, 0, n_b)[found.group_a]
    owner = np.repeat(np.arange(len(ids_a)), repeats)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(repeats) - repeats, repeats)
    other = ids_b[first_b[found.group_a[owner]] + place]
    keys = found.a["doc"].to_numpy()[owner] * step + ids_a[owner] * width + other
    keys, times = np.unique(keys, return_counts=True)
    if long_.any():
        more_keys, more_times = [keys], [times]
        for group in np.flatnonzero(long_):
            some_a, of_a = np.unique(ids_a[first_a[group]:first_a[group] + n_a[group]], return_counts=True)
            some_b, of_b = np.unique(ids_b[first_b[group]:first_b[group] + n_b[group]], return_counts=True)
            more_keys.append((found.group_doc[group] * step + some_a[:, None] * width + some_b[None, :]).ravel())
            more_times.append((of_a[:, None] * of_b[None, :]).ravel())
        keys, inverse = np.unique(np.concatenate(more_keys), return_inverse=True)
        times = np.zeros(len(keys), dtype=np.int64)
        np.add.at(times, inverse, np.concatenate(more_times))
    return links, keys // step, keys % step, times


def spelled(found: Aligned, docs: int, names: list[bytes], offset: int) -> list[bytes]:
    """Each document as ``a1,a2|b1;a3|b2,b3``; ``names`` holds every id with the two marks that can follow it."""
    groups = len(found.group_doc)
    n_a, n_b = np.bincount(found.group_a, minlength=groups), np.bincount(found.group_b, minlength=groups)
    ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
    last_a, last_b = np.zeros(len(found.a), dtype=np.int64), np.zeros(len(found.b), dtype=np.int64)
    last_a[ends_a - 1], last_b[ends_b - 1] = 1, 1
    # A group's tokens of A come behind all tokens of B before it, its tokens of B behind its tokens of A.
    order = np.empty(len(found.a) + len(found.b), dtype=np.int64)
    order[np.arange(len(found.a)) + (ends_b - n_b)[found.group_a]] = 2 * found.a["id"].to_numpy() + last_a
    order[np.arange(len(found.b)) + ends_a[found.group_b]] = offset + 2 * found.b["id"].to_numpy() + last_b
    sizes = np.bincount(found.a["doc"], minlength=docs) + np.bincount(found.b["doc"], minlength=docs)
    stops = np.cumsum(sizes)
    codes, spell = order.tolist(), names.__getitem__
    return [b"".join(map(spell, codes[stop - size:stop]))[:-1] for stop, size in zip(stops.tolist(), sizes.tolist())]


def _names(side: ByteLevelSide | PieceSide, inside: bytes, last: bytes) -> list[bytes]:
    return [str(number).encode() + mark for number in range(len(side.pieces)) for mark in (inside, last)]


def _lists(values: np.ndarray, owners: np.ndarray, docs: int, kind: pa.DataType) -> pa.Array:
    """One list per document of values that are ordered by document."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=docs))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def encoded_batch(texts: list[str | None], a: ByteLevelSide, b: PieceSide) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of both sides; none for texts that one of the sides does not reproduce."""
    full = [at for at, text in enumerate(texts) if text]
    some = [texts[at] for at in full]
    ids_a = [np.zeros(0, dtype=np.int64)] * len(texts)
    ids_b = list(ids_a)
    for at, in_a, in_b in zip(full, a.encode(some), b.encode(some)):
        if in_a is not None and in_b is not None:
            ids_a[at], ids_b[at] = in_a, in_b
    return ids_a, ids_b


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BATCH_BYTES`` of text."""
    for batch in batches:
        column = batch.column("text")
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
        part = np.cumsum(sizes) // BATCH_BYTES
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(starts, starts[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)


def align_documents(docs: DataFrame, path_a: str, path_b: str, outputs: Iterable[str] = ("groups",)) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links`` of every row of ``doc_id`` and ``text``, and the asked outputs.

    groups: ``a_ids``, ``b_ids`` and, per group, ``group_a`` and ``group_b`` (numbers of tokens) and ``group_end`` (the offset
    behind it in the space and the text). overlaps: token numbers ``overlap_a``, ``overlap_b`` of all overlapping pairs.
    pairs: distinct linked id pairs as ``pair`` = a * (size of B's vocabulary) + b with their number of links ``times``.
    digest: ``groups_sha256`` over the ids of all groups, spelled ``a1,a2|b1;a3|b2,b3``.
    """
    wanted = frozenset(outputs)
    if wanted - set(OUTPUTS):
        raise ValueError(f"unknown outputs {sorted(wanted - set(OUTPUTS))}")
    kinds = {"groups": "a_ids array<int>, b_ids array<int>, group_a array<int>, group_b array<int>, group_end array<long>",
             "overlaps": "overlap_a array<int>, overlap_b array<int>", "pairs": "pair array<long>, times array<long>",
             "digest": "groups_sha256 string"}
    schema = ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long",
                        *(kinds[name] for name in OUTPUTS if name in wanted)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = once_per_worker("byte-level", path_a, lambda: ByteLevelSide(path_a))
        b = once_per_worker("pieces", path_b, lambda: PieceSide(path_b))
        names = once_per_worker("names", (path_a, path_b), lambda: [*_names(a, b",", b"|"), *_names(b, b",", b";")])
        for batch in _batches(batches):
            ids_a, ids_b = encoded_batch(batch.column("text").to_pylist(), a, b)
            count = batch.num_rows
            found = align(tokens(ids_a, a.lengths), tokens(ids_b, b.lengths))
            links, owner, pair, times = linked_pairs(found, count, len(b.pieces))
            long_ = lambda values: pa.array(values, pa.int64())
            columns = {"doc_id": batch.column("doc_id"), "n_a": long_([len(one) for one in ids_a]), "n_b": long_([len(one) for one in ids_b]),
                       "n_groups": long_(np.bincount(found.group_doc, minlength=count)), "n_links": long_(links)}
            if "groups" in wanted:
                doc_a, doc_b, at = found.a["doc"], found.b["doc"], found.group_doc
                # Offsets start at 0 in each document.
                before = np.concatenate(([0], np.cumsum([int(a.lengths[one].sum()) for one in ids_a])))[:-1]
                ends = found.a["end"].to_numpy()[np.cumsum(np.bincount(found.group_a, minlength=len(at))) - 1] if len(at) else at
                columns |= {"a_ids": _lists(found.a["id"], doc_a, count, pa.int32()), "b_ids": _lists(found.b["id"], doc_b, count, pa.int32()),
                            "group_a": _lists(np.bincount(found.group_a, minlength=len(at)), at, count, pa.int32()),
                            "group_b": _lists(np.bincount(found.group_b, minlength=len(at)), at, count, pa.int32()),
                            "group_end": _lists(ends - before[at], at, count, pa.int64())}
            if "overlaps" in wanted:
                left, right = found.pairs
                order = np.lexsort((right, left))
                left, right = left[order], right[order]
                doc = found.a["doc"].to_numpy()[left]
                first = lambda ids: np.cumsum([0, *map(len, ids)])[:-1]
                columns |= {"overlap_a": _lists(left - first(ids_a)[doc], doc, count, pa.int32()),
                            "overlap_b": _lists(right - first(ids_b)[doc], doc, count, pa.int32())}
            if "pairs" in wanted:
                columns |= {"pair": _lists(pair, owner, count, pa.int64()), "times": _lists(times, owner, count, pa.int64())}
            if "digest" in wanted:
                texts = spelled(found, count, names, 2 * len(a.pieces))
                columns["groups_sha256"] = pa.array([hashlib.sha256(text).hexdigest() if text else "" for text in texts], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, documents) over the task's rows; a pair comes again when more than ``HELD_PAIRS`` were held."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([pair for pair, _ in held]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([n for _, n in held])).astype(np.int64)

    def rows(pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    for batch in batches:
        # The pairs of a document are distinct.
        pair, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
        held.append((pair, n))
        size += len(pair)
        if size > HELD_PAIRS:
            held = [merged()]
            size = len(held[0][0])
            if size > HELD_PAIRS // 2:
                yield rows(*held[0])
                held, size = [], 0
    if held:
        yield rows(*merged())


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n documents that hold it linked, best: no pair of this id of A is in more documents)."""
    counts = aligned.select("pair").mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return counts.select("pair", "n", F.expr(f"pair div {width}").alias("a"))


def _frequent(counts: DataFrame, most: int) -> pa.Table:
    """Pairs of the highest counts, ``most`` at most, in order. Classes of counts (a quarter of an octave) are taken whole."""
    level = F.floor(F.log2("n") * 4).cast("int")
    sizes = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # at most 4 * 64 rows
    lowest, taken = None, 0
    for row in sizes:
        taken += row["count"]
        if taken > most:
            break
        lowest = row["level"]
    return counts.where(level >= lowest if lowest is not None else F.lit(False)).select("pair", "n", "best").toArrow().sort_by("pair")


def link_statistics(aligned: DataFrame, width: int, staging: Staging, frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """``row, n_best, count_sum`` of each row of stored alignments with ``row``, ``pair`` and ``times``.

    n_best: links whose pair is in as many documents as any pair of its id of A; count_sum: documents of its pair, over all
    links.
    """
    counts = staging.write(pair_counts(aligned, width), "pair-counts")
    # One row per id of A: the vocabulary bounds the broadcast.
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = staging.write(counts.join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    table = _frequent(counts, frequent)
    sent = aligned.sparkSession.sparkContext.broadcast(tuple(table[name].to_numpy() for name in ("pair", "n", "best")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = sent.value
        for batch in batches:
            count, lists = batch.num_rows, batch.column(1)
            pair, times = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(count), sizes)
            at = np.minimum(np.searchsorted(known, pair), len(known) - 1) if len(known) else np.zeros(len(pair), dtype=np.int64)
            hit = known[at] == pair if len(known) else np.zeros(len(pair), dtype=bool)
            n_best, count_sum = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
            np.add.at(count_sum, owner[hit], times[hit] * n[at[hit]])
            np.add.at(n_best, owner[hit], times[hit] * best[at[hit]])
            rest = ~hit
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_best), pa.array(count_sum), _lists(pair[rest], owner[rest], count, pa.int64()),
                 _lists(times[rest], owner[rest], count, pa.int64())], names=["row", "n_best", "count_sum", "pair", "times"])

    partly = staging.write(aligned.select("row", "pair", "times").mapInArrow(
        look_up, "row long, n_best long, count_sum long, pair array<long>, times array<long>"), "frequent")
    rest = partly.select("row", F.inline(F.arrays_zip("pair", "times")))
    rest = rest.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rest_best"), F.sum(F.col("times") * F.col("n")).alias("rest_sum"))
    none = F.lit(0).cast("long")
    return partly.join(rest, "row", "left").select(
        "row", (F.col("n_best") + F.coalesce("rest_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rest_sum", none)).alias("count_sum"))


def align_corpus(docs: DataFrame, path_a: str, path_b: str, staging: Staging) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    aligned = align_documents(docs, path_a, path_b, ("pairs", "digest"))
    # The numbers are fixed by the stored table.
    aligned = staging.write(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    found = link_statistics(aligned, len(PieceSide(path_b).pieces), staging)
    return aligned.drop("pair", "times").join(found, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
