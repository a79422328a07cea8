"""Token-id output in a word-aligned binary format (Simple-8b).

Payload of a segment (all numbers little-endian):

    "S8B1", u32 blocks, u64 offset of each block from the payload's start, blocks
    block: u32 ids, u32 words, u32 escapes, u32 crc32 of the rest, words (u64), escaped ids (u64)

A word holds a selector in its top four bits and, in its low 60 bits, as many ids as the selector says, the first one
lowest. The selector of an escape stands for one id of more than 30 bits, which follows behind the words. The last word
of a block may have room for more ids than are left. Blocks hold ``BLOCK_IDS`` ids and are coded on their own; words of
one selector are decoded together.

A corpus is a folder of Parquet files, written by Spark's committer, of segments in ascending doc_id: part, segment,
first (ids of the part before it), doc_ids, lengths and payload. Parts follow each other in doc_id order, and so do the
segments of a part.

Edge cases: null text is empty; every document ends with the end id, so an empty one has one id; null ids sort first;
documents with equal ids follow each other in the order of a hash of their texts; an empty table writes no segment and
reads back as no rows; only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import once_per_worker, slices

MAGIC = b"S8B1"
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 16  # a segment is closed at so many ids; a longer document is one segment
# Fixed values: (ids, bits) of the selectors 0 to 14; 15 is the escape.
SELECTORS = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
             (3, 20), (2, 30))
ESCAPE = 15


def _window_maxima(values: np.ndarray, sizes: Iterable[int]) -> Iterator[np.ndarray]:
    """For each size, ascending, the largest of the next so many values of each row; the rows end in zeros."""
    power, reach = values, 1
    for size in sizes:
        while 2 * reach <= size:
            power, reach = np.maximum(power[:, :-reach], power[:, reach:]), 2 * reach
        yield np.maximum(power[:, :BLOCK_IDS], power[:, size - reach:size - reach + BLOCK_IDS])


def pack(ids: np.ndarray) -> bytes:
    """Payload of the ids (unsigned, up to 64 bits)."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    total, most = len(ids), SELECTORS[0][0]
    n_blocks = -(-total // BLOCK_IDS)
    # One row per block. The zeros behind its ids fit any selector, so that its last word may have room left.
    rows = np.zeros((n_blocks, BLOCK_IDS + most), dtype=np.uint64)
    for number in range(n_blocks):
        own = ids[number * BLOCK_IDS:(number + 1) * BLOCK_IDS]
        rows[number, :len(own)] = own
    widths = sorted({bits for _, bits in SELECTORS})
    width = np.searchsorted(np.array([1 << bits for bits in widths], dtype=np.uint64), rows.ravel(), side="right")
    width = width.astype(np.int8).reshape(rows.shape)
    # The first selector, that is the one with most ids, whose width holds all of the next ids of the block.
    selector = np.full((n_blocks, BLOCK_IDS), ESCAPE, dtype=np.int8)
    for number, largest in zip(range(ESCAPE - 1, -1, -1), _window_maxima(width, [count for count, _ in reversed(SELECTORS)])):
        selector[largest <= widths.index(SELECTORS[number][1])] = number
    step = np.array([count for count, _ in SELECTORS] + [1], dtype=np.uint8)[selector]
    chain, bounds = [], [0]
    for number in range(n_blocks):
        jumps, at, end = step[number].tobytes(), 0, min(BLOCK_IDS, total - number * BLOCK_IDS)
        while at < end:
            chain.append(at)
            at += jumps[at]
        bounds.append(len(chain))
    block, place = np.repeat(np.arange(n_blocks), np.diff(bounds)), np.array(chain, dtype=np.int64)
    chosen = selector.ravel()[block * BLOCK_IDS + place]
    place += block * rows.shape[1]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat = rows.ravel()
    for number, (count, bits) in enumerate(SELECTORS):
        at = np.flatnonzero(chosen == number)
        if bits and len(at):
            lanes = np.arange(count)[:, None]
            words[at] |= np.bitwise_or.reduce(flat[place[at] + lanes] << (lanes * bits).astype(np.uint64), axis=0)
    blocks, offsets, size = [], [], len(MAGIC) + 4 + 8 * n_blocks
    for number, (low, high) in enumerate(zip(bounds, bounds[1:])):
        escaped = flat[place[low:high][chosen[low:high] == ESCAPE]]
        body = words[low:high].astype("<u8").tobytes() + escaped.astype("<u8").tobytes()
        held = min(BLOCK_IDS, total - number * BLOCK_IDS)
        blocks.append(struct.pack("<4I", held, high - low, len(escaped), zlib.crc32(body)) + body)
        offsets.append(size)
        size += len(blocks[-1])
    return MAGIC + struct.pack("<I", n_blocks) + np.array(offsets, dtype="<u8").tobytes() + b"".join(blocks)


def _decode(words: np.ndarray, escaped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids that the words have room for, and the place of each word's first one."""
    chosen = (words >> np.uint64(60)).astype(np.int8)
    counts = np.array([n for n, _ in SELECTORS] + [1])[chosen]
    places = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for number, (count, bits) in enumerate(SELECTORS):
        at = np.flatnonzero(chosen == number)
        if bits and len(at):
            lanes = np.arange(count)[:, None]
            out[places[at] + lanes] = (words[at] >> (lanes * bits).astype(np.uint64)) & np.uint64((1 << bits) - 1)
    out[places[chosen == ESCAPE]] = escaped
    return out, places


def unpack(payload: bytes, blocks: Iterable[int] | None = None) -> np.ndarray:
    """The ids of a payload, or of some of its blocks; the words of all blocks asked for are decoded together."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b payload")
    total = struct.unpack_from("<I", payload, 4)[0]
    offsets = np.frombuffer(payload, dtype="<u8", count=total, offset=8)
    held, first, words, escaped = [], [0], [], []
    for offset in offsets.tolist() if blocks is None else [int(offsets[b]) for b in blocks]:
        count, n_words, n_escaped, check = struct.unpack_from("<4I", payload, offset)
        body = payload[offset + 16:offset + 16 + 8 * (n_words + n_escaped)]
        if zlib.crc32(body) != check:
            raise ValueError("damaged block")
        values = np.frombuffer(body, dtype="<u8").astype(np.uint64)
        held.append(count)
        first.append(first[-1] + n_words)
        words.append(values[:n_words])
        escaped.append(values[n_words:])
    if not held:
        return np.array([], dtype=np.uint64)
    out, places = _decode(np.concatenate(words), np.concatenate(escaped))
    return np.concatenate([out[start:start + count] for start, count in zip(places[first[:-1]].tolist(), held)])


def _taken(table: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The values of some rows of a table, which holds rows of the given sizes one behind another."""
    first, taken = (np.cumsum(sizes) - sizes)[rows], sizes[rows]
    ends = np.cumsum(taken)
    return table[np.repeat(first - ends + taken, taken) + np.arange(ends[-1] if len(ends) else 0)]


class WordEncoder:
    """The tokenizers library's ids of whole texts, with the ids of words kept.

    The model drops white space and no token spans it, so the parts of a text between spaces are encoded on their own;
    ASCII marks behind a word's last letter are too, since the model always splits there. It lowers the case itself, so
    ASCII words are looked up in lower case. Words of Latin letters are one unit of the model, whose last token says so:
    many of them are encoded as one text.
    """

    MARKS = ",.;:!?%&$#*"
    KEPT = 600_000
    # Python takes these for white space, the tokenizer does not.
    SEPARATORS = "[\x1c-\x1f]"
    LATIN = "[a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-\xff]"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kept: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        is_latin = pc.match_substring_regex(pa.array(words, type=pa.string()), f"^{self.LATIN}+$").to_pylist()
        latin = [word for word, yes in zip(words, is_latin) if yes]
        other = [word for word, yes in zip(words, is_latin) if not yes]
        found = dict(zip(other, self._encode(other)))
        for at in range(0, len(latin), 1000):
            some = latin[at:at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            raw, last = ids.tobytes(), 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(last) != len(some):
                raise ValueError("a word of letters is not one unit of this tokenizer")
            found.update(zip(some, (raw[a:b] for a, b in zip([0, *last[:-1].tolist()], last.tolist()))))
        return found

    def _parted(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The words without the marks behind their last letter, and these marks."""
        trimmed = pc.utf8_rtrim(words, characters=self.MARKS)
        # Other letters may become several characters in lower case, of which the last one joins the mark.
        cut = pc.match_substring_regex(trimmed, f"{self.LATIN}$")
        body = pc.if_else(cut, trimmed, words)
        tail = pc.if_else(cut, pc.replace_substring_regex(words, f"(?s)^.*[^{self.MARKS}]", ""), "")
        lowered = pc.and_not(pc.string_is_ascii(body), pc.match_substring(body, "<"))
        return pc.if_else(lowered, pc.ascii_lower(body), body), tail

    def _look_up(self, parts: pa.Array) -> list[bytes]:
        """The ids of distinct parts of words."""
        parts = parts.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.kept.get, parts))
        missing = [at for at, ids in enumerate(found) if ids is None]
        fresh = self._encode_words([parts[at] for at in missing])
        for at in missing:
            found[at] = fresh[parts[at]]
        if len(self.kept) < self.KEPT:
            self.kept.update(fresh)
        return found

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers. Every part of their distinct words is looked up once."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, type=pa.string())
        whole = pc.match_substring_regex(texts, self.SEPARATORS)
        words = pc.utf8_split_whitespace(pc.if_else(whole, "", texts))  # white space of Unicode, as in str.split
        coded = words.flatten().dictionary_encode()
        parts = pa.concat_arrays(self._parted(coded.dictionary)).dictionary_encode()
        found = self._look_up(parts.dictionary)
        table, sizes = np.frombuffer(b"".join(found), dtype="<u4"), np.array(list(map(len, found)), dtype=np.int64) // 4
        # From the ids of the parts to those of the distinct words, body and tail, and on to those of all words.
        pairs = parts.indices.to_numpy().reshape(2, -1).T.ravel()
        table, sizes = _taken(table, sizes, pairs), sizes[pairs].reshape(-1, 2).sum(axis=1)
        row = coded.indices.to_numpy()
        ids = _taken(table, sizes, row)
        bounds = np.concatenate(([0], np.cumsum(sizes[row])))[words.offsets.to_numpy()].tolist()
        out = [ids[start:end].tobytes() for start, end in zip(bounds, bounds[1:])]
        for at in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[at] = self._encode([texts[at].as_py()])[0]
        return out


def write_corpus(docs: DataFrame, path: str, encoder: Callable[[], WordEncoder], end_id: int = 1) -> None:
    """Encode all texts and write the segments in ascending doc_id."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    end = np.array([end_id], dtype="<u4").tobytes()
    key = uuid.uuid4().hex

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first = TaskContext.get().partitionId(), 0, 0
        words = once_per_worker("word-ids", key, encoder)
        ids: list[bytes] = []
        owners: list = []
        held = 0

        def segment():
            values = np.frombuffer(b"".join(ids), dtype="<u4")
            lengths = [len(one) // 4 for one in ids]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], type=pa.int32()), pa.array([number], type=pa.int32()), pa.array([first], type=pa.int64()),
                 pa.array([len(values)], type=pa.int64()), pa.array([owners], type=pa.list_(owner_type)),
                 pa.array([lengths], type=pa.list_(pa.int64())), pa.array([pack(values)], type=pa.binary())],
                names=["part", "segment", "first", "n_ids", "doc_ids", "lengths", "payload"])

        owner_type = pa.int64()
        for batch in slices(batches, 1024):
            owner_type = batch.column(0).type
            for owner, raw in zip(batch.column(0).to_pylist(), words.encode(batch.column(1))):
                ids.append(raw + end)
                owners.append(owner)
                held += len(raw) // 4 + 1
                if held >= SEGMENT_IDS:
                    yield segment()
                    number, first, ids, owners, held = number + 1, first + held, [], [], 0
        if ids:
            yield segment()

    schema = f"part int, segment int, first long, n_ids long, doc_ids array<{id_type}>, lengths array<long>, payload binary"
    ordered.mapInArrow(segments, schema).write.mode("errorifexists").parquet(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids as little-endian 32-bit numbers) of every document, decoded from the files."""
    stored = spark.read.parquet(path)
    id_type = stored.schema["doc_ids"].dataType.elementType.simpleString()
    # One row per part: this bounds the running total and the broadcast.
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    rows = stored.join(F.broadcast(offsets), "part").select(
        (F.col("offset") + F.col("first")).alias("start"), "doc_ids", "lengths", "payload")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            owner_type = batch.column(1).type.value_type
            for start, owners, lengths, payload in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids = unpack(payload).astype("<u4")
                ends = np.cumsum(lengths)
                raw = [ids[end - size:end].tobytes() for end, size in zip(ends.tolist(), lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners, type=owner_type), pa.array(start + ends - np.array(lengths), type=pa.int64()),
                     pa.array(raw, type=pa.binary())], names=["doc_id", "start", "ids"])

    return rows.mapInArrow(documents, f"doc_id {id_type}, start long, ids binary")
