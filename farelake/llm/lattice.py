"""SentencePiece encoding and decoding over a relational lattice.

Text is cut into units that no piece can span, and equal units are encoded once. Every substring of a unit, of up to the
longest piece's length, is a candidate edge; an equi-join with the piece table keeps those that are pieces, and the edges
are grouped by unit. The fold over a unit's edges is a Spark higher-order ``aggregate``.

The fold. A model with word probabilities takes the path with the best sum of scores (Viterbi). The scores of a
merge-trained (BPE) model are merge ranks, not probabilities: the best path is then not the library's encoding (README
has the figures). For such a model the fold walks the edges from the best rank to the worst, ties from left to right,
and joins two neighbouring symbols wherever an edge spans exactly these two. A piece's parts always rank before it, so
this one walk makes the merges in the library's order, and its ids equal the library's.

Units. Spaces become the model's space mark, with one in front of the text. Pieces hold the mark only in front, so a
unit begins at each run of spaces; it also ends at a line feed (in no piece) and in front of those marks that no piece
holds after a letter. Units of more than ``FOLD_CHARS`` characters are folded in Python by the same walk, in time linear
in their edges.

Documents. The ids of frequent units, at most ``HOT_UNITS`` of bounded length, are sent to all tasks. The other units, some
percent of all occurrences, are folded where they occur, over the same edges by the same walk: shipping every such
occurrence to a join and back took 2.6 times the input on disk (README). No document's text is shuffled.

Edge cases: null text gives null ids, empty text no ids; characters in no piece become the pieces of their UTF-8 bytes;
decoding gives back the text exactly; a null id of a document is kept; repeated rows are encoded each; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
import string
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import Staging
from .common import append_columns, once_per_worker, slices

SPACE = "▁"
FOLD_CHARS = 60       # a unit's boundaries are the bits of one long
HOT_UNITS = 250_000   # units sent to every task, each of at most FOLD_CHARS characters
NO_PIECE_SCORE = -1e10
_BYTE = re.compile(r"<0x([0-9A-F]{2})>$")


@dataclass(frozen=True)
class PieceModel:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    usable: tuple[bool, ...]   # may be found in a text
    byte_ids: tuple[int, ...]  # id of each byte's piece
    merges: bool               # BPE: scores are ranks

    @property
    def longest(self) -> int:
        return max(len(piece) for piece, usable in zip(self.pieces, self.usable) if usable)

    def unit_pattern(self) -> str:
        """A regular expression whose matches, in order, make up a text, so that no piece spans two of them."""
        letter = lambda c: re.match(r"[^\W_]", c)
        spanned = {b for piece, ok in zip(self.pieces, self.usable) if ok for a, b in zip(piece, piece[1:]) if letter(a)}
        ends = "".join("\\" + mark for mark in string.punctuation if mark not in spanned)
        if not ends:
            return f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"
        rest = f"[^{SPACE}\n{ends}]*"
        return f"\n|{SPACE}*[{ends}]*{rest}(?:(?<![^\\W_])[{ends}]+{rest})*"


def load_model(path: str) -> PieceModel:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.vocab_size()
    pieces = tuple(model.id_to_piece(i) for i in range(count))
    usable = tuple(not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(count))
    byte_ids = {int(m[1], 16): i for i, piece in enumerate(pieces) if model.is_byte(i) and (m := _BYTE.match(piece))}
    if len(byte_ids) != 256:
        raise ValueError("the model must have a piece for each byte")
    known = [(piece, ok) for piece, ok in zip(pieces, usable) if ok]
    if any(SPACE in piece.lstrip(SPACE) or "\n" in piece or " " in piece for piece, _ in known):
        raise ValueError("pieces must hold the space mark in front only, and no space or line feed")
    scores = tuple(model.get_score(i) for i in range(count))
    # Ranks of merges are whole negative numbers; log probabilities are not.
    merges = all(score == int(score) for score in scores)
    return PieceModel(pieces, scores, usable, tuple(byte_ids[b] for b in range(256)), merges)


def piece_table(spark: SparkSession, model: PieceModel) -> DataFrame:
    """(piece, id, score, rank) of the usable pieces; equal scores have one rank, the best is 0."""
    ranks = {score: rank for rank, score in enumerate(sorted(set(model.scores), reverse=True))}
    rows = [(piece, i, float(score), ranks[score])
            for i, (piece, score, ok) in enumerate(zip(model.pieces, model.scores, model.usable)) if ok]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["piece", "id", "score", "rank"]),
                                 "piece string, id int, score double, rank long")


def _fold_long(edges: list, size: int) -> list[int]:
    """The merge walk over a unit of any length, edges in the order of the walk: the end of each symbol by its start."""
    following = [*range(1, size + 1), 0]   # 0: no symbol starts here
    chosen = {}
    for edge in edges:
        first, last = edge["s"], edge["e"]
        if last - first == 1:
            chosen.setdefault(first, edge["ids"])
            continue
        middle = following[first]
        if middle and middle < last and following[middle] == last:
            following[first], following[middle] = last, 0
            chosen[first] = edge["ids"]
    out, at = [], 0
    while at < size:
        out.extend(chosen[at])  # an Arrow list comes as a numpy array, for which += would add
        at = following[at]
    return out


def _best_path(edges: list[dict], size: int, scores: tuple[float, ...]) -> list[int]:
    """Viterbi over the edges of a unit; of equal paths the one whose last edge is longest."""
    by_end: dict[int, list] = {}
    for edge in edges:
        by_end.setdefault(edge["e"], []).append(edge)
    best = {0: (0.0, [])}
    for end in range(1, size + 1):
        for edge in sorted(by_end.get(end, ()), key=lambda edge: edge["s"]):
            score = best[edge["s"]][0] + (scores[edge["ids"][0]] if edge["rank"] != _NO_PIECE else NO_PIECE_SCORE)
            if end not in best or score > best[end][0]:
                best[end] = (score, [*best[edge["s"]][1], *edge["ids"]])
    return best[size][1]


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _fold_long_units(edges: pd.Series, size: pd.Series) -> pd.Series:
    return pd.Series([_fold_long(list(rows), int(n)) for rows, n in zip(edges, size)])


# A short unit's edge is one long, so that its natural order is that of the walk: rank of the score (20 bits), start (6),
# end (6), id (20; all set for a character that is no piece).
_NO_PIECE = (1 << 20) - 1
_START, _END, _INSIDE = "(edge >> 26 & 63)", "(edge >> 20 & 63)", "((1L << (edge >> 20 & 63)) - (2L << (edge >> 26 & 63)))"
# State: bit i is set while a symbol begins or ends in front of character i. An edge of two symbols has one bit inside.
_MERGE_FOLD = f"""
aggregate(edges, (2L << size) - 1L, (state, edge) -> if(
    bit_count(state & {_INSIDE}) = 1 AND (state >> {_START} & state >> {_END} & 1) = 1, state & ~{_INSIDE}, state))
"""
_MERGED_EDGES = f"""
array_sort(transform(filter(edges, edge -> (state >> {_START} & state >> {_END} & 1) = 1 AND (state & {_INSIDE}) = 0),
    edge -> edge & {(1 << 32) - 1}))
"""
# State: per end, the best score of a path to it and that path's ids.
_VITERBI_FOLD = """
aggregate(sequence(1, size), array(named_struct('score', 0D, 'ids', cast(array() AS array<int>))),
    (state, last) -> concat(state, array(aggregate(filter(edges, edge -> edge.e = last),
        named_struct('score', double('-Infinity'), 'ids', cast(array() AS array<int>)),
        (best, edge) -> if(state[edge.s].score + edge.score > best.score, named_struct(
            'score', state[edge.s].score + edge.score, 'ids', concat(state[edge.s].ids, edge.ids)), best)))),
    state -> state[size].ids)
"""


def encode_units(units: DataFrame, model: PieceModel) -> DataFrame:
    """(unit, ids) of distinct units, in which the space mark stands for a space."""
    spark = units.sparkSession
    # Each row becomes many: a fixed number of partitions, which adaptive execution does not merge for being small.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized = units.select("unit", F.length("unit").cast("int").alias("size")).repartition(parts, "unit")
    pieces = piece_table(spark, model).withColumn("hash", F.xxhash64("piece")).withColumnRenamed("piece", "known")
    byte_ids = F.array(*(F.lit(i) for i in model.byte_ids))

    def bytes_of(character):
        code = F.hex(F.encode(character, "UTF-8"))
        return F.transform(F.sequence(F.lit(0), F.octet_length(character) - 1), lambda i: F.get(
            byte_ids, F.conv(F.substring(code, 2 * i + 1, F.lit(2)), 16, 10).cast("int")))

    def edges_of(some: DataFrame) -> DataFrame:
        starts = some.select("unit", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("s"))
        ends = starts.select("unit", "size", "s", F.explode(F.sequence(
            F.col("s") + 1, F.least(F.col("s") + model.longest, "size"))).alias("e"))
        spans = ends.withColumn("piece", F.expr("substring(unit, s + 1, e - s)")).withColumn("hash", F.xxhash64("piece"))
        # The broadcast holds the vocabulary, one row per piece. The hash finds a piece, its text confirms it.
        known = F.broadcast(pieces)
        same = (spans["hash"] == pieces["hash"]) & (spans["piece"] == pieces["known"])
        return spans.join(known, same, "left").where("id IS NOT NULL OR e = s + 1").drop("hash", "known")

    if model.merges:
        packed = F.expr(f"shiftleft(coalesce(rank, {_NO_PIECE}L), 32) + shiftleft(cast(s AS long), 26) + shiftleft(cast(e AS long), 20)"
                        f" + coalesce(id, {_NO_PIECE})")
        short = edges_of(sized.where(F.col("size") <= FOLD_CHARS)).groupBy("unit", "size").agg(
            F.sort_array(F.collect_list(packed)).alias("edges"))
        chosen = short.withColumn("state", F.expr(_MERGE_FOLD)).select("unit", F.expr(_MERGED_EDGES).alias("path"))

        def ids_of(edge):
            number = edge.bitwiseAND(F.lit(_NO_PIECE))
            place = F.shiftright(edge, 26).bitwiseAND(F.lit(63)).cast("int") + 1
            return F.when(number != _NO_PIECE, F.array(number.cast("int"))).otherwise(bytes_of(F.substring("unit", place, F.lit(1))))

        plain = F.transform("path", lambda edge: edge.bitwiseAND(F.lit(_NO_PIECE)).cast("int"))
        ids = F.when(F.array_contains(plain, _NO_PIECE), F.flatten(F.transform("path", ids_of))).otherwise(plain)
        encoded = chosen.select("unit", ids.alias("ids"))
        whole = sized.where(F.col("size") > FOLD_CHARS)
    else:
        encoded, whole = None, sized
    ids = F.when(F.col("id").isNotNull(), F.array("id")).otherwise(bytes_of(F.col("piece")))
    rank = F.coalesce("rank", F.lit(_NO_PIECE).cast("long"))
    edges = edges_of(whole).groupBy("unit", "size").agg(F.sort_array(F.collect_list(F.struct(
        rank.alias("rank"), "s", "e", ids.alias("ids"), F.coalesce("score", F.lit(NO_PIECE_SCORE)).alias("score")))).alias("edges"))
    if encoded is None:
        return edges.select("unit", F.expr(_VITERBI_FOLD).alias("ids"))
    return encoded.unionByName(edges.select("unit", _fold_long_units("edges", "size").alias("ids")))


def _packed(ids):
    """ids as little-endian 32-bit numbers, for a compact transfer."""
    def reversed_bytes(i):
        return sum((F.shiftleft(F.shiftright(i, 8 * at).bitwiseAND(F.lit(255)), 24 - 8 * at) for at in range(1, 4)),
                   F.shiftleft(i.bitwiseAND(F.lit(255)), 24))

    return F.unhex(F.array_join(F.transform(ids, lambda i: F.lpad(F.hex(reversed_bytes(i.cast("long"))), 8, "0")), ""))


def _hot_units(vocabulary: DataFrame, hot: int) -> int:
    """The count above which a unit is frequent, so that at most ``hot`` units are."""
    sizes = vocabulary.where(F.length("unit") <= FOLD_CHARS).groupBy("n").agg(F.count("*").alias("units"))
    at_most = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per number of occurrences; those that fit are looked up from the top.
    fits = sizes.withColumn("all", F.sum("units").over(at_most)).where(F.col("all") <= hot)
    lowest = fits.agg(F.min("n")).first()[0]
    return lowest if lowest is not None else (1 << 62)


class UnitSplitter:
    """Units of a text. Texts of single spaces, nearly all, are cut at spaces first, and equal parts are cut once."""

    def __init__(self, pattern: str):
        self.pattern = re.compile(pattern)

    @staticmethod
    def parts(text: str) -> list[str] | None:
        """The parts between spaces, if each of them has one space in front."""
        if not text or "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            return None
        return text.split(" ")

    def units(self, marked_text: str) -> list[str]:
        found = self.pattern.findall(marked_text)
        return found if found and found[-1] else found[:-1]

    def units_of_text(self, text: str) -> list[str]:
        return self.units(SPACE + text.replace(" ", SPACE)) if text else []


class UnitEncoder:
    """Ids of whole texts: frequent units are looked up, the others are folded here by the same walk."""

    KEPT_PARTS, KEPT_UNITS = 150_000, 50_000  # parts of texts, and rare units, whose ids are kept

    def __init__(self, model: PieceModel, frequent: dict[str, bytes]):
        self.split, self.frequent, self.parts, self.units = UnitSplitter(model.unit_pattern()), frequent, {}, {}
        ranks = {score: rank for rank, score in enumerate(sorted(set(model.scores), reverse=True))}
        self.single = {piece: (i,) for i, (piece, ok) in enumerate(zip(model.pieces, model.usable)) if ok and len(piece) == 1}
        # The pieces of two characters and more as a tree of characters; "" leads to rank and id in one number.
        self.tree: dict = {}
        for i, (piece, score, ok) in enumerate(zip(model.pieces, model.scores, model.usable)):
            if ok and len(piece) > 1:
                node = self.tree
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = ranks[score] << 32 | i
        self.scores, self.byte_ids, self.merges = model.scores, model.byte_ids, model.merges

    def _edges(self, unit: str) -> list[tuple[int, int, int]]:
        """(rank and id, start, end) of the pieces of two characters and more, in the order of the walk."""
        size, edges = len(unit), []
        for start, c in enumerate(unit):
            node = self.tree.get(c)
            end = start + 1
            while node is not None and end < size:
                node = node.get(unit[end])
                end += 1
                if node is not None and "" in node:
                    edges.append((node[""], start, end))
        edges.sort()
        return edges

    def _one(self, character: str) -> tuple[int, ...]:
        return self.single.get(character) or tuple(self.byte_ids[b] for b in character.encode())

    def _walk(self, unit: str) -> list[int]:
        size = len(unit)
        following, chosen = [*range(1, size + 1), 0], {}
        for number, first, last in self._edges(unit):
            middle = following[first]
            if middle and middle < last and following[middle] == last:
                following[first], following[middle] = last, 0
                chosen[first] = number & 0xFFFFFFFF
        out, at = [], 0
        while at < size:
            if at in chosen:
                out.append(chosen[at])
            else:
                out.extend(self._one(unit[at]))
            at = following[at]
        return out

    def _best(self, unit: str) -> list[int]:
        edges = [{"rank": n >> 32, "s": a, "e": b, "ids": (n & 0xFFFFFFFF,)} for n, a, b in self._edges(unit)]
        for at, c in enumerate(unit):
            edges.append({"rank": 0 if c in self.single else _NO_PIECE, "s": at, "e": at + 1, "ids": self._one(c)})
        return _best_path(edges, len(unit), self.scores)

    def of_unit(self, unit: str) -> bytes:
        known = self.frequent.get(unit) or self.units.get(unit)
        if known is None:
            known = np.array(self._walk(unit) if self.merges else self._best(unit), dtype="<i4").tobytes()
            if len(self.units) < self.KEPT_UNITS and len(unit) <= FOLD_CHARS:
                self.units[unit] = known
        return known

    def of_part(self, part: str) -> bytes:
        known = b"".join([self.of_unit(unit) for unit in self.split.units(SPACE + part)])
        if len(self.parts) < self.KEPT_PARTS and len(part) <= FOLD_CHARS:
            self.parts[part] = known
        return known

    def encode(self, text: str) -> np.ndarray:
        parts = self.split.parts(text)
        if parts is None:
            raw = [self.of_unit(unit) for unit in self.split.units_of_text(text)]
        else:
            raw = list(map(self.parts.get, parts))
            for at in [at for at, ids in enumerate(raw) if ids is None]:
                raw[at] = self.of_part(parts[at])
        return np.frombuffer(b"".join(raw), dtype="<i4")


def encode(docs: DataFrame, path: str, staging: Staging, hot: int = HOT_UNITS, column: str = "ids") -> DataFrame:
    """Append the token ids of ``text`` to all rows and columns."""
    spark, model = docs.sparkSession, load_model(path)
    pattern = model.unit_pattern()

    def count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = UnitSplitter(pattern)
        parts: Counter = Counter()
        units: Counter = Counter()

        def counted() -> pa.RecordBatch:
            for part, n in parts.items():
                for unit in split.units(SPACE + part):
                    units[unit] += n
            found = pa.RecordBatch.from_arrays(
                [pa.array(units.keys(), type=pa.string()), pa.array(units.values(), type=pa.int64())], names=["unit", "n"])
            parts.clear()
            units.clear()
            return found

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                some = split.parts(text or "")
                if some is None:
                    units.update(split.units_of_text(text))
                else:
                    parts.update(some)
            if len(parts) + len(units) > 300_000:  # sent on and begun anew: the tables are bounded
                yield counted()
        yield counted()

    vocabulary = docs.select("text").mapInArrow(count_units, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    vocabulary = staging.write(vocabulary, "vocabulary")
    frequent = vocabulary.where((F.col("n") >= _hot_units(vocabulary, hot)) & (F.length("unit") <= FOLD_CHARS)).select("unit")
    table = encode_units(frequent, model).select("unit", _packed("ids").alias("ids")).toArrow()
    known = spark.sparkContext.broadcast((table.column("unit").to_pylist(), table.column("ids").to_pylist()))
    key = uuid.uuid4().hex

    def run(texts: list) -> list[pa.Array]:
        encoder = once_per_worker("unit-ids", key, lambda: UnitEncoder(model, dict(zip(*known.value))))
        return [pa.array([None if text is None else encoder.encode(text) for text in texts], type=pa.list_(pa.int32()))]

    return append_columns(docs, "text", [T.StructField(column, T.ArrayType(T.IntegerType()))], run)


class Surface:
    """Text of ids: pieces in order, byte pieces as UTF-8, the mark as a space, without the first one."""

    def __init__(self, model: PieceModel):
        surface = [piece.replace(SPACE, " ").encode() if ok else b"" for piece, ok in zip(model.pieces, model.usable)]
        for byte, piece in enumerate(model.byte_ids):
            surface[piece] = bytes([byte])
        self.bytes = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.sizes = np.array(list(map(len, surface)), dtype=np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes

    def texts(self, rows: pa.ListArray) -> list[bytes | None]:
        """The text of each row of ids; the rows of a batch are looked up together."""
        ids, ends = _flat(rows)
        taken = self.sizes[ids]
        upto = np.cumsum(taken)
        total = int(upto[-1]) if len(upto) else 0
        text = self.bytes[np.repeat(self.first[ids] - upto + taken, taken) + np.arange(total)].tobytes()
        bounds = np.concatenate(([0], upto))[ends].tolist()
        raw = [text[start:end] for start, end in zip([0, *bounds], bounds)]
        return [None if null else one[1:] if one[:1] == b" " else one for one, null in zip(raw, rows.is_null().to_pylist())]


def _flat(rows: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the rows, and where each row ends."""
    sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
    return rows.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes, dtype=np.int64)


def decode(encoded: DataFrame, path: str, column: str = "decoded", ids: str = "ids") -> DataFrame:
    """Append the text of ``ids``."""
    surface = Surface(load_model(path))
    return append_columns(encoded, ids, [T.StructField(column, T.StringType())], lambda rows: [
        pa.array([None if text is None else text.decode("utf-8", "replace") for text in surface.texts(rows)], type=pa.string())], arrow=True)


def digests(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Append ids_crc32 (of the ids as little-endian 32-bit numbers) and decoded_crc32 (of their text)."""
    surface = Surface(load_model(path))

    def run(rows):
        flat, ends = _flat(rows)
        raw, stops = flat.astype("<u4").tobytes(), (4 * ends).tolist()
        texts = surface.texts(rows)
        codes = [None if text is None else zlib.crc32(raw[start:stop]) for start, stop, text in zip([0, *stops], stops, texts)]
        texts = [None if text is None else zlib.crc32(text) for text in texts]
        return [pa.array(codes, type=pa.int64()), pa.array(texts, type=pa.int64())]

    return append_columns(encoded, ids, [T.StructField("ids_crc32", T.LongType()), T.StructField("decoded_crc32", T.LongType())], run, arrow=True)
