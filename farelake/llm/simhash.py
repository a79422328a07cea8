"""SimHash near-dedup by anchor-point covering.

A 64-bit fingerprint is two halves of 31 bits and two rest bits. Two fingerprints that differ in at most three bits
agree, but for one bit, in one of the halves. The anchors of a half are the 2**26 words of the binary Hamming code of
length 31: a perfect covering code, so every half is within one bit (the covering radius) of exactly one anchor, its
home. A fingerprint is copied to every anchor within covering radius plus threshold of its halves, which is two bits, 16
anchors at most. Of two halves that differ in one bit, one has its home at an anchor that the other was copied to, so
per anchor the fingerprints at home are compared with all copies, by all 64 bits.

Equal fingerprints are one row before anything is copied. A crowded anchor is dealt out as blocks of bounded size, home
blocks against copy blocks, and each block sends on a spanning forest of its links rather than the links.

Edge cases: a null text is an empty one; texts without words have fingerprint zero; rows with a null id are
fingerprinted like others but never name a component (it is null if all ids of a component are). An empty table gives
an empty result. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import Staging
from .common import KEY, append_columns, keyed
from .components import connected_components

MAX_BITS = 3
HALF = 31
BLOCK = 1024  # rows of one anchor that are compared in one step
_SHINGLES_AT_ONCE = 100_000


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """The 64-bit hashes of the word shingles, some at a time; fewer words are one shingle, no words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII spaces count
    if not words:
        return
    count = max(len(words) - shingle + 1, 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))[:count].tolist()
    last = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, _SHINGLES_AT_ONCE):
        yield np.array([digest(joined[a:b], 42) for a, b in zip(first[at:at + _SHINGLES_AT_ONCE],
                                                                last[at:at + _SHINGLES_AT_ONCE])], dtype="<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles, as a signed 64-bit number."""
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprint_of(parts: Iterable[np.ndarray]) -> int:
    """SimHash of hashes that come some at a time, as a signed 64-bit number."""
    count, ones = 0, np.zeros(64, dtype=np.int64)
    for hashes in parts:
        count += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, column: str = "fp") -> DataFrame:
    return append_columns(docs, "text", [T.StructField(column, T.LongType())],
                          lambda texts: [pa.array([fingerprint(text) for text in texts], type=pa.int64())])


def _error_masks() -> list[list[int]]:
    """For each syndrome, what turns a half into the anchors within two bits: the home first, then the others."""
    table = [[0]]
    for syndrome in range(1, HALF + 1):
        pairs = [(a, a ^ syndrome) for a in range(1, HALF + 1) if a < a ^ syndrome]
        table.append([1 << (syndrome - 1), *(1 << (a - 1) | 1 << (b - 1) for a, b in pairs)])
    return table


def _anchors(half: Column) -> Column:
    """Anchors within two bits of a half, its home first."""
    checks = [sum(1 << (place - 1) for place in range(1, HALF + 1) if place >> bit & 1) for bit in range(5)]
    syndrome = sum(((F.bit_count(half.bitwiseAND(F.lit(check))) % 2) * (1 << bit) for bit, check in enumerate(checks)), F.lit(0))
    masks = F.array(*(F.array(*(F.lit(mask).cast("long") for mask in row)) for row in _error_masks()))
    return F.transform(F.get(masks, syndrome.cast("int")), lambda mask: half.bitwiseXOR(mask))


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links left[i]-right[i], as (node, root) pairs."""
    nodes, flat = np.unique(np.concatenate((left, right)), return_inverse=True)
    a, b = flat[:len(left)], flat[len(left):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _compare(batches):
    """Links of the rows of each anchor block: (key, block, home, fp), sorted by key, block, home first."""
    rest: list[np.ndarray] | None = None

    def links(key, block, home, fp):
        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (block[1:] != block[:-1]))))
        sizes = np.diff(np.concatenate((starts, [len(key)])))
        run = np.repeat(np.arange(len(starts)), sizes)
        homes = np.bincount(run[home], minlength=len(starts))
        copies = sizes - homes
        # Rows at home come first in a run: pair each of them with all copies of its run.
        rows = np.flatnonzero(home)
        width = copies[run[rows]]
        rows, width = rows[width > 0], width[width > 0]
        cut = np.cumsum(width)
        at = 0
        while at < len(rows):
            end = max(at + 1, int(np.searchsorted(cut, (cut[at - 1] if at else 0) + (1 << 21))))
            these, times = rows[at:end], width[at:end]
            left = np.repeat(these, times)
            offset = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
            right = starts[run[left]] + homes[run[left]] + offset
            a, b = fp[left], fp[right]
            near = (np.bitwise_count((a ^ b).view(np.uint64)) <= MAX_BITS) & (a != b)
            if near.any():
                yield _forest(a[near], b[near])
            at = end

    def output(parts):
        for a, b in parts:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns)]
        key, block = columns[0], columns[1]
        if not len(key):
            continue
        # The last run may go on in the next batch.
        changed = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]))
        cut = int(changed[-1]) + 1 if len(changed) else 0
        rest = [column[cut:] for column in columns]
        if cut:
            yield from output(links(*(column[:cut] for column in columns)))
    if rest is not None and len(rest[0]):
        yield from output(links(*rest))


def fingerprint_links(fingerprints: DataFrame, staging: Staging, block: int = BLOCK) -> DataFrame:
    """A spanning set of the links (a, b) between different fingerprints (column ``fp``, distinct)."""
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("fp", HALF).bitwiseAND(F.lit((1 << HALF) - 1))

    def rows_of(half: Column, number: int) -> Column:
        return F.transform(_anchors(half), lambda anchor, at: F.struct(
            (anchor + F.lit(number << HALF)).alias("key"), (at == 0).alias("home")))

    halves = F.array(rows_of(low, 0), rows_of(high, 1))
    placed = fingerprints.select("fp", F.explode(F.flatten(halves)).alias("anchor")).select("anchor.key", "anchor.home", "fp")
    crowded = placed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    crowded = staging.write(crowded.select("key", F.ceil(F.col("n") / block).cast("int").alias("parts")), "crowded")
    # Crowded anchors are few: there are 32 rows per fingerprint and at least `block` of them on each.
    dealt = placed.join(crowded, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    as_home = F.transform(every, lambda other: F.struct((own * F.col("parts") + other).alias("block"), F.lit(True).alias("home")))
    as_copy = F.transform(every, lambda other: F.struct((other * F.col("parts") + own).alias("block"), F.lit(False).alias("home")))
    roles = F.when(F.col("home"), F.concat(as_home, as_copy)).otherwise(as_copy)
    rows = dealt.select("key", "fp", F.explode(roles).alias("role")).select("key", "role.block", "role.home", "fp")
    by_block = rows.repartition("key", "block").sortWithinPartitions("key", "block", F.desc("home"))
    return by_block.mapInArrow(_compare, "a long, b long")


def _classes(marked: DataFrame, staging: Staging, block: int) -> DataFrame:
    """(fp, component_id) of the fingerprints in ``marked``."""
    distinct = staging.write(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    links = staging.write(fingerprint_links(distinct.select("fp"), staging, block), "links")
    parts = connected_components(links, staging)
    grouped = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    grouped = staging.write(grouped, "grouped")
    smallest = staging.write(grouped.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest-ids")
    return staging.write(grouped.join(smallest, "component").select("fp", "component", "component_id"), "classes")


def simhash_components(docs: DataFrame, staging: Staging, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest id that links reach."""
    marked = staging.write(with_fingerprint(docs.select("doc_id", "text")).drop("text"), "fingerprints")
    return marked.join(_classes(marked, staging, block), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, staging: Staging, block: int = BLOCK) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the one with the smallest id, where null comes last.

    Of different texts with that id the one with the smallest hash stays, of equal rows any one.
    """
    marked = staging.write(with_fingerprint(keyed(docs.select("doc_id", "text"))).drop("text"), "fingerprints")
    owned = marked.join(_classes(marked, staging, block), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), *KEY)
    first = staging.write(owned.groupBy("component").agg(F.min(order).alias("first")).select(
        *(F.col(f"first.{name}").alias(name) for name in KEY)), "first")
    chosen = keyed(docs).join(first, KEY, "left_semi")
    # Equal rows have one key. The join has brought them together already.
    copy = F.row_number().over(Window.partitionBy(*KEY).orderBy("doc_id"))
    return chosen.withColumn("_llm_copy", copy).where("_llm_copy = 1").select(*docs.columns)
