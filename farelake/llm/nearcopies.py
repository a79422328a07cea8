"""Near copies by exact Jaccard similarity of word shingles, found by SimHash anchors and, beyond three bits, MinHash bands.

Two texts are near copies if the sets of their five-word shingles have a Jaccard similarity of 0.8 or more; a text of
fewer words is one shingle. Words are those of the SimHash (ASCII spaces divide them, ASCII letters are lower-cased).
Equal sets are one row before anything is compared. Every link is verified on the shingles (as 64-bit hashes), so
fingerprints and bands decide only what is compared.

First the method of ``simhash``: each set has a 64-bit SimHash of its shingles, and the anchor-point covering finds the
fingerprints within three bits. Sets of one fingerprint are compared with the smallest of them, and the smallest sets of
fingerprints with those of the spanning forests that the anchors send on.

At a similarity of 0.8 two fingerprints differ in about 9.7 of 64 bits, so three bits find close copies only. What the
anchors left apart is found by 24 bands of 5 MinHash values: two sets are compared if they agree in a band, and at a similarity of 0.8 a pair is missed with probability
(1 - 0.8**5)**24, which is 0.00007. Each set of a band value that still holds several components is compared with the
value's smallest set, then with the one that has the most links so far, which joins a group around one text by as many
rows as it has sets. Sets that share a band value and still lie apart meet in
tasks: a task holds the shingles of a band value's sets (a crowded value is dealt out as pairs of blocks), compares all of
them and sends on a spanning forest of the links that join components. So rows are linear in a group's size; the comparisons
of a group that stays apart are not, since each of them has to be made. Of the texts only the ones that share an anchor
or a band value are read again, once, for their shingles.

Edge cases: a null text is an empty one; texts without words are copies of each other; rows with a null id are compared
like others, and come last. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import Staging
from .common import KEY, free_name, keyed, slices
from .components import connected_components
from .simhash import fingerprint_links, fingerprint_of, shingle_hashes

SHINGLE = 5
BANDS, ROWS = 24, 5
_AT_ONCE = 4096
BLOCK = 1024  # sets whose shingles a task holds
_PICK = np.random.default_rng(42)
_FACTORS = _PICK.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)
_SHIFTS = _PICK.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes."""
    return np.unique(np.concatenate([np.zeros(0, dtype="<u8"), *shingle_hashes(text, SHINGLE)]))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One signed 64-bit number per band, which holds the band's number too."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, dtype="<u8")
    for at in range(0, len(hashes), _AT_ONCE):
        np.minimum(least, (hashes[at:at + _AT_ONCE] * _FACTORS + _SHIFTS).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), number) for number, row in enumerate(rows)], dtype="<u8").view("<i8")


def _identity(hashes: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(hashes.tobytes(), 7), dtype="<u8").view("<i8"))


def _mark(batches):
    """(doc_id, key, set, n, fp, bands) of each text."""
    names = ["doc_id", *KEY, "set", "n", "fp", "bands"]
    for batch in slices(batches):
        sets, sizes, prints, values = [], [], [], []
        for text in batch.column("text").to_pylist():
            hashes = shingles(text)
            sets.append(_identity(hashes))
            sizes.append(len(hashes))
            prints.append(fingerprint_of(hashes[at:at + _AT_ONCE] for at in range(0, len(hashes), _AT_ONCE)))
            values.append(bands(hashes))
        yield pa.RecordBatch.from_arrays([
            *(batch.column(name) for name in names[:3]), pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()),
            pa.array(prints, pa.int64()), pa.array(values, pa.list_(pa.int64()))], names=names)


def _shingle_rows(batches):
    for batch in slices(batches, 32):
        values = [shingles(text).view("<i8") for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("set"), pa.array(values, pa.list_(pa.int64()))], names=["set", "shingles"])


def _stored_shingles(wanted: DataFrame, docs: DataFrame, owners: DataFrame, staging: Staging) -> DataFrame:
    """(set, shingles) of the wanted sets; ``owners`` names one document of each set."""
    wanted = staging.write(owners.select("set", *KEY).join(wanted, "set"), "compared")
    read = keyed(docs.select("doc_id", "text")).join(wanted, KEY).select("set", "text").mapInArrow(_shingle_rows, "set long, shingles array<long>")
    # Equal rows have one key and so come several times.
    return staging.write(read.groupBy("set").agg(F.first("shingles").alias("shingles")), "shingles")


def _verified(pairs: DataFrame, read: DataFrame, staging: Staging) -> DataFrame:
    """The pairs (a, b) with a similarity of 0.8 or more; ``read`` holds the shingles of the sets."""
    pairs = staging.write(pairs.where("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)").distinct(), "candidates")
    sides = pairs.join(read.select(F.col("set").alias("a"), F.col("shingles").alias("of_a")).hint("merge"), "a").join(
        read.select(F.col("set").alias("b"), F.col("shingles").alias("of_b")).hint("merge"), "b")
    both = F.size(F.array_intersect("of_a", "of_b"))
    # both / (n_a + n_b - both) >= 0.8
    return staging.write(sides.where(9 * both >= 4 * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "links")


def forest(sets: list[int], parts: list[int], shingles_of: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (a, b) between sets of different parts that join all parts which links join."""
    sizes = np.array([len(one) for one in shingles_of])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, times = np.unique(np.concatenate(shingles_of), return_inverse=True, return_counts=True)
    # A shingle of one set is in no intersection.
    shared = times[place] > 1
    owner, place = owner[shared], place[shared]
    columns, place = np.unique(place, return_inverse=True)
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for start in range(0, len(columns), _AT_ONCE):
        low, high = np.searchsorted(place, (start, start + _AT_ONCE))
        held = np.zeros((len(sets), min(_AT_ONCE, len(columns) - start)), dtype=np.float32)
        held[owner[low:high], place[low:high] - start] = 1
        both += held @ held.T  # whole numbers below 2 ** 24: exact
    near = 9 * both.astype(np.int64) >= 4 * (sizes[:, None] + sizes[None, :])
    names, part = np.unique(parts, return_inverse=True)
    root = list(range(len(names)))

    def find(at: int) -> int:
        while root[at] != at:
            root[at] = root[root[at]]
            at = root[at]
        return at

    links = []
    for a, b in zip(*np.nonzero(np.triu(near & (part[:, None] != part[None, :]), 1))):
        low, high = find(part[a]), find(part[b])
        if low != high:
            root[high] = low
            links.append((sets[a], sets[b]))
    return links


def _forests(unit: pa.Table) -> pa.Table:
    values = [np.array(one, dtype=np.int64) for one in unit["shingles"].to_pylist()]
    links = forest(unit["set"].to_pylist(), unit["part"].to_pylist(), values) if len(values) > 1 else []
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _parted(members: DataFrame, parts: DataFrame, staging: Staging) -> DataFrame:
    """(band, set, n, part) of the band values that still hold several components."""
    owned = members.select("band", "set", "n").join(parts.withColumnRenamed("node", "set"), "set", "left").select(
        "band", "set", "n", F.coalesce("component", "set").alias("part"))
    owned = staging.write(owned, "members")
    split = staging.write(owned.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).where(
        "low < high").select("band"), "split")
    return staging.write(owned.join(split.hint("merge"), "band"), "apart")


def _meeting(apart: DataFrame, read: DataFrame, staging: Staging) -> DataFrame:
    """Links between sets of different components that share a band value, compared in tasks of at most ``BLOCK`` sets."""
    sizes = staging.write(apart.groupBy("band").agg(F.count("*").alias("sharers")), "band-sizes")
    dealt = apart.join(sizes.hint("merge"), "band").withColumn(
        "blocks", F.when(F.col("sharers") <= BLOCK, 1).otherwise(F.ceil(F.col("sharers") / (BLOCK // 2.5))).cast("int"))
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    units = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(own, other).alias("low"), F.greatest(own, other).alias("high")))
    rows = dealt.select("band", "set", "part", F.explode(units).alias("unit")).join(read.hint("merge"), "set")
    return staging.write(rows.groupBy("band", "unit").applyInArrow(_forests, "a long, b long").distinct(), "links")


def _pair(other: str) -> list[Column]:
    """The set of a row and another one as a pair (a, b, n_a, n_b), the smaller first."""
    sides = F.array_sort(F.array(F.struct("set", "n"), F.struct(F.col(f"{other}.set"), F.col(f"{other}.n"))))
    return [sides[at][name].alias(to) for at, name, to in ((0, "set", "a"), (1, "set", "b"), (0, "n", "n_a"), (1, "n", "n_b"))]


def _anchored(distinct: DataFrame, staging: Staging) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of sets whose fingerprints are equal or linked by the anchors; ``distinct`` is (set, n, fp)."""
    least = staging.write(distinct.groupBy("fp").agg(F.min(F.struct("set", "n")).alias("least")), "fingerprints")
    same = distinct.join(least.hint("merge"), "fp").where("set <> least.set").select(*_pair("least"))
    linked = staging.write(fingerprint_links(least.select("fp"), staging).distinct(), "anchor-links")
    ends = linked.join(least.select(F.col("fp").alias("a"), F.col("least.set").alias("set"), F.col("least.n").alias("n")).hint("merge"), "a")
    near = ends.join(least.select(F.col("fp").alias("b"), "least").hint("merge"), "b").select(*_pair("least"))
    return same.unionByName(near)


def _against(apart: DataFrame, chosen: DataFrame, staging: Staging) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of the chosen set of each band value with the sets of other components."""
    chosen = staging.write(chosen, "chosen")
    return apart.join(chosen.hint("merge"), "band").where("part <> chosen.part").select(*_pair("chosen"))


def near_copy_sets(docs: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, set) of every row, and (set, component)."""
    rows = keyed(docs.select("doc_id", "text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    marked = staging.write(rows.mapInArrow(
        _mark, f"doc_id {id_type}, {KEY[0]} long, {KEY[1]} long, set long, n long, fp long, bands array<long>"), "shingle-sets")
    owner = F.min(F.struct(*KEY)).alias("owner")
    distinct = staging.write(marked.groupBy("set").agg(owner, *(F.first(name).alias(name) for name in ("n", "fp", "bands"))).select(
        "set", "n", "owner.*", "fp", "bands"), "sets")
    anchored = staging.write(_anchored(distinct.select("set", "n", "fp"), staging), "anchored")
    placed = distinct.select("set", "n", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.count("*").alias("sharers")).where("sharers > 1")
    shared = staging.write(shared.select("band"), "bands")
    members = staging.write(placed.join(shared.hint("merge"), "band"), "members")
    # The texts are read once for all comparisons.
    wanted = members.select("set").unionByName(anchored.select(F.explode(F.array("a", "b")).alias("set"))).distinct()
    read = _stored_shingles(wanted, docs, distinct, staging)
    links = _verified(anchored, read, staging)
    parts = connected_components(links, staging)

    # The smallest set of each band value that the anchors left apart, against the sets of other components.
    apart = _parted(members, parts, staging)
    chosen = apart.groupBy("band").agg(F.min(F.struct("set", "n", "part")).alias("chosen"))
    links = links.unionByName(_verified(_against(apart, chosen, staging), read, staging))
    parts = connected_components(links, staging)

    # The same for the set with the most links.
    apart = _parted(members, parts, staging)
    degrees = links.select(F.explode(F.array("a", "b")).alias("set")).groupBy("set").agg(F.count("*").alias("links"))
    ranked = apart.join(degrees, "set", "left").withColumn("links", F.coalesce("links", F.lit(0)))
    chosen = ranked.groupBy("band").agg(F.max_by(F.struct("set", "n", "part"), F.struct("links", "set")).alias("chosen"))
    links = links.unionByName(_verified(_against(apart, chosen, staging), read, staging))
    parts = connected_components(links, staging)

    more = _meeting(_parted(members, parts, staging), read, staging)
    if not more.isEmpty():
        parts = connected_components(links.unionByName(more), staging)
    named = distinct.select("set").join(parts.withColumnRenamed("node", "set"), "set", "left")
    return marked.select("doc_id", *KEY, "set"), named.select("set", F.coalesce("component", "set").alias("component"))


def keep_first(docs: DataFrame, staging: Staging) -> DataFrame:
    """One row of each group of near copies, with all columns of ``docs``: the one with the smallest id, null ids last.

    Of different texts with that id the one with the smallest hash stays, of equal rows any one.
    """
    marked, parts = near_copy_sets(docs, staging)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), *KEY)
    # One row per set first: a set with a large part of the rows is one row in the join.
    owners = marked.groupBy("set").agg(F.min(order).alias("first"))
    first = staging.write(owners.join(parts, "set").groupBy("component").agg(F.min("first").alias("first")).select(
        *(F.col(f"first.{name}").alias(name) for name in KEY)), "first")
    chosen = keyed(docs).join(first, KEY, "left_semi")
    # Equal rows have one key. The join has brought them together already.
    copy = free_name(docs, "_llm_copy")
    placed = chosen.withColumn(copy, F.row_number().over(Window.partitionBy(*KEY).orderBy("doc_id")))
    return placed.where(F.col(copy) == 1).select(*docs.columns)
