"""Line dedup: suffix array over line-id sequences by prefix doubling, repeated runs from its LCP intervals.

A document is the sequence of the ids of its lines. Level j of the doubling ranks every suffix by its first 2**j lines:
level 0 ranks lines, level j + 1 ranks the pairs (rank at a line, rank 2**j lines further). Suffixes that share the rank
of a level form an LCP interval of that depth. A suffix that is alone in its interval can't repeat further and leaves.

A run of lines repeats if it has ``min_words`` words or more and occurs at an earlier position of the corpus, in the order of (doc_id, line number). Every line of a maximal repeated run is
deleted from the later positions; the first occurrence stays. Which lines belong to such a run follows from the
shortest runs with enough words: those that start at each line cover the run up to its last words, those that end at
each line cover the rest. Two runs of n lines are equal if and only if the ranks of their first and of their
last 2**j <= n lines agree, so each of the two is one grouping. The doubling stops at the depth of the longest run that
decides.

A word is a run of characters that are not white space of any kind (tabs and no-break spaces divide words as spaces do).
A line without words weighs ``wordless`` words: 0 in the queries. With 1, the default, 50 blank lines are a run of 50 words.

Edge cases: a null text stays null and has no lines; an empty text is one empty line; null ids sort first; rows with
equal id and text are one document and keep equal texts; texts of the same id are ordered by a hash. Line ids are
128 bits of two hashes. An empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import Staging
from .common import KEY, free_name, keyed

MIN_WORDS = 50
# White space of Unicode as Python's str.split sees it, without the plain space.
WHITE = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
         "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def word_count(text: Column) -> Column:
    """The words of a text: cuts at single spaces are several times cheaper than a regular expression of all white space."""
    parts = F.split(F.translate(text, WHITE, " " * len(WHITE)), " ", -1)
    return F.size(F.array_remove(parts, ""))


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line: document, number, 128-bit line id, words."""
    lines = keyed(docs).where(F.col("text").isNotNull()).select(
        *KEY, F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
    return lines.select(*KEY, "line", F.xxhash64("content").alias("id_high"),
                        F.xxhash64("content", F.lit(1)).alias("id_low"), word_count(F.col("content")).cast("long").alias("words"))


def _ranked(suffixes: DataFrame, keys: list[str], name: str, staging: Staging) -> DataFrame:
    """Give equal ``keys`` one rank, in the order of the keys; suffixes that are alone are left out.

    The distinct keys are range-partitioned and sorted, and a rank is the position in that order. A key of many rows
    is one row by then, and the join back can split it.
    """
    groups = suffixes.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    order = groups.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranks = staging.write(order.withColumn(name, F.monotonically_increasing_id()), name)
    # A merge join at every size: the plan, and with it the growth of the shuffle, does not depend on statistics.
    return suffixes.join(ranks.hint("merge"), keys).drop(*keys)


def repeated_lines(docs: DataFrame, staging: Staging, min_words: int = MIN_WORDS, wordless: int = 1) -> DataFrame:
    """The lines to delete: (key, line)."""
    lines = _lines(docs)
    level = staging.write(_ranked(lines, ["id_high", "id_low"], "rank0", staging).distinct(), "level0")

    # Shortest runs with enough words, within stretches of lines that all repeat: `reach` from each line on, `back` up to
    # each line. Words before and up to a line are running totals of the document.
    by_document = Window.partitionBy(*KEY).orderBy("line")
    stretch = F.col("line") - F.row_number().over(by_document)
    runs = level.withColumn("stretch", stretch)
    within = Window.partitionBy(*KEY, "stretch").orderBy("line")
    weighed = runs.withColumn("weight", F.greatest("words", F.lit(wordless).cast("long"))).withColumn("upto", F.sum("weight").over(within))
    # A run is shortest where it ends (or starts) with words, and min_words following lines with words are enough to look
    # at. Lines without words are apart from them in these windows, so that any number of them lies in between.
    worded = Window.partitionBy(*KEY, "stretch", F.col("weight") > 0).orderBy("line")
    places = F.struct("line", "upto", (F.col("upto") - F.col("weight")).alias("before"))
    windows = weighed.withColumns({"ends": F.collect_list(places).over(worded.rowsBetween(0, min_words - 1)),
                                   "starts": F.collect_list(places).over(worded.rowsBetween(-(min_words - 1), 0))})
    windows = windows.select(*KEY, "stretch", "line", "rank0", *(F.expr(
        f"if(weight > 0, get(filter({some}, s -> {enough} >= {min_words}), 0).line, null)").alias(name) for name, some, enough in (
            ("ahead", "ends", "s.upto - upto + weight"), ("behind", "reverse(starts)", "upto - s.before"))))
    # From a line without words the run goes as far as from the next line with words, and likewise backwards.
    ahead = F.last("ahead", ignorenulls=True).over(Window.partitionBy(*KEY, "stretch").orderBy(F.desc("line")).rowsBetween(
        Window.unboundedPreceding, 0))
    behind = F.last("behind", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    windows = windows.select(*KEY, "line", "rank0", (ahead - F.col("line") + 1).alias("reach"), (F.col("line") - behind + 1).alias("back"))
    # Null means that the stretch ends before there are enough words.
    spans = staging.write(windows, "spans")
    starts = spans.where("reach > 0").select(*KEY, F.col("line").alias("first"), F.col("reach").alias("n"))
    ends = spans.where("back > 0").select(*KEY, (F.col("line") - F.col("back") + 1).alias("first"), F.col("back").alias("n"))
    wanted = staging.write(starts.unionByName(ends).distinct(), "wanted")

    found, rank = [], spans.select(*KEY, "line", "rank0")
    j, longest = 0, wanted.agg(F.max("n")).first()[0] or 0
    while longest >= 1 << j:
        size, name = 1 << j, f"rank{j}"
        of_size = wanted.where((F.col("n") >= size) & (F.col("n") < 2 * size))
        left = rank.select(*KEY, F.col("line").alias("first"), F.col(name).alias("head"))
        right = rank.select(*KEY, F.col("line").alias("tail_line"), F.col(name).alias("tail"))
        placed = of_size.join(left, [*KEY, "first"]).withColumn("tail_line", F.col("first") + F.col("n") - size)
        found.append(placed.join(right, [*KEY, "tail_line"]).select(*KEY, "first", "n", F.lit(j).alias("level"), "head", "tail"))
        if longest < 2 * size:
            break
        after = rank.select(*KEY, (F.col("line") - size).alias("line"), F.col(name).alias("next"))
        pairs = rank.join(after, [*KEY, "line"]).withColumnRenamed(name, "own")
        rank = staging.write(_ranked(pairs, ["own", "next"], f"rank{j + 1}", staging), f"level{j + 1}")
        j += 1
    if not found:
        return spans.where("false").select(*KEY, "line")
    runs = found[0]
    for more in found[1:]:
        runs = runs.unionByName(more)
    runs = staging.write(runs, "runs")

    # The interval of a run: the earliest of its suffixes is kept, the others are later copies.
    interval = ["level", "n", "head", "tail"]
    earliest = runs.groupBy(*interval).agg(F.min(F.struct(*KEY, "first")).alias("kept"), F.count("*").alias("copies"))
    earliest = staging.write(earliest.where("copies > 1"), "intervals")
    later = runs.join(earliest, interval).where(F.struct(*KEY, "first") > F.col("kept"))
    return later.select(*KEY, F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("line")).distinct()


def deduplicate_lines(docs: DataFrame, staging: Staging, min_words: int = MIN_WORDS, wordless: int = 1,
                      deleted: str = "deleted_lines") -> DataFrame:
    """All rows and columns of ``docs`` with the later copies of repeated runs cut out of ``text``.

    Adds ``deleted``, the sorted numbers (from 0) of the lines that were cut; it must be a name that ``docs`` doesn't have.
    """
    if deleted in docs.columns:
        raise ValueError(f"the documents have a column {deleted}")
    cut = free_name(docs, "_llm_cut")
    marks = repeated_lines(docs.select("doc_id", "text"), staging, min_words, wordless).groupBy(*KEY).agg(
        F.array_sort(F.collect_list("line")).alias(cut))
    marks = staging.write(marks, "marks")
    joined = keyed(docs).join(marks.hint("merge"), KEY, "left").select(
        *docs.columns, F.coalesce(cut, F.array().cast("array<int>")).alias(deleted))
    pieces = F.split("text", "\n", -1)

    def without_cut(lines):
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(deleted))
        return F.array_join(F.transform(kept, lambda at: lines[at]), "\n")

    text = F.when(F.size(deleted) == 0, F.col("text")).otherwise(F.transform(F.array(pieces), without_cut)[0])
    return joined.withColumn("text", text)
