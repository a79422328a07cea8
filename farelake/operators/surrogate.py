"""A contiguous key 1…N in a global order, without sorting everything in one task and without writing the rows for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import Staging

ROWS_PER_RANGE = 5_000_000  # rows that one task sorts, about
RANGES_PER_TASK = 3         # so that tasks are evenly loaded on tables too small for full ranges
SAMPLE = 32                 # sampled keys per range that a crowded bucket is cut into
_KEY = ("_tie", "_copy")


def _bucket(df: DataFrame, column: str) -> Column:
    """A coarse value in the order of the first order column: few enough to be counted and broadcast."""
    if dict(df.dtypes)[column] in ("timestamp", "timestamp_ntz"):
        return F.date_trunc("hour", column)
    return F.lit(0)


def placed(df: DataFrame, order_by: Sequence[str], staging: Staging) -> DataFrame:
    """Rows with ``_tie``, ``_copy``, their range ``_range`` and the number ``_base`` of rows before that range.

    1. Rows are counted per hour of the first order column: only this column is read.
    2. Hours with more rows than a range are cut by a sample of their sort keys, and the rows of the cuts are counted exactly.
    3. The counts, one row per hour or cut, give every cell its offset; neighbouring cells share a range.
    """
    rest = [name for name in df.columns if name not in order_by]
    marked = df.withColumns({
        "_tie": F.xxhash64(*rest) if rest else F.lit(0).cast("long"), "_copy": F.monotonically_increasing_id(),
        "_bucket": _bucket(df, order_by[0])})
    sort_key = F.struct(*order_by, *_KEY)
    counts = staging.write(marked.groupBy("_bucket").agg(F.count("*").alias("_rows")), "key-buckets")
    sizes = counts.agg(F.sum("_rows").alias("rows"), F.max("_rows").alias("most")).first()
    tasks = RANGES_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(1, min(ROWS_PER_RANGE, -(-(sizes["rows"] or 0) // tasks)))
    cells = counts.select("_bucket", F.lit(0).alias("_part"), "_rows")  # an hour is one cell, unless it is cut
    no_cuts = F.array().cast(f"array<{marked.select(sort_key.alias('k')).schema['k'].dataType.simpleString()}>")
    cuts = counts.select("_bucket", no_cuts.alias("_cuts"))

    def part() -> Column:
        return F.size(F.filter("_cuts", lambda cut: cut <= sort_key))

    is_cut = (sizes["most"] or 0) > limit
    if is_cut:
        crowded = counts.where(F.col("_rows") > limit).select("_bucket", F.ceil(F.col("_rows") / limit).cast("int").alias("_parts"), "_rows")
        every = F.greatest(F.lit(1), F.floor(F.col("_rows") / (F.col("_parts") * SAMPLE)))
        sampled = _beside(marked, crowded).where(F.pmod(F.xxhash64(*order_by, *_KEY), every) == 0)
        keys = sampled.groupBy("_bucket", "_parts").agg(F.array_sort(F.collect_list(sort_key)).alias("_keys"))
        at = F.transform(F.sequence(F.lit(1), F.col("_parts") - 1), lambda n: F.ceil(n * F.size("_keys") / F.col("_parts")).cast("int"))
        found = staging.write(keys.select("_bucket", F.transform(at, lambda n: F.element_at("_keys", n)).alias("_cuts")), "key-cuts")
        exact = _beside(marked, found).groupBy("_bucket", part().alias("_part")).agg(F.count("*").alias("_rows"))
        cells = cells.join(F.broadcast(found), cells["_bucket"].eqNullSafe(found["_bucket"]), "left_anti").unionByName(exact)
        cuts = cuts.join(F.broadcast(found), cuts["_bucket"].eqNullSafe(found["_bucket"]), "left_anti").unionByName(found)
    # One row per hour and cut: this bounds the running total and the broadcast.
    before = Window.orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("long")))
    cells = cells.withColumn("_range", F.floor(F.col("_offset") / limit))
    cells = cells.withColumn("_base", F.min("_offset").over(Window.partitionBy("_range")))
    if not is_cut:
        return _beside(marked, cells.drop("_part", "_rows", "_offset")).select(*df.columns, *_KEY, "_range", "_base")
    about = cells.groupBy("_bucket").agg(F.map_from_entries(F.collect_list(F.struct("_part", F.struct("_range", "_base")))).alias("_cells"))
    plan = staging.write(about.join(cuts.withColumnRenamed("_bucket", "_own"), F.col("_bucket").eqNullSafe(F.col("_own"))).drop("_own"), "key-plan")
    cell = F.element_at("_cells", part())
    return _beside(marked, plan).select(*df.columns, *_KEY, cell.alias("_cell")).select(*df.columns, *_KEY, "_cell._range", "_cell._base")


def _beside(marked: DataFrame, about: DataFrame) -> DataFrame:
    """The rows of the buckets in ``about``, with its columns."""
    other = about.withColumnRenamed("_bucket", "_own")
    return marked.join(F.broadcast(other), F.col("_bucket").eqNullSafe(F.col("_own"))).drop("_own")


def add_surrogate_key(df: DataFrame, order_by: Sequence[str], staging: Staging, key: str = "trip_key",
                      replayable: bool = False) -> DataFrame:
    """Number all rows 1…N by ``order_by``, then by a hash of the rest of the row, then by the position in the input.

    Ranges of the order are found from counts alone; the rows are shuffled once, by range, and numbered from the range's
    offset. The hash and the position make every sort key distinct, so a value or a set of identical rows that holds a large
    part of the table is still cut into many ranges.

    ``replayable`` says that a re-run task sees its rows in the same order (a file scan without a shuffle). Otherwise
    the input is staged first: position is part of the key, and a row must not move between counting and numbering.
    """
    source = df if replayable else staging.write(df, "key-input")
    rows = placed(source, order_by, staging)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order_by, *_KEY))
    return rows.select((F.col("_base") + inside).alias(key), *df.columns)
