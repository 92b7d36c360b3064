"""Range-split windows: running sums and previous values without a task that holds a whole partition.

The rows are cut into blocks, ranges of (partition, order) at sampled bounds, so that a hot partition spans
many blocks. The window runs within (partition, block); what a block needs of those before it, a sum
or a last value, comes from one row a block and is joined back. Two passes over the input: a partial
aggregate, and the windows. Values are those of the plain window.

The input is read three times with the sample, so pass a table or a staged one (``staging.stage``), not a
long computation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursematch.staging import stage

#: Rows that one block may hold, about; below twice that, one block is enough and the plain window runs.
BLOCK_ROWS = 1 << 20
#: Bounds come to the driver and are part of the plan, so their number is fixed.
MAX_BLOCKS = 2048
SAMPLES = 16


def order_key(columns: Sequence[str]) -> Column:
    """One sortable value for ascending ``columns`` with NULL last."""
    fields = []
    for i, c in enumerate(columns):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def sampled_bounds(df: DataFrame, columns: Sequence[str], block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS) -> list:
    """At most ``max_blocks`` - 1 rows of ``columns`` that cut ``df`` into ranges of about ``block_rows`` rows."""
    n = df.count()
    blocks = min(max_blocks, n // block_rows)
    if blocks < 2:
        return []
    want = SAMPLES * blocks
    picked = df.select(*columns)
    if n > want:
        picked = picked.sample(min(1.0, 1.5 * want / n), seed=11)
    picked = picked.orderBy(*[F.col(c).asc_nulls_last() for c in columns]).limit(4 * want).collect()
    step = max(1, len(picked) // blocks)
    bounds = []
    for r in picked[step::step][: blocks - 1]:
        if not bounds or tuple(r) != tuple(bounds[-1]):
            bounds.append(r)
    return bounds


def block_number(df: DataFrame, columns: Sequence[str], bounds: Sequence) -> Column:
    """How many bounds are at or before a row: a binary search in a constant array."""
    def literal(row) -> Column:
        fields = []
        for i, c in enumerate(columns):
            value = F.lit(row[c]).cast(df.schema[c].dataType)
            fields += [F.lit(row[c] is None).alias(f"n{i}"), value.alias(f"v{i}")]
        return F.struct(*fields)

    if not bounds:
        return F.lit(0)
    array, key, n = F.array(*[literal(r) for r in bounds]), order_key(columns), len(bounds)
    steps = [1 << b for b in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, s: F.when(
        (low + s <= n) & (F.element_at(array, F.least(low + s, F.lit(n))) <= key), low + s).otherwise(low))


class Blocks:
    """``df`` with ``_part`` (its partition columns as one value) and ``_block``, and windows over both."""

    def __init__(self, df: DataFrame, partition: Sequence[str], order: Sequence[str], block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS):
        self.columns = df.columns
        keys = [*partition, *order]
        self.bounds = sampled_bounds(df, keys, block_rows, max_blocks)
        self.rows = df.withColumn("_part", F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(partition)])).withColumn("_block", block_number(df, keys, self.bounds))
        self.window = Window.partitionBy("_part", "_block").orderBy(*[F.col(c).asc_nulls_last() for c in order])
        self.upto = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.order = order

    def before(self, **values: tuple[Column, Column]) -> DataFrame:
        """For each block, values over the blocks before it in its partition: (aggregate of a block, window expression over those)."""
        per_block = self.rows.groupBy("_part", "_block").agg(*[a.alias(f"_b_{name}") for name, (a, _) in values.items()])
        run = Window.partitionBy("_part").orderBy("_block")
        return per_block.select(F.col("_part").alias("_bp"), F.col("_block").alias("_bb"), *[w.over(run.rowsBetween(Window.unboundedPreceding, -1)).alias(name) for name, (_, w) in values.items()])

    def join(self, rows: DataFrame, before: DataFrame) -> DataFrame:
        """``rows`` with their block's values; on the windows' own keys, so they aren't shuffled again."""
        return rows.join(before, (rows["_part"] == before["_bp"]) & (rows["_block"] == before["_bb"]), "left").drop("_bp", "_bb")


def running_sum(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str | Column, name: str = "running_sum",
                block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``df`` with the sum of ``value`` from its partition's first row to the current one.

    ``order`` ascends with NULL last and must be total; NULL values add nothing, and the sum is NULL before the first value that
    is not. NULL partition keys form a partition.
    """
    col = F.col(value) if isinstance(value, str) else value
    b = Blocks(df, partition, order, block_rows, max_blocks)
    rows = b.rows.withColumn(name, F.sum(col).over(b.upto))
    if b.bounds:
        joined = b.join(rows, b.before(_offset=(F.sum(col), F.sum("_b__offset"))))
        total = F.when(F.col(name).isNotNull() | F.col("_offset").isNotNull(), F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col("_offset"), F.lit(0)))
        rows = joined.withColumn(name, total).drop("_offset")
    return rows.select(*b.columns, name)


def previous_value(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str | Column, name: str = "previous",
                   block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``df`` with the previous row's ``value`` in its partition (NULL for the first). ``order`` as in ``running_sum``."""
    col = F.col(value) if isinstance(value, str) else value
    b = Blocks(df, partition, order, block_rows, max_blocks)
    rows = b.rows.withColumn(name, F.lag(col, 1).over(b.window))
    if b.bounds:
        last = F.struct(col.alias("v"))
        rows = rows.withColumn("_first", F.row_number().over(b.window) == 1)
        joined = b.join(rows, b.before(_last=(F.max_by(last, order_key(order)), F.last("_b__last"))))
        rows = joined.withColumn(name, F.when(F.col("_first"), F.col("_last.v")).otherwise(F.col(name)))
    return rows.select(*b.columns, name)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[prefix + k])
    return cond


def keep_shown(df: DataFrame, partition: Sequence[str], order: Sequence[str], ends: Column, hides_next: Column, may_hide: Column | None = None,
               only: Column | None = None, block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The rows before their partition's first ``ends`` row whose previous row does not hide them (``hides_next``).

    Equal to a running count of ``ends`` rows of 0 and a false ``hides_next`` of the previous row; NULL is false
    in both. ``only`` keeps some of these rows (its test comes last, but is applied first to the rows that are carried on).

    The rows themselves are not sorted, and each is shuffled once at most (not at all while the tables below are small): the first
    end of each partition is a grouped minimum; the places that are hidden come from a range-split window over the keys of
    those partitions that hide anything. ``may_hide`` is true for the partitions in which a row can hide the next (all of them by
    default) and must be the same for all rows of a partition. Their places that are hidden or not before the end are found
    on keys alone, so one anti-join takes both off the rows; the rows of other partitions meet their first end only. The
    ends and those places are staged, so their measured size decides the joins.
    """
    end, hide = F.coalesce(ends, F.lit(False)), F.coalesce(hides_next, F.lit(False))
    may = F.lit(True) if may_hide is None else F.coalesce(may_hide, F.lit(False))
    key = order_key(order)
    first = stage(df.filter(end).groupBy(*[F.col(k).alias("_e_" + k) for k in partition]).agg(F.min(key).alias("_first")), "first-ends")
    keys = [*partition, *order]
    narrow = df.filter(may).select(*keys, hide.alias("_hide"))
    hiding = narrow.filter("_hide").select(*[F.col(k).alias("_g_" + k) for k in partition]).distinct()
    places = stage(narrow.join(hiding, _same(narrow, hiding, partition, "_g_"), "left_semi"), "places")
    hidden = previous_value(places, partition, order, "_hide", "_hidden", block_rows, max_blocks).filter("_hidden").select(*keys)
    late = narrow.join(first, _same(narrow, first, partition, "_e_")).filter(key >= F.col("_first")).select(*keys)
    gone = stage(hidden.unionAll(late).distinct().select(*[F.col(k).alias("_h_" + k) for k in keys]), "gone")
    rows = df if only is None else df.filter(only)
    shown = rows.filter(may)
    shown = shown.join(gone, _same(shown, gone, keys, "_h_"), "left_anti")
    if may_hide is None:
        return shown
    others = rows.filter(~may)
    others = others.join(first, _same(others, first, partition, "_e_"), "left").filter(F.col("_first").isNull() | (key < F.col("_first"))).select(df.columns)
    return shown.unionAll(others)
