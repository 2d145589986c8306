"""Exact positions inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comptoir.operators.skew import splittable_join
from comptoir.session import cut_lineage

_ROW_BITS = 33  # of monotonically_increasing_id, below the partition number


def with_positions(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], into: str = "position", total: str | None = None,
) -> DataFrame:
    """Number the rows of each group from 0 in the given order, and tell the group's size in ``total``.

    All rows are sorted once, in ranges of group and order, so that a group may cover any number of tasks and no
    task has more than its share; ties, also whole rows that repeat, are dealt out by their place in the input.
    The position is the rank inside the task plus the counts of the group in earlier tasks. Missing group values
    are one group. What is counted per group is one row for each task that has some of it.
    """
    group = list(group)
    by = [*[F.col(g).asc_nulls_first() for g in group], *order, F.col("__tie")]
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    held = cut_lineage(
        tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie").withColumn("__row", F.monotonically_increasing_id())
    )
    task = F.shiftright("__row", _ROW_BITS)
    counts = held.groupBy(*group, task.alias("__task")).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        *group, "__task", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias("__total"),
    )
    out = splittable_join(held.withColumn("__task", task), shifts, [*group, "__task"], null_safe=True)
    found = {into: (F.col("__row") + F.col("__shift")).cast("long")} | ({total: F.col("__total").cast("long")} if total else {})
    return out.withColumns(found).select(*df.columns, *found)
