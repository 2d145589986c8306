"""Splitting groups that hold a large share of the rows.

Sums, counts, maxima and top-1 windows need nothing from here: Spark collapses
each group inside every task before the shuffle. What needs help is an operator
that must keep every row of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def row_salt(columns: Sequence[str], salts: int = SALTS) -> Column:
    """Salt that spreads a group, also one of equal rows.

    A hash of the columns separates rows that differ in them; the partition
    number separates copies. Both come out the same when a task is run again.
    """
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns], F.spark_partition_id()), F.lit(salts))


def splittable_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Many-to-one join whose skewed partitions AQE can split, also when ``right``
    is a grouped or ranked frame.

    AQE splits a partition only if both inputs of the join come straight out of
    a shuffle. A right side already grouped by the key is not shuffled again, so
    its frequent keys would each stay one task. Joining on a hash of the key as
    well makes both sides shuffle right at the join; small sides are still
    broadcast. With ``null_safe`` missing keys equal each other.
    """
    on = [on] if isinstance(on, str) else list(on)
    keyed = right.withColumnsRenamed({k: f"__r_{k}" for k in on})
    cond = F.xxhash64(*on) == F.xxhash64(*[f"__r_{k}" for k in on])
    for k in on:
        cond = cond & (F.col(k).eqNullSafe(F.col(f"__r_{k}")) if null_safe else F.col(k) == F.col(f"__r_{k}"))
    return left.join(keyed, cond, how).drop(*[f"__r_{k}" for k in on])
