"""Ranking, numbering and sorting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comptoir.operators.skew import SALTS, row_salt, splittable_join


HOT = 100_000
"""Rows of a key that are too many for one task."""


def pg_asc(c: str) -> Column:
    """Ascending with missing values last."""
    return F.col(c).asc_nulls_last()


def pg_desc(c: str) -> Column:
    """Descending with missing values first."""
    return F.col(c).desc_nulls_first()


def numbered(df: DataFrame, order: Sequence[str], per: str = "day", period: bool = False, into: str = "numero") -> DataFrame:
    """Number aggregated rows within each day, or on through all days of a period.

    For a period, the rows of earlier days are added as an offset. Only the
    per-day counts are summed in one place, never the rows themselves.
    """
    if period:
        df = df.repartition(per)  # once, under the numbering and the counts
    within = Window.partitionBy(per).orderBy(*[pg_asc(c) for c in order])
    out = df.withColumn(into, F.row_number().over(within))
    if not period:
        return out
    counts = df.groupBy(per).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(per).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(per, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    return out.join(offsets, per).withColumn(into, (F.col(into) + F.col("__before")).cast("int")).drop("__before")


def dedup_latest(df: DataFrame, key: Sequence[str], ts: str, seq: Sequence[str]) -> DataFrame:
    """Per key the row with the greatest time, the last by ``seq`` among equals.

    Spark keeps the top row per key in every task before it shuffles, so a key
    with very many versions is cheap.
    """
    latest = Window.partitionBy(*key).orderBy(
        F.col(ts).desc_nulls_last(), *[F.col(s).desc_nulls_last() for s in seq]
    )
    return df.withColumn("__rn", F.row_number().over(latest)).filter("__rn = 1").drop("__rn")


def flag_duplicates(
    df: DataFrame, key: Sequence[str], order: Sequence[str], into: str = "dup_flag", salts: int = SALTS
) -> DataFrame:
    """0 for the first row of a key, 1 for every later one.

    Keys with at most ``HOT`` rows, found by a count that moves keys alone, are
    ranked whole, in one shuffle. The others, of which there can be only few, are
    broadcast. Of their rows a first pass finds the first within each salted part
    of a key; only these can be first overall, so the second pass ranks just them
    together and leaves the rest of a large group where it is.
    """
    ranked = [F.col(c).asc_nulls_last() for c in order]
    large = df.groupBy(*key).count().filter(F.col("count") > HOT).select(*[F.col(k).alias(f"__l_{k}") for k in key])
    is_large = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__l_{k}")) for k in key])
    usual = df.join(F.broadcast(large), is_large, "left_anti")
    whole = Window.partitionBy(*key).orderBy(*ranked)
    usual = usual.withColumn(into, F.when(F.row_number().over(whole) == 1, 0).otherwise(1))
    return usual.unionByName(_flag_in_parts(df.join(F.broadcast(large), is_large, "left_semi"), key, ranked, order, into, salts))


def _flag_in_parts(df: DataFrame, key: Sequence[str], ranked: list[Column], order: Sequence[str], into: str, salts: int) -> DataFrame:
    salted = df.withColumn("__salt", row_salt(order, salts))
    part = Window.partitionBy(*key, "__salt").orderBy(*ranked)
    step = salted.withColumn("__rn", F.row_number().over(part))
    step = step.withColumn("__part", F.when(F.col("__rn") == 1, F.lit(-1)).otherwise(F.col("__salt")))
    whole = Window.partitionBy(*key, "__part").orderBy(*ranked)
    first = (F.col("__part") == -1) & (F.row_number().over(whole) == 1)
    return step.withColumn(into, F.when(first, 0).otherwise(1)).drop("__salt", "__rn", "__part")


def flag_across_loads(
    new: DataFrame, seen: DataFrame | None, key: Sequence[str], order: Sequence[str], into: str = "dup_flag",
) -> dict[str, DataFrame]:
    """The flag of ``flag_duplicates`` for one load after others, as if all had been one.

    ``seen`` is the state of earlier loads: key and order of the first row of each key. Returns ``rows`` with the flag,
    the next ``seen``, and ``demoted``: keys and orders of rows that were first until now, and are not any more because
    this load has an earlier one. A row that equals the first one in its order is a copy of it. The state is joined
    many to one, so a key with very many rows is dealt to several tasks; it grows with the keys, not with the rows.
    """
    key, order = list(key), list(order)
    rank = lambda p: F.struct(*[c for o in order for c in (F.col(f"{p}{o}").isNull().alias(f"no_{o}"), F.col(f"{p}{o}").alias(o))])
    flagged = flag_duplicates(new, key, order, into)
    firsts = flagged.filter(F.col(into) == 0).select(*key, *order)
    if seen is None:
        return {"rows": flagged, "seen": firsts, "demoted": firsts.limit(0)}
    known = seen.select(*key, *[F.col(o).alias(f"__s_{o}") for o in order], F.lit(True).alias("__known"))
    beside = splittable_join(flagged, known, key, "left", null_safe=True)
    later = F.coalesce(F.col("__known") & (rank("__s_") <= rank("")), F.lit(False))
    rows = beside.withColumn(into, F.when(later, 1).otherwise(F.col(into))).select(*flagged.columns)
    first_of = F.min_by(F.struct(*order), rank(""))
    state = seen.select(*key, *order).unionByName(firsts).groupBy(*key).agg(first_of.alias("__first")).select(*key, "__first.*")
    passed = splittable_join(firsts, known, key, "inner", null_safe=True).filter(rank("") < rank("__s_"))
    return {"rows": rows, "seen": state, "demoted": passed.select(*key, *[F.col(f"__s_{o}").alias(o) for o in order])}


def top_one(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``: a lookup that cannot multiply rows."""
    first = Window.partitionBy(*key).orderBy(*[pg_asc(c) for c in order])
    return df.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")


def sorted_report(df: DataFrame, order: Sequence[str], desc: Sequence[str] = ()) -> DataFrame:
    """Presentation order with the database's placing of missing values."""
    return df.orderBy(*[pg_desc(c) if c in desc else pg_asc(c) for c in order])
