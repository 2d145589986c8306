"""Joins.

Dimensions carry no broadcast hint: Catalyst and AQE broadcast a side when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it
otherwise, with skewed partitions split at run time. All joins here are many to
one or one to one, so no group is ever multiplied out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from comptoir.operators.skew import splittable_join
from comptoir.session import cut_lineage

PREFIX_LENGTHS = 8
"""Lengths of literal beginnings that rules are looked up by, at most."""
FEW_RULES = 32
"""So few rules are no work for an index."""
INLINED = 500
"""Rules without a literal beginning that become part of the expression; more are tried as one list."""


def with_dims(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Inner star join with each ``(dimension, key)``."""
    return reduce(lambda df, d: df.join(d[0], d[1], "inner"), dims, fact)


def join_cast(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner", to: str = "string"
) -> DataFrame:
    """Join on keys of different types, both brought to ``to``; keeps the left key."""
    keyed = right.withColumn("__key", F.col(right_key).cast(to)).drop(right_key)
    return left.withColumn("__key", F.col(left_key).cast(to)).join(keyed, "__key", how).drop("__key")


def left_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return fact.join(dim, on, "left")


def reconcile(spine: DataFrame, on: Sequence[str], *sides: DataFrame) -> DataFrame:
    """Spine of keys left-joined to sides that are already one row per key."""
    return reduce(lambda df, side: df.join(side, list(on), "left"), sides, spine)


def join_day_shop(sales: DataFrame, expenses: DataFrame) -> DataFrame:
    return sales.join(expenses, ["day", "shop_key"], "left")


def with_params(df: DataFrame, **params: object) -> DataFrame:
    """Parameters as constant columns, which fold into the expressions using them."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in params.items()})


def join_valid(fact: DataFrame, periods: DataFrame, key: str, day: str) -> DataFrame:
    """Match on key to the active periods that hold the day; a hash join with the
    range as residual condition."""
    active = periods.filter(F.col("is_active")).withColumnRenamed(key, "__key").drop("is_active")
    held = (F.col(key) == F.col("__key")) & F.col(day).between(F.col("valid_from"), F.col("valid_to"))
    return fact.join(active, held, "inner").drop("__key", "valid_from", "valid_to")


def rule_index(rules: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """Rules by the part of their literal beginning that they are looked up by: ``size, prefix, rules`` in rank order.

    A pattern begins literally up to its first wildcard or escape. It is filed under the greatest of ``lengths`` that
    its beginning covers, 0 if none.
    """
    beginning = F.regexp_extract("pattern", r"^[^%_\\]*", 0)
    size = F.array_max(F.filter(F.array(F.lit(0), *[F.lit(n) for n in lengths]), lambda n: n <= F.length(beginning)))
    filed = rules.withColumn("size", size).withColumn("prefix", F.substring(beginning, F.lit(1), F.col("size")))
    return filed.groupBy("size", "prefix").agg(F.array_sort(F.collect_list(F.struct("priority", "code", "pattern"))).alias("rules"))


def classify_by_rules(
    fact: DataFrame, rules: DataFrame, ref: str = "movement_ref", into: str = "movement_type",
    few: int = FEW_RULES, most_lengths: int = PREFIX_LENGTHS, inlined: int = INLINED,
) -> DataFrame:
    """Code of the first active rule whose LIKE pattern matches, by priority then code.

    Most patterns begin literally, so a reference is looked up by its own beginning, once for each of a few lengths,
    and LIKE is tried on the rules found there alone: the cost of a row hardly depends on the number of rules, of
    which there may be any. The lookups are many-to-one joins; Spark broadcasts the index while it is small and
    shuffles otherwise. Patterns that begin with a wildcard concern every row: they become one expression over it, or,
    beyond ``inlined``, a list that is tried row by row. Up to ``few`` rules are that expression in any case. All of
    these give the same codes. A rule without a code or pattern is no rule.
    """
    usable = F.col("is_active") & F.col("code").isNotNull() & F.col("pattern").isNotNull()
    active = rules.filter(usable).select("priority", "code", "pattern").distinct()
    listed = active.limit(few + 1).collect()
    if len(listed) <= few:
        return _fill_type(fact, _first_code(_inline_rules(listed, ref, active.schema["priority"].dataType)), ref, into)
    begins = F.length(F.regexp_extract("pattern", _BEGINNING, 0))
    counted = [r["n"] for r in active.select(begins.alias("n")).filter("n > 0").distinct().orderBy("n").collect()]
    lengths = counted[:: max(1, -(-len(counted) // most_lengths))]  # with the least, which every literal beginning covers
    index = cut_lineage(rule_index(active, lengths))
    listed = index.filter("size = 0").select(F.inline("rules")).limit(inlined + 1).collect()
    looked_up = [*lengths, *([0] if len(listed) > inlined else [])]
    out, found = fact, []
    for n in looked_up:
        held = index.filter(F.col("size") == n).select(F.col("prefix").alias("__prefix"), F.col("rules").alias("__rules"))
        keyed = out.withColumn("__prefix", F.substring(ref, 1, n) if n else F.lit(""))
        first = F.expr(f"get(filter(__rules, r -> `{ref}` LIKE r.pattern), 0)")
        out = splittable_join(keyed, held, "__prefix", "left").withColumn(f"__found{n}", first).drop("__prefix", "__rules")
        found.append(F.col(f"__found{n}"))
    if len(listed) <= inlined:
        found += _inline_rules(listed, ref, active.schema["priority"].dataType)
    return _fill_type(out, _first_code(found), ref, into).drop(*[f"__found{n}" for n in looked_up])


_BEGINNING = r"^[^%_\\]*"


def rule_index(rules: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """Rules by the part of their literal beginning that they are looked up by: ``size, prefix, rules`` in rank order.

    A pattern begins literally up to its first wildcard or escape. It is filed under the greatest of ``lengths`` that
    its beginning covers, 0 if none.
    """
    beginning = F.regexp_extract("pattern", _BEGINNING, 0)
    size = F.array_max(F.filter(F.array(F.lit(0), *[F.lit(n) for n in lengths]), lambda n: n <= F.length(beginning)))
    filed = rules.withColumn("size", size).withColumn("prefix", F.substring(beginning, F.lit(1), F.col("size")))
    return filed.groupBy("size", "prefix").agg(F.array_sort(F.collect_list(F.struct("priority", "code", "pattern"))).alias("rules"))


def _inline_rules(listed: Sequence[Row], ref: str, priority: DataType) -> list[Column]:
    """The first of the listed rules that matches, as one column, none if there are no rules."""
    ranked = sorted(listed, key=lambda r: (r["priority"] is not None, r["priority"] or 0, r["code"], r["pattern"]))
    found = [
        F.when(F.col(ref).like(r["pattern"]), F.struct(F.lit(r["priority"]).cast(priority).alias("priority"), F.lit(r["code"]).alias("code"), F.lit(r["pattern"]).alias("pattern")))
        for r in ranked
    ]
    # runs of rules nest instead of making one long list, so that each stays a small piece of generated code
    while len(found) > 1:
        found = [F.coalesce(*found[i : i + 16]) for i in range(0, len(found), 16)]
    return found


def _first_code(found: Sequence[Column]) -> Column:
    if len(found) < 2:
        return found[0]["code"] if found else F.lit(None).cast("string")
    return F.array_min(F.array_compact(F.array(*found)))["code"]


def _fill_type(fact: DataFrame, found: Column, ref: str, into: str) -> DataFrame:
    """Set the type where it is empty and a rule was found."""
    if into not in fact.columns:
        return fact.withColumn(into, found)
    is_open = F.col(into).isNull() | (F.col(into) == "")
    return fact.withColumn(into, F.when(is_open & found.isNotNull(), found).otherwise(F.col(into)))


def not_in_target(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return splittable_join(source, target.select(*keys).distinct(), keys, "left_anti")


def restrict_to(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is among ``keys``, which are made distinct before they move."""
    cols = [on] if isinstance(on, str) else list(on)
    return splittable_join(df, keys.select(*cols).distinct(), cols, "left_semi")


def with_usages(moves: DataFrame, locations: DataFrame) -> DataFrame:
    """Usage of the source and of the target location, NULL for an unknown one."""
    usage = locations.select("location_id", "usage")
    source = usage.withColumnsRenamed({"usage": "source_usage"})
    target = usage.withColumnsRenamed({"location_id": "location_dest_id", "usage": "target_usage"})
    return moves.join(source, "location_id", "left").join(target, "location_dest_id", "left")


def enrich_product(
    products: DataFrame, templates: DataFrame, units: DataFrame, categories: DataFrame
) -> DataFrame:
    """Product with the category path and unit name of its template."""
    return (
        products.join(templates, "template_id", "left")
        .join(categories, "category_id", "left")
        .join(units, "uom_id", "left")
    )


def attach_order(rows: DataFrame, orders: DataFrame, on: str = "order_id") -> DataFrame:
    """Give lines or payments the columns of their order; orphans are dropped.

    Both sides are shuffled straight from their scans, which is the shape whose
    skewed partitions AQE splits, so one order with very many lines is no hot task.
    """
    return rows.join(orders, on, "inner")


def fill_from(df: DataFrame, dim: DataFrame, key: str, col: str) -> DataFrame:
    """Fill a missing value from the dimension where it is known there."""
    known = dim.filter(F.col(col).isNotNull()).select(key, F.col(col).alias("__known"))
    filled = df.join(known, key, "left").withColumn(col, F.coalesce(F.col(col), F.col("__known")))
    return filled.select(*df.columns)


def category_paths(categories: DataFrame, separator: str = " / ") -> DataFrame:
    """Path from the root to each category of a parent-id tree.

    Each round doubles how far every chain reaches, so a tree of depth d takes
    log2(d) joins. A chain that meets itself is a cycle: it ends before the
    first repeat. Blank names are left out, and so are unknown parents.
    """
    name = F.coalesce(F.trim("name"), F.lit(""))
    node = F.struct(F.col("id").alias("id"), name.alias("name"))
    state = categories.select("id", F.col("parent_id").alias("next"), F.array(node).alias("chain"))
    while True:
        state = cut_lineage(state)
        is_open = F.col("next").isNotNull()
        if state.filter(is_open).isEmpty():
            break
        ahead = state.select(
            F.col("id").alias("next"), F.col("next").alias("beyond"), F.col("chain").alias("tail")
        )
        longer = F.concat("chain", F.coalesce("tail", F.array().cast(state.schema["chain"].dataType)))
        longer_once = F.array_distinct(longer)
        no_repeat = F.size(longer_once) == F.size(longer)
        moved = state.filter(is_open).join(ahead, "next", "left").select(
            "id", F.when(no_repeat, F.col("beyond")).alias("next"), longer_once.alias("chain")
        )
        state = moved.unionByName(state.filter(~is_open))
    named = F.filter(F.reverse("chain"), lambda n: n["name"] != "")
    return state.select(
        "id", F.array_join(F.transform(named, lambda n: n["name"]), separator).alias("path")
    )
