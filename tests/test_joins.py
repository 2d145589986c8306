from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from comptoir.operators import joins as jn
from tests.conftest import plan, rows

RULE = "code string, pattern string, priority int, is_active boolean"


@pytest.mark.parametrize("idle", [0, 300])
def test_rules_by_priority_then_code(spark, idle):
    rules = spark.createDataFrame(
        [("B", "X%", 1, True), ("A", "X%", 1, True), ("LOW", "%", 9, True), ("OFF", "%", 0, False), ("BIG", "%99", 3, True),
         (None, "%", 0, True), ("NONE", None, 0, True), *[(f"I{i}", f"no such {i}%", i % 7, True) for i in range(idle)]], RULE
    )
    fact = spark.createDataFrame(
        [(1, "X99", None), (2, "Y99", ""), (3, "Y", "KEPT"), (4, None, None), (5, "Z", None)],
        "i int, movement_ref string, movement_type string",
    )
    typed = jn.classify_by_rules(fact, rules).select("i", "movement_type")
    assert rows(typed) == [(1, "A"), (2, "BIG"), (3, "KEPT"), (4, None), (5, "LOW")]


def test_no_rule_matches(spark):
    fact = spark.createDataFrame([(1, "Q", "")], "i int, movement_ref string, movement_type string")
    rules = spark.createDataFrame([], RULE)
    assert rows(jn.classify_by_rules(fact, rules).select("movement_type")) == [("",)]


RULES_OF_ALL_KINDS = [
    *[(f"P{i:05d}", f"REF/{i}%", 1 + i % 5, True) for i in range(300)], *[(f"L{n}", "R" * n + "_%", 3, True) for n in range(1, 30)],
    ("ESC", r"100\%%", 2, True), ("EXACT", "exact", 0, True), ("SUFFIX", "%7", 4, True), ("SAME_B", "REF/1%", 1, True), ("SAME_A", "REF/1%", 1, True),
    ("NOPRIO", "REF/9_", None, True), ("OFF", "REF/%", 0, False), ("E", "é%", 1, True),
]


def expected_code(ref):
    def like(pattern):
        out, i = "", 0
        while i < len(pattern):
            c = pattern[i]
            if c == "\\":
                i += 1
                out += re.escape(pattern[i])
            else:
                out += {"%": ".*", "_": "."}.get(c, re.escape(c))
            i += 1
        return re.fullmatch(out, ref, re.DOTALL) is not None

    hits = [(p is not None, p or 0, c) for c, pattern, p, on in RULES_OF_ALL_KINDS if on and like(pattern)]
    return min(hits)[2] if hits else None


@pytest.mark.parametrize("how", [{}, {"few": 10_000}, {"inlined": 0}, {"most_lengths": 1}, {"most_lengths": 3, "inlined": 0}])
def test_rules_by_their_literal_beginning(spark, how):
    """The index, the expression and the list give the code that the definition gives."""
    refs = [None, "", "R", "RR", "RRRRRx", "R" * 40, "exact", "exactly", "100%", "100%x", "1000", "REF/", "REF/1", "REF/17", "REF/299/x", "REF/91", "x7", "éé", "e", "REF/300\n7"]
    fact = spark.createDataFrame([(i, r) for i, r in enumerate(refs)], "i int, movement_ref string")
    rules = spark.createDataFrame(RULES_OF_ALL_KINDS, RULE)
    got = jn.classify_by_rules(fact, rules, **how)
    assert got.columns == ["i", "movement_ref", "movement_type"]
    assert rows(got.select("i", "movement_type")) == sorted(((i, None if r is None else expected_code(r)) for i, r in enumerate(refs)), key=lambda x: str(x[0]))


def test_any_number_of_rules(spark):
    """20,000 rules: no shuffle of the rows, none compared with more than those that begin alike."""
    rules = spark.range(20_000).selectExpr("concat('C', id) AS code", "concat('DOC', id, '/%') AS pattern", "cast(id % 7 AS int) AS priority", "true AS is_active")
    fact = spark.range(0, 40_000, 1, 4).selectExpr("id", "concat('DOC', id, '/x') AS movement_ref")
    typed = jn.classify_by_rules(fact, rules)
    assert "hashpartitioning" not in plan(typed) and "NestedLoop" not in plan(typed)
    assert rows(typed.groupBy((F.col("movement_type") == F.concat(F.lit("C"), "id")).alias("own")).count()) == [(None, 20_000), (True, 20_000)]


def test_inline_rules_need_no_shuffle(spark):
    rules = spark.createDataFrame([("A", "X%", 1, True)], RULE)
    fact = spark.range(10).selectExpr("id", "concat('X', id) AS movement_ref")
    assert "Exchange" not in plan(jn.classify_by_rules(fact, rules))


def test_validity_ends_are_inside(spark):
    fact = spark.createDataFrame([("e", date(2024, 1, d)) for d in (1, 2, 4, 5)], "emp string, day date")
    held = spark.createDataFrame(
        [("e", "s", True, date(2024, 1, 2), date(2024, 1, 4)), ("e", "t", False, date(2024, 1, 1), date(2024, 1, 9))],
        "emp string, shop string, is_active boolean, valid_from date, valid_to date",
    )
    got = rows(jn.join_valid(fact, held, "emp", "day").select("day", "shop"))
    assert got == [(date(2024, 1, 2), "s"), (date(2024, 1, 4), "s")]


def walk(nodes: dict) -> dict:
    """Parent by parent, as the definition has it."""
    out = {}
    for start in nodes:
        chain, cur, seen = [], start, set()
        while cur is not None and cur not in seen:
            seen.add(cur)
            name, parent = nodes.get(cur, ("", None))
            chain.append(name.strip())
            cur = parent
        out[start] = " / ".join(x for x in reversed(chain) if x)
    return out


def test_category_paths(spark):
    nodes = {1: ("Root", None), 2: (" Mid ", 1), 3: ("", 2), 4: ("Leaf", 3), 5: ("Orphan", 77)}
    nodes |= {10: ("A", 12), 11: ("B", 10), 12: ("C", 11), 13: ("Tail", 12), 14: ("Self", 14), 15: ("End", 13)}
    nodes |= {100 + i: (f"d{i}", 100 + i - 1 if i else None) for i in range(40)}
    df = spark.createDataFrame([(k, v[0], v[1]) for k, v in nodes.items()], "id long, name string, parent_id long")
    assert dict(rows(jn.category_paths(df))) == walk(nodes)


def test_not_in_target_and_restrict(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n")], "k int, v string")
    tgt = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows(jn.not_in_target(src, tgt, ["k"])) == [(None, "n"), (1, "a")]
    assert rows(jn.restrict_to(src, tgt, "k")) == [(2, "b"), (2, "c")]


def test_fill_keeps_known_values(spark):
    lines = spark.createDataFrame([(1, "own"), (1, None), (2, None), (3, None)], "p int, barcode string")
    dim = spark.createDataFrame([(1, "B1"), (2, None)], "p int, barcode string")
    assert rows(jn.fill_from(lines, dim, "p", "barcode")) == [(1, "B1"), (1, "own"), (2, None), (3, None)]


def test_unknown_location_has_no_usage(spark):
    moves = spark.createDataFrame([(1, 2, 9)], "i int, location_id int, location_dest_id int")
    loc = spark.createDataFrame([(2, "internal")], "location_id int, usage string")
    assert rows(jn.with_usages(moves, loc).select("source_usage", "target_usage")) == [("internal", None)]
