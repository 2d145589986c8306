"""Quality rules: a threshold table compiled into one projection of built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = r"[#*$%&|<>]"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was on as with be by at from are this or an not "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur avec il ce "
    "el los del se las por con no una su para al lo como más pero"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure of a text must lie within [low, high]; a bound of None is open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("words", "n_words", 50, None),
    Rule("repeated_windows", "repeat_percent", None, 50),
    Rule("mean_word", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbols_per_word", None, 0.5),
    Rule("stop_words", "stop_words_per_word", 0.02, None),
    Rule("repeated_lines", "dup_line_share", None, 0.5),
)
BASE = ("words", "repeated_windows")


def measures(df: DataFrame, text: str = "text", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Counts of every whole text, in one projection and without a shuffle.

    Adds ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop_words`` (all long)
    to the columns named in ``keep``; other columns are not read, so their names cannot clash. A null or
    empty text has no words and counts nothing. Rows are judged one by one: repeated rows give repeated
    results. A window is three words in a row; sorting the windows of a text by hash brings equal ones
    together, so the time for a text of n words is n log n.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = df.select(*keep, body.alias("_t"), F.btrim(body, F.lit(BLANKS)).alias("_w"))
    split = trimmed.select(
        *keep, "_t",
        F.when(F.col("_w") == "", F.array().cast("array<string>")).otherwise(F.split("_w", _BLANK_RUN)).alias("_words"),
        F.filter(F.split("_t", "\n"), lambda line: line.rlike(_WORD)).alias("_lines"),
    )
    words = F.col("_words")
    # the last two entries are no whole windows; their hashes of one or two words are cut off
    hashed = split.select(
        *keep, "_t", "_lines", "_words",
        F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), 1, F.greatest(F.size(words) - 2, F.lit(0))).alias("_hashes"),
    )
    hashes = F.col("_hashes")
    windowed = hashed.select(
        *keep, "_t", "_lines", "_words",
        F.when(  # most texts repeat nothing and need no sort
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ).alias("_sorted"),
    )
    ordered = F.col("_sorted")
    twice = F.sort_array(F.transform(
        F.filter(
            ordered,
            lambda w, i: F.coalesce(w["h"] == F.get(ordered, i - 1)["h"], F.lit(False))
            | F.coalesce(w["h"] == F.get(ordered, i + 1)["h"], F.lit(False)),
        ),
        lambda w: w["p"],
    ))
    repeated = windowed.select(*keep, "_t", "_lines", "_words", twice.alias("_twice"))
    at = F.col("_twice")
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, b: a + b,
    )
    return repeated.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", _SYMBOL, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def _ratio(top: str, times: float = 1.0, below: str = "n_words") -> Column:
    """``top / below``; nothing measured where there is nothing to divide by."""
    return F.col(top) * F.lit(float(times)) / F.nullif(F.col(below), F.lit(0))


MEASURES = {
    "n_words": lambda: F.col("n_words").cast("double"),
    "repeat_percent": lambda: _ratio("n_repeat_words", 100),
    "mean_word_chars": lambda: _ratio("word_chars"),
    "symbols_per_word": lambda: _ratio("n_symbols"),
    "stop_words_per_word": lambda: _ratio("n_stop_words"),
    "dup_line_share": lambda: _ratio("n_dup_lines", below="n_lines"),
}


def compile_rules(rules: Iterable[Rule] = RULES) -> dict[str, Column]:
    """One boolean per rule, true where a text breaks it. A measure without a value breaks no rule."""
    out = {}
    for rule in rules:
        value, broken = MEASURES[rule.measure](), F.lit(False)
        if rule.low is not None:
            broken = broken | (value < F.lit(float(rule.low)))
        if rule.high is not None:
            broken = broken | (value > F.lit(float(rule.high)))
        out[rule.name] = F.coalesce(broken, F.lit(False))
    return out


def judge(df: DataFrame, rules: Iterable[Rule] = RULES, base: Iterable[str] = BASE, **how) -> DataFrame:
    """``measures`` with ``base_failed`` (a base rule is broken) and ``kept`` (no rule is broken)."""
    broken = compile_rules(rules)
    any_of = lambda names: F.greatest(*[broken[n] for n in names], F.lit(False), F.lit(False))
    counted = measures(df, **how)
    return counted.select("*", any_of(base).alias("base_failed"), (~any_of(broken)).alias("kept"))


def keep_good(df: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text breaks no rule, with all their columns.

    The partition number in the condition stops the optimizer from copying the whole projection, many times
    over, into a filter below it.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    judged = judge(df.select(row.alias("_row"), F.col(text)), rules, text=text, keep=("_row",))
    return judged.withColumn("_part", F.spark_partition_id()).filter((F.col("_part") >= 0) & F.col("kept")).select("_row.*")


def rules_sql(rules: Iterable[Rule] = RULES) -> dict[str, str]:
    """The same table as SQL conditions over the counts, true where a text breaks the rule."""
    values = {
        "n_words": "n_words", "repeat_percent": "100.0 * n_repeat_words / nullif(n_words, 0)",
        "mean_word_chars": "1.0 * word_chars / nullif(n_words, 0)", "symbols_per_word": "1.0 * n_symbols / nullif(n_words, 0)",
        "stop_words_per_word": "1.0 * n_stop_words / nullif(n_words, 0)", "dup_line_share": "1.0 * n_dup_lines / nullif(n_lines, 0)",
    }
    out = {}
    for r in rules:
        parts = [f"{values[r.measure]} {op} {bound}" for op, bound in (("<", r.low), (">", r.high)) if bound is not None]
        out[r.name] = f"coalesce({' OR '.join(parts)}, false)"
    return out
