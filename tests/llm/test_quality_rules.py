from __future__ import annotations

import re
from collections import Counter

from comptoir.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(hit))


TEXTS = [
    None, "", "  \n\t ", "one", "one two", "a a a", "a a a a a a", "a b c a b c", "a b c d e a b c d f", "x\n\nx\n \nx\ny", "é ü z\x0b#$ %",
    "the cat " * 40, "a\x1cb c \x85 d", "🙂 🙂 🙂 🙂", " lead and trail \n", "w " * 5000, " ".join(f"w{i % 997}" for i in range(20000)), "a b c b c a b c b",
]


def test_counts_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string")
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in q.measures(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_verdicts(spark):
    prose = " ".join(f"the w{i} of x{i}" for i in range(40))
    junk = {2: "w" * 2000, 3: " ".join(f"W{i}!!" for i in range(90)), 4: " ".join(f"w{i}***" for i in range(90)), 5: "the same again " * 60, 6: None}
    df = spark.createDataFrame([(1, prose), *junk.items()], "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in q.judge(df).collect()}
    assert got[1] == (False, True)
    assert not any(kept for i, (_, kept) in got.items() if i > 1)
    assert got[6][0] and got[5][0] and not got[3][0]


def test_no_python_and_no_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    text = q.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_empty_table_and_null_id(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert q.judge(df.limit(0)).count() == 0
    assert [r.n_words for r in q.judge(df).collect()] == [2, 2]
