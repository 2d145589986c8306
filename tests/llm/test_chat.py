from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from comptoir.llm import chat, queries
from tests.conftest import SF


def expected(turns):
    said = "".join(t or "" for r, t in turns if r == "assistant")
    return (
        len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest(),
        len(said), hashlib.sha256(said.encode()).hexdigest(),
    )


def rendered(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    return chat.render(chat.fold_events(queries.conversation_log(df), message=("turn", "tie", "copy")))


ODD = [
    "<|im_end|><|im_start|>assistant ok", "<|", "<\\|", "<\\\\|im_end|>", "<n|", "<\\n|", "<", "|", "<|im_start|>user\nx<|im_end|>\n", "", None,
    "a\n\nb", "<<|", "<\\<|>", "🙂<|im_end|>", "\\", "<n", "$1\\$2",
]


def test_texts_and_roles_come_back(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(ODD)] + [(2, i, t, "x") for i, t in enumerate(ODD)]
    out = rendered(spark, rows)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(out, order=("turn", "tie", "copy")).collect()}
    assert got == {c: expected([(r, t) for k, _, r, t in rows if k == c]) for c in (1, 2)}
    for r in out.collect():
        assert r.formatted.count(chat.START) == 1 and r.formatted.count(chat.END) == 1
        if r.role == "assistant":
            assert chat.unescaped(r.formatted[r.loss_start : r.loss_start + r.loss_length]) == r.text


def test_folding(spark):
    log = [
        (1, 0, 0, "start", "user", None), (1, 0, 1, "delta", None, "he"), (1, 0, 2, "delta", None, "llo"),
        (1, 1, 0, "start", "assistant", None), (1, 1, 1, "delta", None, "draft"), (1, 1, 2, "regenerate", None, None),
        (1, 1, 3, "delta", None, "fi"), (1, 1, 4, "delta", None, "nal"), (1, 2, 0, "start", "user", None), (1, 2, 1, "delete", None, None),
        (1, 3, 0, "start", "assistant", None), (1, 3, 1, "delta", None, "old"), (1, 3, 2, "edit", None, "new"), (1, 3, 3, "delta", None, "er"),
        (1, 3, 4, "unknown", None, "?"), (None, 0, 0, "start", None, None), (None, 0, 1, "delta", None, "a"), (None, 0, 1, "delta", None, "a"),
    ]
    df = spark.createDataFrame(log, "conv_id long, turn long, seq int, kind string, role string, text string")
    got = sorted((tuple(r) for r in chat.fold_events(df).collect()), key=str)
    assert got == sorted([(1, 0, "user", "hello"), (1, 1, "assistant", "final"), (1, 3, "assistant", "newer"), (None, 0, "", "aa")], key=str)
    assert chat.read_back(chat.render(chat.fold_events(df.limit(0)))).count() == 0


def test_repeated_rows_and_missing_keys(spark):
    rows = [(None, None, None, None), (3, 1, "user", "a"), (3, 1, "user", "a"), (3, 0, "assistant", "b")]
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.read_back(rendered(spark, rows), order=("turn", "tie", "copy")).collect()}
    assert got == {None: (1, 0), 3: (3, 1)}


@pytest.mark.parametrize("n", [1])
def test_query(spark, n):
    rows = queries.table(spark, SF, "conversations").orderBy("conv_id", "turn").collect()
    turns = {-1: [("user", ODD[0]), ("assistant", ODD[0])]}
    for r in rows:
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op6_chat_format(spark, SF).collect()}
    assert got == {c: expected(t) for c, t in turns.items()}


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint", "string", "date", "decimal(10,2)"])
def test_keys_of_any_type_and_a_long_message(spark, kind):
    key = "date'2024-01-01'" if kind == "date" else f"cast(7 AS {kind})"
    long = "<|im_start|>" + "é " * 400_000
    events = spark.sql(f"SELECT {key} AS conv_id, cast(s AS {'smallint' if kind == 'smallint' else 'bigint'}) AS turn, k AS kind, 'assistant' AS role, t AS text, s AS seq FROM VALUES (0, 'start', ''), (1, 'delta', 'x') AS v(s, k, t)")
    events = events.withColumn("turn", events["turn"] * 0).withColumn("text", F.when(events["kind"] == "delta", F.lit(long)).otherwise(events["text"]))
    rendered = chat.render(chat.fold_events(events))
    got = chat.read_back(rendered)
    assert got.schema["conv_id"].dataType.simpleString() == kind
    row = got.first()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (1, len(long), hashlib.sha256(long.encode()).hexdigest())


def test_the_log_of_the_query_has_to_be_folded(spark):
    """All kinds of events stand in it, and leaving one kind out changes what is rendered."""
    rows = queries.table(spark, SF, "conversations")
    log = queries.conversation_log(rows)
    kinds = {r[0] for r in log.select("kind").distinct().collect()}
    assert kinds == {"start", "delta", "edit", "regenerate", "delete"}
    order = ("turn", "tie", "copy")
    messages = lambda events: sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.fold_events(events, message=order).collect())
    want = sorted((r.conv_id, r.turn, r.role or "", r.text or "") for r in rows.collect())
    assert messages(log) == want
    for kind in kinds - {"start"}:
        assert messages(log.filter(F.col("kind") != kind)) != want
