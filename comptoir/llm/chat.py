"""Conversations rebuilt from an event log and rendered as training text with a loss mask.

A log holds events of messages: ``start`` (names the role), ``delta`` (streamed text, appended), ``edit``
(replaces the text so far), ``regenerate`` (throws the text away; deltas that follow build it anew) and
``delete``. Events are dealt by conversation and message, sorted by sequence and folded in one pass, so a
conversation of any length is split over tasks until its messages are final.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import arrow_map

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"

# `<|` opens every control string. Between `<` and `|` a text gets one more backslash than it had, so no
# escaped text holds `<|`; `<n|` stands for a line end in a role.
_OPENING = r"<(\\*)(n?)\|"


def escaped(text: Column, one_line: bool = False) -> Column:
    out = F.regexp_replace(text, _OPENING, r"<\\$1$2|")
    return F.replace(out, F.lit("\n"), F.lit("<n|")) if one_line else out


def unescaped(text: str) -> str:
    return re.sub(_OPENING, lambda m: f"<{m[1][1:]}{m[2]}|" if m[1] else "\n" if m[2] else m[0], text)


def fold_events(
    events: DataFrame, key: str = "conv_id", message: Sequence[str] = ("turn",), seq: str = "seq",
    kind: str = "kind", role: str = "role", text: str = "text",
) -> DataFrame:
    """The final messages: ``key``, the ``message`` columns, ``role`` and ``text``.

    A message is what shares ``key`` and ``message`` (nulls are values like others). Events count in the
    order of ``seq``, ties in the order of kind, role and text; repeated events count as often as they
    occur. Null texts and roles are empty; unknown kinds change nothing; a deleted message is left out
    unless a later event starts it again. Only the named columns are read.
    """
    source = events.select(
        F.col(key).alias("c"), *[F.col(m).alias(f"m{i}") for i, m in enumerate(message)], F.col(seq).alias("s"),
        F.col(kind).alias("k"), F.coalesce(F.col(role), F.lit("")).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    own = ["c", *[f"m{i}" for i in range(len(message))]]

    def run(batches):
        at, spoke, said, alive = None, "", [], False
        for batch in batches:
            schema = pa.schema([*[batch.schema.field(i) for i in range(len(own))], ("r", pa.string()), ("t", pa.string())])
            done = []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row in zip(*columns):
                place, what, who, words = row[: len(own)], *row[-3:]
                if place != at:
                    if at is not None and alive:
                        done.append((*at, spoke, "".join(said)))
                    at, spoke, said, alive = place, "", [], True
                if what == "start":
                    spoke, said, alive = who, [], True
                elif what == "delta":
                    said.append(words)
                elif what == "edit":
                    said = [words]
                elif what == "regenerate":
                    said = []
                elif what == "delete":
                    alive = False
            if done:
                yield _batch(done, schema)
        if at is not None and alive:
            yield _batch([(*at, spoke, "".join(said))], schema)

    kinds = {f.name: f.dataType for f in source.schema.fields}
    ddl = ", ".join([f"{c} {kinds[c].simpleString()}" for c in own] + ["r string", "t string"])
    folded = source.repartition(*own).sortWithinPartitions(*own, "s", "k", "r", "t").transform(arrow_map, run, ddl)
    return folded.toDF(key, *message, "role", "text")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def render(messages: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Adds ``formatted``, the message as it stands in the training text, and ``loss_start`` and
    ``loss_length``: the characters of ``formatted`` that are learned (null, but for assistants).

    A conversation's text is its messages' ``formatted`` in order. Null roles and texts are empty.
    """
    head = F.concat(F.lit(START), escaped(F.coalesce(F.col(role), F.lit("")), one_line=True), F.lit("\n"))
    body = escaped(F.coalesce(F.col(text), F.lit("")))
    learned = F.col(role) == LEARNED_ROLE
    return messages.withColumns({
        "formatted": F.concat(head, body, F.lit(END + "\n")),
        "loss_start": F.when(learned, F.length(head).cast("long")),
        "loss_length": F.when(learned, F.length(body).cast("long")),
    })


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def read_back(rendered: DataFrame, key: str = "conv_id", order: Sequence[str] = ("turn",)) -> DataFrame:
    """Per conversation, parsed from ``formatted`` and the loss spans alone: turns, digests and lengths.

    Conversations are read as sorted streams, so a task holds one message at a time, whatever its length; a digest of a whole
    conversation cannot be split further.
    """
    def run(batches):
        at, first = None, True
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), *figures])
            done = []
            for conv, formatted, start, length in zip(*[batch.column(n).to_pylist() for n in ("c", "formatted", "loss_start", "loss_length")]):
                if first or conv != at:
                    if not first:
                        done.append(_digest(at, state))
                    at, first, state = conv, False, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for m in _TURN.finditer(formatted):
                    state[0] += 1
                    state[1].update(f"{unescaped(m[1])}\n{unescaped(m[2])}\n".encode())
                if start is not None:
                    learned = unescaped(formatted[start : start + length])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(formatted)
            if done:
                yield _batch(done, schema)
        if not first:
            yield _batch([_digest(at, state)], schema)

    kind = rendered.schema[key].dataType.simpleString()
    figures = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    source = rendered.select(F.col(key).alias("c"), *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], "formatted", "loss_start", "loss_length")
    by = [f"o{i}" for i in range(len(order))]
    ddl = f"c {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return source.repartition("c").sortWithinPartitions("c", *by).transform(arrow_map, run, ddl).withColumnRenamed("c", key)


def _digest(conv, state) -> tuple:
    return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
