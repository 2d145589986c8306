from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from comptoir.llm import queries
from comptoir.llm import suffix_dedup as sd
from comptoir.llm.suffix_array import closed, heads, permuted_prefixes, suffix_array
from tests.conftest import SF


def test_suffix_array_against_sorting():
    r = random.Random(5)
    for _ in range(300):
        text = np.array([r.randint(0, r.choice([1, 2, 5, 250])) for _ in range(r.randint(1, 70))] * r.randint(1, 3), np.uint8)
        raw = text.tobytes()
        order = suffix_array(closed(text))
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = permuted_prefixes(heads(closed(text), 24), order, 16)
        for a, b in zip(order, order[1:]):
            n = 0
            while n < 16 and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert shared[b] == n


@pytest.mark.parametrize("text", [b"a" * 2000, bytes(range(200)) * 3, bytes(range(199, -1, -1)), b"", b"x"])
def test_suffix_array_of_runs(text):
    order = suffix_array(closed(np.frombuffer(text, np.uint8)))
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def check(spark, texts, **kw):
    df = spark.createDataFrame(texts, "doc_id long, text string, removed string, begin string")
    got = {}
    for row in sd.remove_repeats(df, **kw).collect():
        gone = sum(s["to"] - s["from"] for s in row.removed)
        assert row.n_bytes - gone == len(row.kept)
        got[row.doc_id] = (row.n_bytes, gone, len(row.removed), hashlib.sha256(row.kept).hexdigest())
    want = sd.brute_force([(d, (t or "").encode()) for d, t, *_ in texts], kw.get("length", sd.LENGTH))
    assert got == want


def corpus():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(40) for _ in range(4)]
    texts = [None, "", "short", "a" * 99, "a" * 100, "a" * 101, "b" * 5000, "Of " * 700, shared[0] * 6]
    for i in range(60):
        parts = [prose(r.randint(5, 60))]
        for _ in range(r.randint(0, 3)):
            parts += [r.choice(shared)[r.randint(0, 60) :], prose(r.randint(1, 40))]
        texts.append("".join(parts))
    texts += [texts[12], texts[12], texts[20][:150], texts[21] + texts[22], texts[30][50:] + "x", shared[1]]
    order = list(range(len(texts)))
    r.shuffle(order)
    return [(i, texts[k], "x", "y") for i, k in enumerate(order)]


def test_against_brute_force(spark):
    check(spark, corpus())


def test_hot_anchors_and_small_blocks(spark, monkeypatch):
    """Every anchor dealt by what its windows hold, many shards, texts longer than a block."""
    monkeypatch.setattr(sd, "HOT", 1)
    monkeypatch.setattr(sd, "SHARD_BYTES", 500)
    monkeypatch.setattr(sd, "_STEP", 700)
    check(spark, corpus())


def test_segments_partition_all_windows():
    raw = " ".join(f"w{i * i % 113}" for i in range(900)).encode()
    at = np.array([0, 50, 50, 1200, len(raw)])
    row, begin, windows, anchor, lead = sd.segments(np.frombuffer(raw, np.uint8), at)
    got = [(r, w) for r, b, n in zip(row, begin, windows) for w in range(b, b + n)]
    assert got == [(r, w) for r in range(4) for w in range(max(0, at[r + 1] - at[r] - 99))]
    assert (lead >= windows - 1).all() and (lead <= 68).all()


def test_repeated_and_missing_ids(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(300))
    df = spark.createDataFrame([(7, long), (7, long), (None, long[:150]), (7, "z" * 40)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in sd.remove_repeats(df).collect())
    whole = {d: sd.brute_force([(0, long[:150].encode()), (1, long.encode()), (2, long.encode())])[d] for d in range(3)}
    assert got == [(0, 150, 150 - whole[0][1]), (7, 40, 40), (7, 300, 300 - whole[2][1]), (7, 300, 300 - whole[1][1])]
    assert sd.remove_repeats(df.limit(0)).count() == 0


def test_query_on_documents(spark):
    texts = [(r.doc_id, (r.text or "").encode()) for r in queries.table(spark, SF, "documents").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op1_suffix_dedup(spark, SF).collect()}
    assert got == sd.brute_force(texts)


def test_shards_keep_each_segment_once_at_its_earliest_place(monkeypatch):
    """Repeated segments across batches and suffix arrays that close at a shard's turn, without a row loop."""
    import pyarrow as pa

    monkeypatch.setattr(sd, "SHARD_BYTES", 40)
    seen = []
    monkeypatch.setattr(sd, "earliest", lambda found, length: seen.append(sorted(found)) or (np.zeros(0, np.int64),) * 3)
    rng = random.Random(5)
    rows = sorted((rng.randrange(6), bytes([65 + rng.randrange(3)]) * rng.randrange(1, 12), rng.randrange(4), rng.randrange(9)) for _ in range(300))
    batches = [pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 37]), [pa.int64(), pa.binary(), pa.int64(), pa.int64()])],
                               ["shard", "bytes", "doc", "begin"]) for a in range(0, len(rows), 37)]
    list(sd._shards(sd.LENGTH)(iter(batches)))
    want, found, size, last = [], {}, 0, None
    for shard, piece, doc, begin in rows:
        if shard != last and size >= 40:
            want.append(sorted((*p, k[1]) for k, p in found.items()))
            found, size = {}, 0
        last = shard
        if (shard, piece) not in found:
            found[shard, piece], size = (doc, begin), size + len(piece)
    want.append(sorted((*p, k[1]) for k, p in found.items()))
    assert seen == want
