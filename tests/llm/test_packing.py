from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from comptoir.llm import packing, queries
from tests.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b\n c\t d \n\n e", "a\x1c b \x1c c", "x  y  z", "don't we'll 'S", " lead", "trail ", "a<|endoftext|> b", "日本 語 é", "a \x85 b", "a  \n  b",
    "word " * 1023, "word " * 5000, "🙂 🙂",
]


@pytest.mark.parametrize("text", ODD)
def test_same_ids_as_the_library(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.Encoder(PATH).encode([text, text])[1], "<u4").tolist() == want


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2048, 5000])
def test_cut(n):
    ids = np.arange(n, dtype="<u4").tobytes()
    pieces = list(packing.cut(ids, 1024))
    assert [p[0] for p in pieces] == list(range(len(pieces)))
    assert all(p[2] == 1024 for p in pieces[1:]) and 1 <= pieces[0][2] <= 1024
    assert [p[1] for p in pieces] == np.cumsum([0, *[p[2] for p in pieces]])[:-1].tolist()


def test_best_fit():
    bins = packing.best_fit([600, 400, 500, 24, 1, 1024, 424], 1024)
    assert sorted(map(sorted, bins)) == [[0, 3, 1] and sorted([0, 6]), [1, 2, 3, 4], [5]]


def verify(rows, texts):
    library = Tokenizer.from_file(PATH)
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(docs) == set(texts)
    total = 0
    for d, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        total += len(ids)
        own = sorted(docs[d], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in own] == list(packing.cut(ids.tobytes(), 1024))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *[n for _, n in places]])[:-1].tolist()
        assert sum(n for _, n in places) <= 1024
    return len(sequences), -(-total // 1024)


def test_query(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    used, least = verify(queries.op10_best_fit_packing(spark, SF).collect(), texts)
    assert used <= 1.03 * least + 2


def test_small_lots_and_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_PIECES", 5)
    texts = dict(enumerate([None, *ODD]))
    df = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id long, text string, sequence_id int").repartition(3)
    verify(packing.pack(df, PATH).collect(), texts)


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "doc_id long, text string")
    rows = packing.pack(df, PATH).collect()
    assert sorted(((r.doc_id, r.length) for r in rows), key=str) == [(1, 1), (None, 2), (None, 2)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_crc():
    ids = np.array([5, 6, 2], "<u4").tobytes()
    assert list(packing.cut(ids, 1024)) == [(0, 0, 3, zlib.crc32(ids))]
