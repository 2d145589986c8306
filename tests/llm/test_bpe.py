from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from comptoir.llm import bpe, queries
from tests.conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "Hello,  World!!\n\tit's we'll I'd", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ab" * 5000, "ÉÀ é ﬁ ΟΔΟΣ Σ İstanbul",
    "a<|endoftext|>B <|startoftext|><|startoftext|> <|endoftex", "x\x1cy\x1d.\x1fz \x85q r\xa0s", "日本語テキスト 123 4567 ½²", "🙂🙃 a🙂b", "don't 'S 'T",
    "\x00\x01\x7f", "word " * 3000, "à́ ́", "<|ENDOFTEXT|>",
]


def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("text", ODD)
def test_same_ids_and_text_as_the_library(text):
    vocab, own = bpe.vocabulary(PATH), library()
    (ids,) = vocab.encode([text])
    want = own.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert vocab.decode(ids) == own.decode(want, skip_special_tokens=False)


def test_later_merges_have_later_ranks():
    """All places of a rank may be merged at once only if no merge makes a pair of an earlier rank."""
    vocab = bpe.vocabulary(PATH)
    made = {joined: rank for rank, joined in vocab.ranks.values()}
    for pair, (rank, _) in vocab.ranks.items():
        assert all(made.get(part, -1) < rank for part in divmod(pair, vocab.size))


def test_documents_against_the_library(spark):
    own = library()
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF, "documents").collect()}
    got = queries.op4_bpe_round_trip(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_empty_tables_repeats_and_other_columns(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a b", "y"), (2, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, len(r.ids)) for r in bpe.encode(df, PATH).collect()), key=str)
    assert got == sorted([(1, 0), (1, 0), (None, 8), (2, 0)], key=str)
    assert bpe.encode(df.limit(0), PATH).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bpe.decode(nothing, PATH).first().decoded == ""
