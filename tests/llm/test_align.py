from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from comptoir.llm import align, queries
from comptoir.llm.vocab import byte_letters
from tests.conftest import SF

SCHEMA = "doc_id long, text string, doc int, words string, block long"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n  b c", "x \t y  z　 w   v", "<|endoftext|> and <s> </s>", "don't  we'll 's", "ﬁ é é ß",
    "a ▁ b", "▁", "日本 語 の 文 章", "한국 어 문장", "emoji 😀 😀😀 👩‍👩‍👧 x", "\x00 \x1c \x85 q", "tabs\t\tand   many     blanks      here", "end with blanks   ", "1 22 333 4444 55555", "ABC abc Abc",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def brute(libraries, texts):
    """From whole texts, with one loop over all pairs of tokens that may overlap."""
    a, b = libraries
    letters = byte_letters()
    tokens, counts = [], Counter()
    for text in texts:
        side_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        side_b = [(i, bytes([b.id_to_piece(i)[3:5] and int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)] if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(t for _, t in side_a) != whole or b"".join(t for _, t in side_b) != whole:
            tokens.append(([], [], []))
            continue
        spans = []
        for side in (side_a, side_b):
            at, out = 0, []
            for i, t in side:
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        links, low = [], 0
        for i, x, y in spans[0]:
            while spans[1][low][2] <= x:
                low += 1
            k = low
            while k < len(spans[1]) and spans[1][k][1] < y:
                links.append((i, spans[1][k][0]))
                k += 1
        counts.update(links)
        tokens.append((*spans, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(n, best.get(j, 0))
    out = []
    for side_a, side_b, links in tokens:
        ends = sorted({y for *_, y in side_a} & {y for *_, y in side_b})
        groups, places = [], [0, 0]
        for y in ends:
            told = []
            for k, side in enumerate((side_a, side_b)):
                own = []
                while places[k] < len(side) and side[places[k]][2] <= y:
                    own.append(str(side[places[k]][0]))
                    places[k] += 1
                told.append(",".join(own))
            groups.append("|".join(told))
        out.append((
            len(side_a), len(side_b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        ))
    return out


def found(spark, texts):
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], SCHEMA)
    return [tuple(r)[1:] for r in align.overlap_counts(df, *PATHS).orderBy("doc_id").collect()]


def test_odd_texts(spark, libraries):
    texts = ODD + [x + " " + y for x in ODD[2:12] for y in ODD[6:] if x and y] + ODD
    assert found(spark, texts) == brute(libraries, texts)


def test_whole_table(spark, libraries):
    rows = sorted(queries.table(spark, SF, "documents").select("doc_id", "text").collect())
    want = brute(libraries, [r.text for r in rows])
    got = [tuple(r) for r in queries.op12_token_alignment(spark, SF).orderBy("doc_id").collect()]
    assert got == [(r.doc_id, *w) for r, w in zip(rows, want)]


def test_lots_and_blocks(libraries):
    """Many small lots give what one lot does."""
    texts = [" " + t for t in ODD if t] * 3
    a, b = align.ByteSide(PATHS[0], True), align.PieceSide(PATHS[1])
    raw = [np.frombuffer("".join(ts).encode(), np.uint8) for ts in (texts, texts[:20])]
    ats = [np.cumsum([0, *[len(t.encode()) for t in ts]]) for ts in (texts, texts[:20])]
    one, two = (align.align(a, b, r, at, True)[0] for r, at in zip(raw, ats))
    whole = align.align(a, b, raw[0], ats[0], False)[0]
    for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
        assert list(one[k][:20]) == list(two[k]) and list(one[k]) == list(whole[k])


def test_repeats_null_keys_and_long_texts(spark, libraries):
    long = "word piece 12 " * 40_000
    texts = ["same text"] * 3 + [long, "x" * 20_000, None]
    df = spark.createDataFrame([(None, t, 1, "x", 2) if t == "same text" else (7, t, 1, "x", 2) for t in texts], SCHEMA)
    got = sorted((tuple(r)[1:] for r in align.overlap_counts(df, *PATHS).collect()), key=str)
    assert got == sorted(brute(libraries, texts), key=str)


def test_empty_and_null_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert align.overlap_counts(df, *PATHS).count() == 0
    df = spark.createDataFrame([(1, None, 1, "", 2), (2, "", 1, "", 2)], SCHEMA)
    assert [tuple(r) for r in align.overlap_counts(df, *PATHS).orderBy("doc_id").collect()] == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
