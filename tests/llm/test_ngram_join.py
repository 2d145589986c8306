from __future__ import annotations

import random

import pytest

from comptoir.llm import ngram_join as nj
from comptoir.llm import queries
from comptoir.llm.components import components
from tests.conftest import SF


def grams(text, n=5):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(texts, threshold=0.8):
    sets = {d: grams(t) for d, t in texts.items()}
    ids = sorted(sets)
    links, parent = dict.fromkeys(ids, 0), {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both * 10 >= round(threshold * 10) * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (find(d), links[d]) for d in ids}


def corpus(seed=2, bases=12, each=14):
    r = random.Random(seed)
    out = [None, "", "one", "one two three", "one two three", "a b c d e", "a  b\tc d e", "one two"]
    for _ in range(bases):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.randint(20, 160))]
        for _ in range(each):
            words = list(base)
            for _ in range(r.randint(0, 6)):
                words[r.randrange(len(words))] = f"x{r.randint(0, 10**6)}"
            out.append(" ".join(words[r.randint(0, 3) :]))
        out += [" ".join(base)] * r.randint(0, 3)
    r.shuffle(out)
    return dict(enumerate(out))


def frame(spark, texts):
    return spark.createDataFrame([(d, t, 1, 2) for d, t in texts.items()], "doc_id long, text string, class_id int, n long")


@pytest.mark.parametrize("block", [512, 5])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    texts = corpus()
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute(texts)


def test_bands_reach_the_recall():
    for threshold, recall in [(0.8, 0.9999), (0.5, 0.99), (0.9, 0.999)]:
        bands, rows = nj.choose_bands(threshold, recall)
        assert bands * rows <= nj.MOST_HASHES and 1 - (1 - threshold**rows) ** bands >= recall
    with pytest.raises(ValueError):
        nj.choose_bands(0.1, 0.9999999, 16)


def test_nulls_repeats_and_empty_table(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (3, text), (9, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in nj.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3, 2), (5, 3, 2), (None, None, 0), (3, 3, 2), (9, 9, 0)], key=str)
    assert nj.near_duplicates(df.limit(0)).count() == 0


def test_one_key_with_two_texts(spark):
    """Links of both texts are found."""
    a, b = (" ".join(f"{t}{i}" for i in range(60)) for t in "ab")
    df = spark.createDataFrame([(1, a), (1, b), (2, a + " more"), (3, b + " more")], "doc_id long, text string")
    got = {(r.doc_id, r.class_id) for r in nj.near_duplicates(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}


def buckets(spark, rows):
    return spark.createDataFrame(rows, "rep long, bucket long")


def test_blocks_meet_only_where_a_bucket_says_so(spark, monkeypatch):
    """Every pair of a bucket shares a meeting, and no set travels oftener than its document has candidates."""
    monkeypatch.setattr(nj, "BLOCK", 4)
    r = random.Random(3)
    rows = {(d, r.randint(0, 150)) for d in range(300) for _ in range(3)} | {(d, 1000) for d in range(0, 300, 5)} | {(900, 5000)}
    got = {m.rep: (m.own, m.meets) for m in nj.meetings(buckets(spark, list(rows))).collect()}
    near = {}
    for d, b in rows:
        near.setdefault(d, set()).update(e for e, c in rows if c == b and e != d)
    assert set(got) == {d for d, n in near.items() if n}
    for d, (own, meets) in got.items():
        assert meets[0] == own and len(set(meets)) == len(meets) <= 1 + len(near[d])
        assert {got[e][0] for e in near[d]} | {own} == set(meets)


def test_a_chain_of_candidates_is_no_group(spark, monkeypatch):
    """Chance candidates connect all documents; each still meets its neighbours only."""
    monkeypatch.setattr(nj, "BLOCK", 2)
    chain = [(d, b) for d in range(200) for b in (d, d + 1)]
    got = nj.meetings(buckets(spark, chain)).collect()
    assert len(got) == 200 and max(len(m.meets) for m in got) <= 3


def test_shared_boilerplate_links_nothing(spark, monkeypatch):
    """Pages that share half their words are candidates by chance, and none is linked."""
    monkeypatch.setattr(nj, "BLOCK", 32)
    shared = " ".join(f"menu{i}" for i in range(100))
    texts = {d: shared + " " + " ".join(f"own{d}x{i}" for i in range(45)) for d in range(150)} | {200: "", 201: None}
    texts[300] = texts[3] + " more"
    got = {x.doc_id: (x.class_id, x.n_links) for x in nj.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute(texts) and sum(n for _, n in got.values()) == 2


def test_very_long_text(spark):
    """A text longer than a block of the reader is compared whole."""
    words = [f"w{i}" for i in range(400_000)]
    texts = {1: " ".join(words), 2: " ".join(words[:-10]), 3: " ".join(words[: len(words) // 2]), 4: "short one"}
    got = {x.doc_id: (x.class_id, x.n_links) for x in nj.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute(texts) and got[2][0] == 1 and got[3][0] == 3


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {n: find(n) for n in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op9_ngram_join(spark, SF).collect()}
    assert got == brute(texts)
