from __future__ import annotations

import random
import re

import numpy as np
import pytest

from comptoir.llm import hamming_join as hj

SCHEMA = "doc_id long, text string, sid int, root long, bucket string, n int"


def shingles(text, n=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(texts):
    """By row number: shingles, the smallest id reachable, kept. Rows with one id are one document."""
    sets, above = [shingles(t) for _, t in texts], list(range(len(texts)))

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = texts[i][0] is not None and texts[i][0] == texts[j][0] and sets[i] and sets[j]
            if same or both and 100 * both >= 85 * len(sets[i] | sets[j]):
                above[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(texts):
        if d is not None and sets[i]:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(texts)]
    return sorted([(*r, r[0] == r[2]) for r in out], key=str)


def found(spark, texts):
    df = spark.createDataFrame([(d, t, 1, 2, "x", 3) for d, t in texts], SCHEMA)
    return sorted((tuple(r) for r in hj.near_duplicates(df).collect()), key=str)


def corpus(seed=2, bases=12, each=14, edits=5):
    r = random.Random(seed)
    out = [None, "", " \t\n", "one", "One", "one two three", "a b c d e", "A  b\tc d E", "one two"]
    for _ in range(bases):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.randint(20, 200))]
        for _ in range(each):
            words = list(base)
            for _ in range(r.randint(0, edits)):
                words[r.randrange(len(words))] = f"X{r.randint(0, 10**6)}"
            out.append(" ".join(words[r.randint(0, 3) :]))
        out += [" ".join(base).upper()] * r.randint(0, 3)
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("held, streamed", [(256, 512), (3, 4)])
def test_against_brute_force(spark, monkeypatch, held, streamed):
    monkeypatch.setattr(hj, "HELD", held)
    monkeypatch.setattr(hj, "STREAMED", streamed)
    assert found(spark, corpus()) == brute(corpus())


def test_copies_of_a_text_that_is_no_hub(spark):
    """All are linked with one text and hardly any with another: the component is whole whoever is the hub."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = [(500, " ".join(base))]
    for i in range(60):
        words = list(base)
        for at in r.sample(range(5, 145), 2):
            words[at] = f"x{i}-{at}"
        texts.append((i, " ".join(words)))
    got = found(spark, texts)
    assert got == brute(texts)
    assert len({c for _, _, c, _ in got}) == 1


def test_shared_boilerplate_links_nothing(spark):
    shared = " ".join(f"legal{i}" for i in range(200))
    r = random.Random(3)
    texts = [(i, shared + " " + " ".join(f"own{r.randint(0, 10**9)}" for _ in range(90))) for i in range(300)]
    assert all(kept for *_, kept in found(spark, texts))


def test_nulls_ties_repeats_and_long_texts(spark):
    """Rows without an id are linked and lend none; rows that share one id are one document."""
    long, other = " ".join(f"l{i}" for i in range(60_000)), " ".join(f"o{i}" for i in range(40))
    texts = [(5, other), (5, other), (None, other + " more"), (3, other.upper()), (9, None), (None, None), (None, "alone here"), (None, "alone here"),
             (20, long), (21, "changed " + long), (30, other + " z"), (30, long + " z"), (40, "k " * 500)]
    assert found(spark, texts) == brute(texts)


def test_empty_table(spark):
    df = hj.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert df.count() == 0 and df.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_pairs_within_the_distance_share_a_listing():
    """The pigeonhole guarantee, with all errors as unevenly spread as they like, and the first listing in common."""
    most, rng = hj.distance(), np.random.default_rng(1)
    symbols = rng.integers(0, 1 << hj.BITS, (200, hj.SYMBOLS)).astype(np.uint16)
    changed = symbols.copy()
    for i, row in enumerate(changed):
        at = rng.choice(hj.SYMBOLS, most, replace=False) if i % 2 else (rng.integers(0, hj.SYMBOLS) + np.arange(most)) % hj.SYMBOLS
        row[at] ^= np.uint16(1)
    shared = hj.listings(symbols, most) == hj.listings(changed, most)
    assert shared.any(axis=1).all()
    assert (hj.first_listing(symbols != changed, most) == shared.argmax(axis=1)).all()
    apart = symbols ^ np.uint16(1)
    assert not (hj.listings(symbols, most) == hj.listings(apart, most)).any()


def test_distance_reaches_the_recall():
    """Signatures of sets at the threshold differ as the model says."""
    rng, n = np.random.default_rng(4), 400
    sets = []
    for _ in range(n):
        values = rng.integers(0, 1 << 63, 200, dtype=np.int64).astype(np.uint64)
        sets += [np.sort(values[:185]), np.sort(values[15:])]  # 170 of 200
    grams, starts = np.concatenate(sets), np.arange(0, 2 * n * 185, 185)
    signed = hj.signature(grams, starts)
    differing = (signed[::2] != signed[1::2]).sum(axis=1)
    assert abs(differing.mean() - 0.15 * hj.SYMBOLS) < 0.6 and (differing <= hj.distance()).mean() > 0.995
