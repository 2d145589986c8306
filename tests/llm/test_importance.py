from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from comptoir.llm import importance as im
from comptoir.llm import queries
from comptoir.llm.arrays import utf8


def table(spark, n=400, seed=4):
    r = random.Random(seed)
    good, bad = [f"g{i}" for i in range(80)], [f"b{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        q = int(r.random() > 0.25)
        rows.append((i, " ".join(r.choice(good if q else bad) for _ in range(r.randint(5, 60)))))
        if r.random() < 0.6:
            labels.append((i, q, 0))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_keeps_good_and_rejects_bad(spark):
    rows, labels = table(spark)
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, kept string")
    got = {r.doc_id: r.kept for r in im.resample(df, labels, features=512).collect()}
    truth = {i: t.startswith("g") for i, t in rows}
    assert sum(got[i] == truth[i] for i in got) >= 0.99 * len(got)
    kept = im.keep_sampled(df, labels, features=512)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in got if got[i])


@pytest.mark.parametrize("k", [0, 1, 3, 5, 9])
def test_kth_largest(spark, k):
    values = [5, -3, 2**62, -(2**62), 0, 5, 5, 2**40, -1]
    df = spark.createDataFrame([(v,) for v in values], "key long")
    want = sorted(values, reverse=True)
    assert im.kth_largest(df, k) == (None if k == 0 else want[k - 1])


def numbers_of(text, features):
    return im._features(*utf8(pa.array([text or ""])), features)[0].tolist()


def gumbel(doc):
    """The noise of an id, in whole numbers of 64 bits."""
    top = 2**64 - 1

    def scramble(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & top
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & top
        return x ^ x >> 31

    u = scramble((scramble(doc & top) + im.SEED) & top) >> 11
    return -math.log(-math.log((u + 0.5) / 2.0**53))


def brute(spark, rows, labels, features):
    """Log weights, cut and sampled ids, from counters and sorted lists."""
    order = {r.id: r.h for r in spark.range(len(rows)).selectExpr("id", "xxhash64(id) AS h").collect()}
    good = {r.doc_id: r.quality > 0 for r in labels.collect()}
    fits = {d for d in good if order[d] % 3}
    found = {d: numbers_of(t, features) for d, t in rows}
    raw, target = Counter(), Counter()
    for d, numbers in found.items():
        raw.update(numbers)
        if d in fits and good[d]:
            target.update(numbers)
    shares = {f: (raw[f] + 1) / (sum(raw.values()) + features) for f in range(features)}
    total = sum(target.values()) + im.PRIOR * features
    weight = {f: math.log((target[f] + im.PRIOR * features * shares[f]) / total) - math.log(shares[f]) for f in shares}
    score = {d: sum(weight[f] for f in numbers) for d, numbers in found.items()}
    held = {kind: sorted(score[d] for d in good if d not in fits and good[d] == kind) for kind in (True, False)}
    values = sorted(held[True] + held[False])
    right = [sum(b < v for b in held[False]) / len(held[False]) - im.CARE * sum(g < v for g in held[True]) / len(held[True]) for v in values]
    i = max(range(len(values)), key=lambda j: (right[j], -j))
    cut = values[i] if i == 0 else (values[i] + values[i - 1]) / 2
    by_key = sorted(score, key=lambda d: score[d] + gumbel(d), reverse=True)
    return score, cut, set(by_key[: sum(s >= cut for s in score.values())])


@pytest.mark.parametrize("seed", [4, 9])
def test_against_brute_force(spark, seed):
    """Weights, cut, noise and top-k; without the noise other documents would be sampled."""
    r = random.Random(seed)
    rows = []
    for i in range(200):  # good and bad share most words, so that scores lie close together
        own = [f"{'g' if i % 3 else 'b'}{r.randint(0, 40)}" for _ in range(r.randint(0, 4))]
        rows.append((i, " ".join(own + [f"w{r.randint(0, 60)}" for _ in range(r.randint(1, 12))])))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 200, 2)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, cut, sampled = brute(spark, rows, labels, 256)
    model, scores = im.fit(df, labels, features=256)
    assert {x.doc: x.log_weight for x in scores.collect()} == pytest.approx(want)
    assert model.cut == pytest.approx(cut)
    kept = {x.doc_id for x in im.resample(df, labels, features=256).collect() if x.kept}
    assert kept == sampled != {d for d, s in want.items() if s >= cut}


def test_features():
    """One number for each word and each pair of neighbours, the same for the same words."""
    a, b = numbers_of("x y\tz x", 1 << 14), numbers_of("x  y", 1 << 14)
    assert len(a) == 7 and len(b) == 3
    assert a[0] == a[3] == b[0] and a[1] == b[1] and a[4] == b[2]
    assert numbers_of(None, 64) == [] and len(numbers_of("one", 64)) == 1


def test_very_long_text(spark):
    """A text of several reader blocks is counted and scored whole."""
    rows, labels = table(spark, 60)
    tail = [(60, " ".join(["g1"] * 700_000 + ["b1"] * 3))]
    df = spark.createDataFrame(rows + tail, "doc_id long, text string")
    model, scores = im.fit(df, labels, features=512)
    numbers = np.array(numbers_of(tail[0][1], 512))
    assert len(numbers) == 2 * 700_003 - 1
    assert scores.filter("doc = 60").first().log_weight == pytest.approx(model.weights[numbers].sum())


def test_ordered_keys():
    x = np.array([-np.inf, -5.5, -0.0, 0.0, 1e-300, 3.25, np.inf])
    y = im._ordered(x)
    assert (np.diff(y) >= 0).all() and y[2] == y[3]


def test_nulls_repeats_and_empty_tables(spark):
    rows, labels = table(spark, 60)
    odd = [(None, None), (None, ""), (70, None), (0, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string")
    got = im.resample(df, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows + odd)
    assert all(r.log_weight == 0 for r in got if r.doc_id in (None, 70))
    assert len({r.kept for r in got if r.doc_id == 0}) == 1
    none = spark.createDataFrame([(None, None, None), (1, None, 0)], labels.schema)
    assert all(r.kept for r in im.resample(df, none).collect())
    assert im.resample(df.limit(0), labels).count() == 0
    assert im.keep_sampled(df.limit(0), labels).count() == 0


def test_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf, "labels").collect()}
    kept = {r.doc_id: r.kept for r in queries.op3_importance_resampling(spark, sf).collect()}
    right = Counter((q, kept[d]) for d, q in labels.items())
    assert right[1, True] >= 0.99 * (right[1, True] + right[1, False])
    assert right[0, False] >= 0.85 * (right[0, True] + right[0, False])


def test_copies_of_a_labelled_document_count_once_for_the_cut(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(im, "_best_cut", lambda good, bad: sizes.append(len(good) + len(bad)) or 0.0)
    docs = spark.createDataFrame([(i, f"w{i % 7} of x{i}") for i in range(40) for _ in range(9 if i < 20 else 1)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    im.fit(docs, labels)
    held_out = spark.range(40).filter("pmod(xxhash64(id), 3) = 0").count()
    assert sizes == [held_out] and held_out > 0
