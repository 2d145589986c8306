from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from comptoir.llm import block_knn as bk


def brute(rows, k, every):
    rows = [(i, None if v is None else list(v)) for i, v in rows]
    rows = {i: [float(x) for x in v] for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in rows:
        if q % every == 0:
            found = []
            for c in rows:
                if c != q and len(rows[c]) == len(rows[q]):
                    s = 0.0
                    for a, b in zip(rows[q], rows[c]):
                        s += a * b
                    found.append((-s, c))
            out[q] = [(c, -s) for s, c in sorted(found)[:k]]
    return {q: v for q, v in out.items() if v}


def run(spark, rows, k, every):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in bk.nearest(df, F.col("vec_id") % every == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


@pytest.mark.parametrize("blocks", [(2048, 8192), (7, 11)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(bk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(bk, "VECTOR_BLOCK", blocks[1])
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32)) for i in range(150)]
    same = rng.normal(size=8).astype(np.float32)
    rows += [(i, same) for i in range(150, 230)] + [(i, -same) for i in range(230, 240)] + [(300 + i, same[:3]) for i in range(4)]
    rows += [(400, None), (404, [0.0] * 8), (408, [np.nan] + [1.0] * 7), (412, [np.inf] + [1.0] * 7), (416, [None] + [1.0] * 7), (420, []), (None, same)]
    rows += [(500, same * np.float32(1e30)), (504, same * np.float32(1e-30)), (508, same * np.float32(1e-44))]
    assert run(spark, rows, 6, 4) == brute(rows, 6, 4)


def test_all_vectors_of_an_id(spark):
    """Rows of one id with different vectors are all candidates and all queries; equal rows count once."""
    rows = [(0, [1, 0]), (1, [0.5, 0]), (1, [9, 0]), (2, [3, 0]), (2, [3, 0]), (4, [1, 1]), (4, [0, -5]), (5, [0, 2])]
    assert run(spark, rows, 3, 4) == {0: [(1, 9.0), (2, 3.0), (4, 1.0)], 4: [(1, 9.0), (2, 3.0), (5, 2.0)]}
    many = [(7, [float(i % 5), float(i)]) for i in range(200)] + [(8, [1.0, 1.0])]
    assert run(spark, many, 4, 8) == {8: [(7, 203.0), (7, 201.0), (7, 199.0), (7, 198.0)]}


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 16)) * 10.0 ** rng.integers(-5, 5, (200, 1))
    q, scale, error, norm = bk.quantised(x)
    about = (q.astype(float) @ q.T.astype(float)) * scale[:, None] * scale[None, :]
    off = norm[:, None] * error[None, :] + error[:, None] * (norm + error)[None, :]
    assert (np.abs(about - x @ x.T) <= off * (1 + 1e-9) + 1e-12).all()
    assert np.abs(q).max() <= 127


def test_repeats_few_candidates_and_empty_table(spark):
    rows = [(0, [1, 0]), (0, [1, 0]), (1, [2, 0]), (2, [2, 0])]
    assert run(spark, rows, 20, 4) == {0: [(1, 2.0), (2, 2.0)]}
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert bk.nearest(df, F.col("vec_id") % 20 == 0).count() == 0
