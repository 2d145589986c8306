"""The pipeline's stages against brute force on the smallest tables."""

from __future__ import annotations

import corpus_pipeline as cp
from comptoir.llm import suffix_dedup as sd
from tests.conftest import SF
from tests.llm.test_ngram_join import brute as near
from tests.llm.test_packing import verify
from tests.llm.test_quality_rules import brute as counts


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 4 <= len(cp.STAGES) <= 5
    by_name, held = dict(cp.STAGES), {"documents": docs}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.cut_lineage(stage(spark, docs, SF))
        assert docs.columns == held["documents"].columns
        held[name] = docs
    texts = {n: {r.doc_id: r.text for r in d.collect()} for n, d in held.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q]
    assert sum(d in texts["quality_classifier"] for d in good) >= 0.9 * len(good)  # fitted on fifty documents here; accuracy is tested on more
    assert len(texts["quality_classifier"]) < len(texts["documents"])
    for d, t in texts["quality_classifier"].items():
        words, _, _, _, _, repeat = counts(t)
        if words < 50 or 100 * repeat > 50 * words:
            assert d not in texts["quality_rules"]
    classes = near(texts["quality_rules"])
    assert set(texts["ngram_jaccard_join"]) == {d for d, (c, _) in classes.items() if c == d}
    want = sd.brute_force([(d, t.encode()) for d, t in texts["ngram_jaccard_join"].items()])
    left = texts["suffix_array_dedup"]
    assert set(left) == set(want)
    for d, (n, removed, _, _) in want.items():
        assert n - removed - 6 * want[d][2] <= len(left[d].encode()) <= n - removed
    verify(by_name["best_fit_packing"](spark, docs, SF).collect(), left)
    verify(cp.run(spark, SF).collect(), left)


def test_repeated_rows_nulls_and_other_columns(spark):
    prose = " ".join(f"the w{i} of x{i}" for i in range(40))
    rows = [(1, prose, "e", "s", 5, "a"), (1, prose, "e", "s", 5, "a"), (None, prose, "e", "s", 5, "b"), (2, None, None, None, None, None), (3, "", "e", "s", 0, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for table in (docs, docs.limit(0)):
        held = table
        for _, stage in cp.STAGES[:-1]:
            held = cp.cut_lineage(stage(spark, held, SF))
            assert held.columns == docs.columns
        packed = {r.doc_id for r in cp.STAGES[-1][1](spark, held, SF).collect()}
        assert packed == {r.doc_id for r in held.collect()} <= {None, 1, 2, 3}
        assert held.filter("doc_id IN (2, 3)").isEmpty()  # too short for the rules


def test_near_duplicates_are_judged_by_row(spark):
    """Unrelated texts of one id, or without one, all stay; of copies one stays, whatever their ids."""
    a, b, c, d = (" ".join(f"{t}{i}" for i in range(60)) for t in "abcd")
    rows = [(1, a), (1, b), (1, b), (1, None), (2, a + " more"), (None, b), (None, c), (None, c + " more"), (None, d), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in cp.one_of_near_duplicates(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (1, b), (1, None), (None, c), (None, d), (None, None)], key=str)
