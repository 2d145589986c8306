"""Quality classification by importance resampling.

Hashed words and word pairs are counted in a target (documents labelled good) and in the raw corpus (all
documents). A document's log weight is the sum of its features' log ratios between the two models. As many
documents as reach a cut, which held-out labelled documents fix, are sampled without replacement by Gumbel
top-k on the log weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import U64, arrow_map, blocks, mix, words
from comptoir.session import cut_lineage

FEATURES = 1 << 14
LABELLED = 20_000
"""Most labelled documents used: they are chosen by a hash of the id, and sent to every task."""
SEED = 17
PRIOR = 8
"""Counts per feature, on average, by which the target model is drawn towards the raw one."""
CARE = 4
"""Bad documents kept that are as bad as a good one lost, where the cut is chosen."""
_PAIR = U64(0x9E3779B97F4A7C15)
_DIGITS = 16


@dataclass
class Model:
    weights: np.ndarray
    cut: float
    """Log weight from which a document counts as good."""
    lowest_key: int | None = None
    """The key of the last document sampled; None if nothing is."""


def _features(raw: np.ndarray, at: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature number and row of each word and each pair of neighbouring words in a row."""
    hashes, where = words(raw, at)
    owner = np.repeat(np.arange(len(where) - 1), np.diff(where))
    pairs = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, np.int64)
    both = mix(hashes[pairs] * _PAIR + hashes[pairs + 1])
    numbers = np.concatenate([hashes, both]) % U64(features)
    return numbers.astype(np.int64), np.concatenate([owner, owner[pairs]])


def _source(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _counts(source: DataFrame, features: int) -> DataFrame:
    """``feature``, ``raw`` and ``target``: how often it occurs in all documents, and in those marked ``fit``."""
    def run(batches):
        total = np.zeros((2, features), np.int64)
        for batch in batches:
            fit = np.array(batch.column(2).to_pylist(), bool)
            row = 0
            for part, raw, at in blocks(batch.select(["doc", "text"]), "text"):
                numbers, owner = _features(raw, at, features)
                total[0] += np.bincount(numbers, minlength=features)
                total[1] += np.bincount(numbers[fit[row + owner]], minlength=features)
                row += part.num_rows
        seen = np.flatnonzero(total[0])
        if len(seen):
            yield pa.record_batch([pa.array(seen), pa.array(total[0, seen]), pa.array(total[1, seen])], ["feature", "raw", "target"])

    counted = source.transform(arrow_map, run, "feature long, raw long, target long")
    return counted.groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def _noise(docs: np.ndarray) -> np.ndarray:
    """Gumbel noise that depends on the id alone."""
    u = (mix(mix(docs.astype(np.int64).view(U64)) + U64(SEED)) >> U64(11)).astype(np.float64)
    return -np.log(-np.log((u + 0.5) / 2.0**53))


def _ordered(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the floating ones."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _scored(batch: pa.RecordBatch, weights: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part, raw, at in blocks(batch, "text"):
        numbers, owner = _features(raw, at, len(weights))
        log_weight = np.bincount(owner, weights[numbers], part.num_rows).astype(np.float64)  # whole if there are no words
        docs = np.asarray(part.column(part.schema.get_field_index("doc")).fill_null(0))
        yield part, log_weight, _ordered(log_weight + _noise(docs))


def score(source: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc``, ``log_weight`` and ``key`` (log weight and noise, as an ordered whole number)."""
    sent = source.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            for part, log_weight, key in _scored(batch, sent.value):
                yield pa.record_batch([part.column(0), pa.array(log_weight), pa.array(key)], ["doc", "log_weight", "key"])

    return source.transform(arrow_map, run, "doc long, log_weight double, key long")


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest ``key``, digit by digit: each pass counts one digit of the keys that agree so far."""
    if k <= 0:
        return None
    prefix, shift = 0, 64
    while shift:
        above = shift
        shift -= _DIGITS
        here = keys if above == 64 else keys.filter(F.shiftright("key", above) == prefix)
        counts = sorted(((r["d"], r["n"]) for r in here.groupBy(F.shiftright("key", shift).alias("d")).agg(F.count("*").alias("n")).collect()), reverse=True)
        for digit, n in counts:
            if k <= n:
                prefix = digit
                break
            k -= n
        else:
            return counts[-1][0] << shift if counts else None
    return prefix


def _best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The log weight that splits held-out good from bad best; the middle of a gap."""
    if not len(good):
        return 0.0
    if not len(bad):
        return float(good.min())
    values = np.unique(np.concatenate([good, bad]))
    right = np.searchsorted(np.sort(bad), values, "left") / len(bad) - CARE * np.searchsorted(np.sort(good), values, "left") / len(good)
    i = int(np.argmax(right))
    return float(values[i] if i == 0 else (values[i] + values[i - 1]) / 2)


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality",
    features: int = FEATURES, labelled: int = LABELLED,
) -> tuple[Model, DataFrame]:
    """The model, and the scores of all documents (a written table: doc, log_weight, key).

    Counts cover all documents. Of the labels at most ``labelled`` are used, one per id (the smallest, if ids
    repeat; null ids and labels are left out); two in three fit the target, the third fixes the cut, each id by
    its smallest score. Without
    good labels every weight is zero and everything is kept. The driver holds ``features`` counts, the scores
    of the held-out third, and a digit's counts; nothing that grows with the corpus.
    """
    marked = (
        labels.filter(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(F.col(key).cast("long").alias("doc")).agg(F.min(quality).alias("good"))
        .withColumn("order", F.xxhash64("doc")).orderBy("order").limit(labelled)
        .select("doc", (F.col("good") > 0).alias("good"), (F.pmod("order", F.lit(3)) > 0).alias("fits"))
    )
    marked = cut_lineage(marked)
    source = _source(df, key, text)
    known = source.join(F.broadcast(marked), "doc", "left")  # ``labelled`` rows at most
    counted = _counts(known.select("doc", "text", F.coalesce(F.col("good") & F.col("fits"), F.lit(False)).alias("fit")), features).collect()
    raw, target = np.zeros(features), np.zeros(features)
    for row in counted:
        raw[row["feature"]], target[row["feature"]] = row["raw"], row["target"]
    weights = np.zeros(features)
    if target.sum():
        share = (raw + 1) / (raw + 1).sum()
        weights = np.log((target + PRIOR * features * share) / (target.sum() + PRIOR * features)) - np.log(share)
    scores = cut_lineage(score(source, weights))
    held = scores.join(F.broadcast(marked.filter("NOT fits")), "doc").groupBy("doc").agg(F.min("good").alias("good"), F.min("log_weight").alias("log_weight")).collect()
    cut = _best_cut(*[np.array([r["log_weight"] for r in held if r["good"] == kind]) for kind in (True, False)]) if target.sum() else 0.0
    k = scores.filter(F.col("log_weight") >= cut).count()
    return Model(weights, cut, kth_largest(scores, k)), scores


def resample(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``key``, ``log_weight`` and ``kept`` of every row.

    ``kept`` marks the sampled documents; rows that tie with the last one sampled are sampled too, so repeated
    rows share one fate. Null and empty texts have log weight 0; null ids share one draw of noise. An empty
    table gives no rows. Only the two named columns are read.
    """
    model, scores = fit(df, labels, key, text, **how)
    kept = F.lit(False) if model.lowest_key is None else F.col("key") >= model.lowest_key
    return scores.select(F.col("doc").alias(key), "log_weight", kept.alias("kept"))


def keep_sampled(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``df`` that ``resample`` keeps, with all their columns, scored again on the way past."""
    model, _ = fit(df, labels, key, text, **how)
    if model.lowest_key is None:
        return df.limit(0)
    sent = df.sparkSession.sparkContext.broadcast(model.weights)
    lowest = model.lowest_key

    def run(batches):
        for batch in batches:
            both = pa.record_batch([batch.column(batch.schema.get_field_index(key)).cast(pa.int64()), batch.column(batch.schema.get_field_index(text)).fill_null("")], ["doc", "text"])
            row = 0
            for part, _, keys in _scored(both, sent.value):
                yield batch.slice(row, part.num_rows).filter(pa.array(keys >= lowest))
                row += part.num_rows

    return df.transform(arrow_map, run, df.schema)
