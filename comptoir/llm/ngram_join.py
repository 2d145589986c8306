"""Join of documents whose word n-gram sets have a Jaccard similarity of a threshold or more.

MinHash signatures are cut into bands; documents that share a band hash are candidates. Documents with equal
n-gram sets are one representative from the start. A representative is at home with the smallest one that it
shares a bucket with; homes are cut into blocks. A block is verified on the full sets, all against all, and so
are two blocks, but only those members that share a bucket with one of the other block: no more copies of sets
travel than there are candidates, and no pair becomes a row. Components are those of verified links.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import U64, arrow_map, blocks, mix, shingles, words
from comptoir.llm.components import components
from comptoir.operators.skew import splittable_join
from comptoir.session import cut_lineage

THRESHOLD = 0.8
WORDS = 5
RECALL = 0.9999
MOST_HASHES = 256
BLOCK = 512
"""Representatives of a home whose sets a task holds at a time, twice over."""
_COLUMNS = 2048


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows, so the fewest chance candidates, for which pairs at the threshold share a
    band with probability ``recall`` or more within ``most`` hashes."""
    fits = []
    for rows in range(1, most + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit)) if hit > 1e-9 else most + 1
        if bands * rows <= most:
            fits.append((bands, rows))
    if not fits:
        raise ValueError(f"no bands of {most} hashes reach a recall of {recall} at {threshold}")
    return fits[-1]


def _hash_parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return seeds[:n], seeds[n:] | U64(1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def signatures(df: DataFrame, key: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """``doc``, ``n`` (n-grams), ``h1`` and ``h2`` (hashes of the n-gram set) and ``bands``, one row per row."""
    def run(batches):
        shift, factor = _hash_parameters(bands * rows)
        for batch in batches:
            for part, raw, at in blocks(batch, "text"):
                grams, where = shingles(*words(raw, at), n)
                size = np.diff(where)
                full = np.flatnonzero(size)
                starts = where[full]
                h1, h2 = np.zeros(len(size), U64), np.zeros(len(size), U64)
                band = np.zeros((len(full), bands), U64)
                if len(full):
                    h1[full] = np.add.reduceat(mix(grams ^ U64(0xA5A5A5A5)), starts)
                    h2[full] = np.add.reduceat(mix(grams ^ U64(0x5A5A5A5A5A)), starts)
                    for b in range(bands):
                        acc = np.full(len(full), b + 1, U64)
                        for r in range(b * rows, (b + 1) * rows):
                            acc = mix(acc * U64(0x9E3779B97F4A7C15) + np.minimum.reduceat((grams ^ shift[r]) * factor[r], starts))
                        band[:, b] = acc
                offsets = np.zeros(len(size) + 1, np.int32)
                offsets[1:] = np.cumsum(np.where(size > 0, bands, 0))
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(band.ravel())))
                yield pa.record_batch([
                    part.column(0), pa.array(size.astype(np.int32)), pa.array(_signed(h1)), pa.array(_signed(h2)), lists,
                ], ["doc", "n", "h1", "h2", "bands"])

    source = df.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.transform(arrow_map, run, "doc long, n int, h1 long, h2 long, bands array<bigint>")


def _sets(n: int):
    """The n-gram set of each text as sorted 64-bit hashes; other columns go along."""
    def run(batches):
        for batch in batches:
            for part, raw, at in blocks(batch, "text"):
                grams, where = shingles(*words(raw, at), n)
                sets = [grams[a:b].tobytes() for a, b in zip(where[:-1], where[1:])]
                others = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.record_batch([*others, pa.array(sets, pa.binary())], [*part.schema.names[:-1], "grams"])

    return run


def linked(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which sets of ``a`` are similar to which of ``b`` (or, with None, of ``a``), from exact counts."""
    ratio = Fraction(str(threshold))
    sets = a if b is None else a + b
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    new = np.append(True, grams[1:] != grams[:-1])
    column = np.cumsum(new) - 1
    if b is None:
        shared = np.bincount(column) > 1
    else:
        shared = (np.bincount(column, owner < len(a)) > 0) & (np.bincount(column, owner >= len(a)) > 0)
    renamed = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], renamed[column[use]]  # columns ascend
    left = len(a)
    common = np.zeros((left, len(sets) - (left if b is not None else 0)), np.float64)
    edges = np.searchsorted(column, np.arange(0, int(shared.sum()) + _COLUMNS, _COLUMNS))
    for x, y, base in zip(edges[:-1], edges[1:], range(0, len(edges) * _COLUMNS, _COLUMNS)):
        tile = np.zeros((len(sets), _COLUMNS), np.float32)
        tile[owner[x:y], column[x:y] - base] = 1
        common += tile[:left] @ (tile if b is None else tile[left:]).T
    ends = sizes if b is None else sizes[left:]
    union = sizes[:left, None] + ends[None, :] - common
    return common * ratio.denominator >= union * ratio.numerator


def _verify(threshold: float):
    """Per representative of a block pair: the documents it is linked to there, and the smallest
    representative that links there lead to."""
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def judged(members: list[tuple]) -> pa.RecordBatch:
        members.sort(key=lambda m: (m[0], m[1]))  # own block, representative
        sets = [np.frombuffer(m[3], U64) for m in members]
        reps, copies = np.array([m[1] for m in members]), np.array([m[2] for m in members])
        split = sum(m[0] == members[0][0] for m in members)
        within = members[0][4] == members[0][5]  # a block against itself
        n = len(members)
        near = np.zeros((n, n), bool)
        if within:
            near = linked(sets, None, threshold)
            np.fill_diagonal(near, False)
        elif split < n:
            near[:split, split:] = linked(sets[:split], sets[split:], threshold)
            near |= near.T
        links = near @ copies
        rank = np.argsort(np.argsort(reps, kind="stable"), kind="stable")
        while True:
            best = np.minimum(rank, np.where(near, rank[None, :], n).min(axis=1))
            if (best == rank).all():
                break
            rank = best
        return pa.record_batch([pa.array(reps), pa.array(links.astype(np.int64)), pa.array(np.sort(reps)[rank])], schema=schema)

    def run(batches):
        members, last = [], None
        for batch in batches:
            for lo, hi, own, rep, copies, grams in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if (lo, hi) != last and members:
                    yield judged(members)
                    members = []
                last = (lo, hi)
                members.append((own, rep, copies, grams, lo, hi))
        if members:
            yield judged(members)

    return run


def meetings(banded: DataFrame) -> DataFrame:
    """``rep``, ``own`` (its block) and ``meets`` (the blocks it is verified against, its own first) of every
    representative that shares a ``bucket`` of ``banded`` with another.

    ``meets`` has at most one entry for each ``BLOCK`` members of the homes around, however many buckets tell of them.
    """
    hubs = banded.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).filter("size > 1").select("bucket", "hub")
    tied = cut_lineage(banded.join(hubs.hint("shuffle_merge"), "bucket").select("bucket", "rep", "hub"))
    homes = tied.groupBy("rep").agg(F.min("hub").alias("home"))
    crowded = cut_lineage(homes.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).filter("parts > 1"))
    part = F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1)))
    blocked = cut_lineage(splittable_join(homes, crowded, "home", "left").select("rep", F.concat_ws(":", "home", part).alias("own")))
    located = cut_lineage(tied.select("bucket", "rep").join(blocked.hint("shuffle_merge"), "rep").select("bucket", "rep", "own"))
    seen = located.groupBy("bucket").agg(F.min("own").alias("a"), F.max("own").alias("b")).filter("a <> b").select("bucket")
    # most buckets lie within one block
    parted = cut_lineage(splittable_join(located, seen, "bucket"))
    others = parted.select("bucket", F.col("own").alias("other")).distinct()
    met = parted.join(others, "bucket").filter("own <> other").groupBy("rep").agg(F.array_sort(F.collect_set("other")).alias("others"))
    meets = F.concat(F.array("own"), F.coalesce("others", F.array().cast("array<string>")))
    return blocked.join(met.hint("shuffle_merge"), "rep", "left").select("rep", "own", meets.alias("meets"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, n: int = WORDS, recall: float = RECALL,
) -> DataFrame:
    """One row per row: ``key``, ``class_id``, ``n_links`` and ``rep_id``.

    ``n_links`` counts the other rows with a Jaccard similarity of ``threshold`` or more over sets of ``n``
    words in a row; ``class_id`` is the smallest key that links lead to, ``rep_id`` the smallest with the same
    set. Words are what blanks and the controls 9 to 13 separate. A text of fewer words, one at least, has all
    of them as its one n-gram; a null or empty text has none and is linked to nothing. Repeated rows are copies
    of each other; rows with one key and different texts count as one document with both. Rows without a
    key take no part (no class, no links). An empty table gives no rows. Only the two named columns are read.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = cut_lineage(signatures(df, key, text, n, bands, rows))
    some = signed.filter("doc IS NOT NULL AND n > 0")
    sets = some.groupBy("h1", "h2", "n").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"))
    sets = cut_lineage(sets)
    reps = sets.select("rep", "h1", "h2", "n").join(some.hint("shuffle_merge"), [F.col("rep") == some["doc"], sets["h1"] == some["h1"], sets["h2"] == some["h2"]])
    # a key with several texts has the bands of each
    banded = cut_lineage(reps.select("rep", sets["h1"], sets["h2"], "bands").dropDuplicates(["rep", "h1", "h2"]).select("rep", F.explode("bands").alias("bucket")))
    copies = sets.groupBy("rep").agg(F.sum("copies").alias("copies"))
    members = meetings(banded).join(copies.hint("shuffle_merge"), "rep")
    texts = df.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    owned = texts.join(members.hint("shuffle_merge"), texts["doc"] == members["rep"]).select("rep", "copies", "own", "meets", "text")
    held = owned.transform(arrow_map, _sets(n), "rep long, copies long, own string, meets array<string>, grams binary").distinct()
    met = held.select(F.explode("meets").alias("other"), "own", "rep", "copies", "grams").select(
        F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep", "copies", "grams",
    )
    judged = met.repartition("lo", "hi").sortWithinPartitions("lo", "hi").transform(arrow_map, _verify(threshold), "rep long, links long, root long")
    judged = cut_lineage(judged)
    classes = components(judged.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = judged.groupBy("rep").agg(F.sum("links").alias("links")).filter("links > 0")
    of_set = (
        sets.join(copies.withColumnRenamed("copies", "own").hint("shuffle_merge"), "rep").join(links.hint("shuffle_merge"), "rep", "left")
        .join(classes.withColumnRenamed("node", "rep").hint("shuffle_merge"), "rep", "left")
        .select("h1", "h2", "n", "rep", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("own") - 1).alias("n_links"))
    )
    whole = signed.select("doc", "n", "h1", "h2").join(of_set.hint("shuffle_merge"), ["h1", "h2", "n"], "left")
    takes_part = F.col("doc").isNotNull()
    return whole.select(
        F.col("doc").alias(key), F.when(takes_part, F.coalesce("class_id", "doc")).alias("class_id"),
        F.when(takes_part, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(takes_part, F.coalesce("rep", "doc")).alias("rep_id"),
    )
