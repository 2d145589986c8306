"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature has ``SYMBOLS`` symbols of 16 bits, one per MinHash. Two documents differ in a symbol with the probability
of one less their Jaccard similarity, so a similarity becomes a distance: the least one that pairs at the threshold
keep to with the asked recall. Signatures are cut into chunks so that, by the pigeonhole principle, two within the
distance have a chunk with ``ERRORS`` differing symbols at most. Those errors are enumerated: a document is listed
under every chunk with every choice of symbols left out. So all pairs within the distance share a listing.

Listings may be shared by any number of documents, so no pairs are made of them. Sets that are equal are one from the
start. First every set is verified against one hub of each of its listings; whatever is connected by then needs no
further comparison. In listings that still hold sets of several components, those outside the largest one are held
block by block while the others stream past: signatures first, each pair in one of its listings only, then, for those
within the distance, the full sets. A task passes on links that connect something new to it, no more than its rows.
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

THRESHOLD = 0.85
WORDS = 5
RECALL = 0.9999
SYMBOLS = 64
BITS = 16
ERRORS = 1
"""Differing symbols in a chunk that are enumerated."""
HELD = 256
"""Sets of a listing that are held together while others stream past."""
STREAMED = 512
"""Sets that stream past one copy of a hub or of what is held."""


def distance(threshold: float = THRESHOLD, recall: float = RECALL, symbols: int = SYMBOLS, bits: int = BITS) -> int:
    """The least number of differing symbols that pairs at the threshold keep to with probability ``recall``."""
    differ, kept = (1 - threshold) * (1 - 2.0**-bits), 0.0
    for d in range(symbols + 1):
        kept += math.comb(symbols, d) * differ**d * (1 - differ) ** (symbols - d)
        if kept >= recall:
            return d
    return symbols


def chunks(most: int, symbols: int = SYMBOLS, errors: int = ERRORS) -> list[tuple[int, int]]:
    """The fewest chunks of which two signatures with ``most`` differing symbols have one with ``errors`` at most."""
    n = min(symbols, most // (errors + 1) + 1)
    ends = [symbols * i // n for i in range(n + 1)]
    return list(zip(ends, ends[1:]))


def _parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(0xD6E8FEB86659FD93))
    return seeds[:n], seeds[n:] | U64(1)


def signature(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The symbols of the sets that begin at ``starts``, a row each."""
    shift, factor = _parameters(SYMBOLS)
    out = np.zeros((len(starts), SYMBOLS), np.uint16)
    if len(starts):
        for j in range(SYMBOLS):
            out[:, j] = (mix(np.minimum.reduceat((grams ^ shift[j]) * factor[j], starts)) & U64((1 << BITS) - 1)).astype(np.uint16)
    return out


def listings(symbols: np.ndarray, most: int) -> np.ndarray:
    """A hash for every chunk and symbol left out of it; column j is the one without symbol j."""
    place = np.arange(SYMBOLS, dtype=U64)
    terms = mix(symbols.astype(U64) + (place << U64(20)) + U64(1))
    keys = np.empty_like(terms)
    for a, b in chunks(most):
        keys[:, a:b] = terms[:, a:b].sum(axis=1, dtype=U64)[:, None] - terms[:, a:b]
    return mix(keys + mix(place + U64(77)))


def first_listing(differs: np.ndarray, most: int) -> np.ndarray:
    """Of pairs with the given differing symbols, the column of the first listing that they share."""
    first = np.full(len(differs), -1)
    for a, b in chunks(most):
        here = differs[:, a:b].sum(axis=1)
        found = np.where(here == 0, a, np.where(here == 1, a + differs[:, a:b].argmax(axis=1), -1))
        first = np.where(first < 0, found, first)
    return first


def _fingerprints(grams: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each set (zero for an empty one), and which rows are not empty."""
    size = np.diff(where)
    full = np.flatnonzero(size)
    h1, h2 = np.zeros(len(size), U64), np.zeros(len(size), U64)
    if len(full):
        h1[full] = np.add.reduceat(mix(grams ^ U64(0xA5A5A5A5)), where[full])
        h2[full] = np.add.reduceat(mix(grams ^ U64(0x5A5A5A5A5A)), where[full])
    return h1.view(np.int64), h2.view(np.int64), full


def _sign(n: int):
    def run(batches):
        for batch in batches:
            for part, raw, at in blocks(batch, "text"):
                grams, where = shingles(*words(raw, at, fold_case=True), n)
                h1, h2, full = _fingerprints(grams, where)
                symbols = np.zeros((len(where) - 1, SYMBOLS), np.uint16)
                symbols[full] = signature(grams, where[full])
                held = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * SYMBOLS), len(symbols), [None, pa.py_buffer(symbols.tobytes())])
                yield pa.record_batch([
                    part.column(0), part.column(1), pa.array(np.diff(where).astype(np.int64)), pa.array(h1), pa.array(h2), held.cast(pa.binary()),
                ], ["doc", "row_hash", "n", "h1", "h2", "symbols"])

    return run


def _list(most: int):
    def run(batches):
        for batch in batches:
            symbols = _symbols(batch.column(1).to_pylist())
            keys = listings(symbols, most).view(np.int64)
            offsets = pa.array(np.arange(0, keys.size + 1, SYMBOLS, dtype=np.int32))
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], ["sid", "keys"])

    return run


def _symbols(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint16).reshape(len(values), SYMBOLS)


def _grams(n: int):
    """The set of each text as sorted 64-bit hashes, where it is the one that the row asks for."""
    def run(batches):
        for batch in batches:
            for part, raw, at in blocks(batch, "text"):
                grams, where = shingles(*words(raw, at, fold_case=True), n)
                h1, h2, _ = _fingerprints(grams, where)
                asked = (h1 == part.column(1).to_numpy()) & (h2 == part.column(2).to_numpy())
                keep = np.flatnonzero(asked)
                sets = [grams[where[i] : where[i + 1]].tobytes() for i in keep]
                yield pa.record_batch([part.column(0).take(pa.array(keep)), pa.array(sets, pa.binary())], ["sid", "grams"])

    return run


class _Forest:
    """Which members of a task are connected already."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (up := self.above.get(x, x)) != x:
            self.above[x] = x = self.above.get(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.above[a] = b
        return a != b


def _groups(batches, columns: int):
    """Runs of rows that agree in the first two columns, batch by batch: that key, whether it is new, and the others."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = (np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1).tolist()
        for x, y in zip([0, *edges], [*edges, len(a)]):
            key = (int(a[x]), int(b[x]))
            yield key, key != last, [batch.column(i).slice(x, y - x) for i in range(2, columns)]
            last = key


def _verify(threshold: float):
    """Links between held sets and those that stream past. Rows: listing, part, whether it streams, set, root, grams."""
    ratio = Fraction(str(threshold))

    def run(batches):
        for _, new, (streams, sids, roots, grams) in _groups(batches, 6):
            if new:
                held, index, forest = [], None, _Forest()
            found = []
            for stream, sid, root, raw in zip(streams.to_pylist(), sids.to_pylist(), roots.to_pylist(), grams.to_pylist()):
                own = np.frombuffer(raw, U64)
                if not stream:
                    held.append((sid, root, own))
                    continue
                if index is None:
                    sizes = np.array([len(h[2]) for h in held], np.int64)
                    every = np.concatenate([np.zeros(0, U64), *[h[2] for h in held]])
                    order = np.argsort(every, kind="stable")
                    index = every[order], np.repeat(np.arange(len(held)), sizes)[order], sizes
                every, owner, sizes = index
                first, last = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
                many = last - first
                hits = np.repeat(last - np.cumsum(many), many) + np.arange(int(many.sum()))
                common = np.bincount(owner[hits], minlength=len(held))
                near = np.flatnonzero(common * ratio.denominator >= (sizes + len(own) - common) * ratio.numerator)
                for i in near.tolist():
                    other, other_root, _ = held[i]
                    if other != sid and other_root != root and forest.join(root, other_root):
                        found.append((sid, other))
            yield pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in range(2)], ["a", "b"])

    return run


def _within(most: int):
    """Rows of sets within the distance of one of another component on the other side. Rows: listing, part, whether
    it streams, set, root, column of the listing, symbols."""
    names = ["bucket", "part", "streams", "sid", "root"]

    def run(batches):
        for key, new, (streams, sids, roots, slots, raw) in _groups(batches, 7):
            if new:
                held = {"sid": [], "root": [], "symbols": [], "hit": None}  # a part may hold nothing
            streams, sids, roots = streams.to_numpy(zero_copy_only=False), sids.to_numpy(), roots.to_numpy()
            symbols, slot = _symbols(raw.to_pylist()), int(slots[0].as_py())
            out = []
            still = np.flatnonzero(~streams)
            if len(still):
                held["sid"].append(sids[still])
                held["root"].append(roots[still])
                held["symbols"].append(symbols[still])
            moving = np.flatnonzero(streams)
            if len(moving) and len(held["sid"]):
                if held["hit"] is None:  # all that is held has come
                    for k in ("sid", "root", "symbols"):
                        held[k] = np.concatenate(held[k])
                    held["hit"] = np.zeros(len(held["sid"]), bool)
                for lot in np.array_split(moving, max(1, len(moving) // 512)):
                    apart = np.zeros((len(held["sid"]), len(lot)), np.uint8)
                    for j in range(SYMBOLS):
                        apart += held["symbols"][:, j, None] != symbols[None, lot, j]
                    i, k = np.nonzero((apart <= most) & (held["root"][:, None] != roots[None, lot]))
                    if len(i):
                        mine = first_listing(held["symbols"][i] != symbols[lot[k]], most) == slot
                        i, k = i[mine], k[mine]
                        fresh = np.unique(i[~held["hit"][i]])
                        held["hit"][fresh] = True
                        out.append((held["sid"][fresh], held["root"][fresh], False))
                        passing = lot[np.unique(k)]
                        out.append((sids[passing], roots[passing], True))
            for s, r, stream in out:
                n = len(s)
                yield pa.record_batch([
                    pa.array([key[0]] * n, pa.int64()), pa.array([key[1]] * n, pa.int32()), pa.array([stream] * n, pa.bool_()), pa.array(s), pa.array(r),
                ], names)

    return run


def _in_parts(df: DataFrame) -> DataFrame:
    """What is held comes before what streams past."""
    return df.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "streams")


def _links(rows: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """Verified links of rows ``bucket, part, streams, sid, root``, written."""
    with_sets = rows.join(grams.hint("shuffle_merge"), "sid").select("bucket", "part", "streams", "sid", "root", "grams")
    return cut_lineage(_in_parts(with_sets).transform(arrow_map, _verify(threshold), "a long, b long"))


def _from_hubs(members: DataFrame) -> DataFrame:
    """Every set beside the hubs of its listings; the sets of a hub are dealt to as many parts as they fill."""
    pairs = cut_lineage(members.filter("sid <> hub").select("sid", "hub").distinct())
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / STREAMED).cast("int").alias("parts"))
    streams = splittable_join(pairs, parts, "hub").select(
        F.col("hub").alias("bucket"), F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int").alias("part"), F.lit(True).alias("streams"), "sid",
    )
    held = parts.select(F.col("hub").alias("bucket"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("streams"), F.col("hub").alias("sid"))
    return held.unionByName(streams).withColumn("root", F.col("sid"))


def _still_apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the listings that hold sets of several components: those outside the largest one are dealt to parts
    that hold them, and all are dealt to segments that stream past each part."""
    rooted = cut_lineage(
        members.select("bucket", "slot", "sid").join(roots.hint("shuffle_merge"), members["sid"] == roots["node"], "left")
        .select("bucket", "slot", "sid", F.coalesce("root", "sid").alias("root"))
    )
    by_root = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    mixed = by_root.groupBy("bucket").agg(
        F.max_by("root", "n").alias("largest"), F.max("n").alias("most"), F.sum("n").alias("size"), F.count("*").alias("roots"),
    ).filter("roots > 1").select(
        "bucket", "largest", F.ceil((F.col("size") - F.col("most")) / HELD).cast("int").alias("parts"), F.ceil(F.col("size") / STREAMED).cast("int").alias("segments"),
    )
    part, segment = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"), F.pmod(F.xxhash64("sid", F.lit(1)), F.col("segments")).cast("int")
    held = F.when(F.col("root") != F.col("largest"), F.transform(F.sequence(F.lit(0), F.col("segments") - 1), lambda x: F.struct((part * F.col("segments") + x).alias("part"), F.lit(False).alias("streams"))))
    streams = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct((x * F.col("segments") + segment).alias("part"), F.lit(True).alias("streams")))
    none = F.array().cast("array<struct<part:int,streams:boolean>>")
    return splittable_join(rooted, mixed, "bucket").select("bucket", "sid", "root", "slot", F.inline(F.concat(F.coalesce(held, none), streams)))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, n: int = WORDS, recall: float = RECALL,
) -> DataFrame:
    """One row per row: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    A document's set holds its distinct runs of ``n`` words, after A to Z are brought to lower case; words are what
    blanks and the controls 9 to 13 separate. A text of fewer words, one at least, has all of them as its one shingle;
    a null or empty text, or one without words, has none and is linked to nothing. Documents with a Jaccard similarity
    of ``threshold`` or more are linked, and links are confirmed on whole sets, however long the text.
    ``component_id`` is the smallest key that links lead to. Repeated rows are copies of each other; rows with one key
    and different texts are one document with all of them. A row without a key is linked like any other, but lends
    no key: its component may be null. ``kept`` is true where key and component are the same, also if both are null.
    An empty table gives no rows. Only the two named columns are read.
    """
    most = distance(threshold, recall)
    texts = df.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).select("doc", F.xxhash64("doc", "text").alias("row_hash"), "text")
    signed = cut_lineage(texts.transform(arrow_map, _sign(n), "doc long, row_hash long, n long, h1 long, h2 long, symbols binary"))
    some = signed.filter("n > 0")
    sets = some.groupBy("h1", "h2", "n").agg(F.min("doc").alias("doc"), F.min("row_hash").alias("row_hash"), F.first("symbols").alias("symbols"))
    sets = cut_lineage(sets.withColumn("sid", F.monotonically_increasing_id()))
    listed = sets.select("sid", "symbols").transform(arrow_map, _list(most), "sid long, keys array<bigint>").select("sid", F.posexplode("keys").alias("slot", "bucket"))
    hubs = listed.groupBy("bucket").agg(F.min("sid").alias("hub"), F.count("*").alias("size")).filter("size > 1").select("bucket", "hub")
    members = cut_lineage(splittable_join(listed, hubs, "bucket").select("bucket", "slot", "sid", "hub"))
    asked = sets.join(members.select("sid").distinct().hint("shuffle_merge"), "sid", "left_semi").select("sid", "row_hash", "h1", "h2")
    found = splittable_join(texts.select("row_hash", "text"), asked, "row_hash").select("sid", "h1", "h2", "text")
    grams = cut_lineage(found.transform(arrow_map, _grams(n), "sid long, grams binary").dropDuplicates(["sid"]))
    # rows that share a key are one document
    of_key = some.filter("doc IS NOT NULL").select("doc", "h1", "h2", "n").join(sets.select("h1", "h2", "n", "sid").hint("shuffle_merge"), ["h1", "h2", "n"]).select("doc", "sid")
    several = of_key.groupBy("doc").agg(F.min("sid").alias("b"), F.max("sid").alias("last")).filter("b <> last").select("doc", "b")
    links = cut_lineage(splittable_join(of_key, several, "doc").select(F.col("sid").alias("a"), "b").distinct())
    links = links.unionByName(_links(_from_hubs(members), grams, threshold))
    roots = cut_lineage(components(links))
    apart = _still_apart(members, roots).join(sets.select("sid", "symbols").hint("shuffle_merge"), "sid")
    near = _in_parts(apart.select("bucket", "part", "streams", "sid", "root", "slot", "symbols")).transform(
        arrow_map, _within(most), "bucket long, part int, streams boolean, sid long, root long",
    )
    more = _links(near, grams, threshold)
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    rooted = sets.select("h1", "h2", "n", "sid", "doc").join(roots.hint("shuffle_merge"), sets["sid"] == roots["node"], "left").select(
        "h1", "h2", "n", "doc", F.coalesce("root", "sid").alias("root"),
    )
    least = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_set = splittable_join(rooted, least, "root").select("h1", "h2", "n", "component_id")
    judged = splittable_join(signed.select("doc", "n", "h1", "h2"), of_set, ["h1", "h2", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id"))
    return judged.select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc").eqNullSafe(component).alias("kept"),
    )
