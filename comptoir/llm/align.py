"""Alignment of two tokenizers over a corpus: a byte-level one (A) and one of pieces (B).

Tokens of both sides are laid over the bytes of a document. With pandas ``merge_asof``, per batch and keyed by document,
each token start finds the token of the other side that covers it; both directions together give all overlapping
pairs, the links, and byte offsets where tokens of both sides end cut the tokens into groups.

How often two ids are linked in the corpus comes from one aggregation of what every block of text counted. It goes back
to the blocks by a join on the pairs of ids that a block holds, not on its links, and from there to the documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import arrow_map, blocks, held
from comptoir.llm.vocab import ByteSide, Side, ranges, word_starts
from comptoir.operators.skew import splittable_join
from comptoir.session import cut_lineage

LOT = 3_000_000
"""Bytes of text that are aligned at a time; a longer text is a lot of its own."""
LOTS = 6
"""Lots of a task that look up the pairs of ids they hold together."""
_OFFSET_BITS = 40  # of a byte in its document, below the document's number
_SPACE = "▁"

_DOCS = "doc long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ROWS = f"block long, pairs array<bigint>, times array<bigint>, sizes array<int>, links array<int>, {_DOCS}, words array<int>"
_SCHEMA = pa.schema([
    ("block", pa.int64()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("links", pa.list_(pa.int32())),
    ("doc", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("words", pa.list_(pa.int32())),
])


class PieceSide(Side):
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        super().__init__([
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ])
        # a piece with a space behind other characters would join words
        self.separates = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)

    def runs(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode([t.removeprefix(" ") for t in texts], num_threads=1)  # which puts the space before again


def _sides(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide]:
    kept = held.setdefault("align", {})
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = ByteSide(path_a, specials_as_text=True), PieceSide(path_b)
    return kept[path_a, path_b]


def _tokens(side: Side, ids: np.ndarray, at: np.ndarray, codes: np.ndarray, doc_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the words ``codes``, their starts and ends in bytes below the number of the document."""
    size = np.diff(at)[codes]
    own = ids[ranges(at[:-1][codes], size)]
    doc = np.repeat(doc_of, size)
    ends = np.cumsum(side.length[own])
    starts = ends - side.length[own]
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    base = np.repeat(starts[first], np.diff(np.append(first, len(doc))))
    shift = (doc.astype(np.int64) << _OFFSET_BITS) - base
    return own, starts + shift, ends + shift


def _written(side: Side, ends: str) -> np.ndarray:
    """Each id as it is written inside its group, and at the end of its side of a group."""
    if not hasattr(side, "written"):
        side.written = np.array([[f"{i},", f"{i}{ends}"] for i in range(len(side.bytes))], object)
    return side.written


def overlaps(starts_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of A and B that overlap, and where: every start, from either side, finds the token that covers it."""
    a = pd.DataFrame({"at": starts_a, "a": np.arange(len(starts_a), dtype=np.int32)})
    b = pd.DataFrame({"at": starts_b, "b": np.arange(len(starts_b), dtype=np.int32)})
    from_a = pd.merge_asof(a, b, on="at")
    from_b = pd.merge_asof(b, a, on="at")
    both = pd.concat([from_a, from_b[starts_a[from_b["a"].to_numpy()] != starts_b]])  # equal starts found each other
    both = both.sort_values("at", kind="stable")
    return both["a"].to_numpy(), both["b"].to_numpy(), both["at"].to_numpy()


def align(side_a: Side, side_b: Side, raw: np.ndarray, at: np.ndarray, apart: bool) -> tuple[dict, dict]:
    """One lot of documents: what is said of each, and what of its words and pairs of ids."""
    rows = len(at) - 1
    starts = word_starts(raw, at) if apart else at[:-1][np.diff(at) > 0]
    edges = np.append(starts, len(raw)).astype(np.int64)
    text = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(raw.tobytes())])
    coded = text.dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    ids_a, at_a, even_a = side_a.encode(words)
    ids_b, at_b, even_b = side_b.encode(words)
    doc_of = np.searchsorted(at, starts, "right") - 1
    uneven = np.zeros(rows, bool)
    uneven[doc_of[~(even_a & even_b)[codes]]] = True
    use = ~uneven[doc_of]
    codes, doc_of, starts = codes[use].astype(np.int32), doc_of[use], starts[use]
    a, from_a, to_a = _tokens(side_a, ids_a, at_a, codes, doc_of)
    b, from_b, to_b = _tokens(side_b, ids_b, at_b, codes, doc_of)
    i, j, where = overlaps(from_a, from_b)
    pair, distinct = pd.factorize((a[i].astype(np.int64) << 32) | b[j])
    # the links of a word are those of the place where it stands first
    first = np.full(len(words), -1, np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    shown = np.flatnonzero(first >= 0)
    first = first[shown]
    place = (doc_of.astype(np.int64) << _OFFSET_BITS) + starts - at[doc_of]
    begin = np.searchsorted(where, place)
    many = np.diff(np.append(begin, len(where)))
    sizes = np.zeros(len(words), np.int32)
    sizes[shown] = many[first]
    of_words = pair[ranges(begin[first], many[first])]
    # groups
    ends = np.intersect1d(to_a, to_b, assume_unique=True)
    group_a, group_b = np.searchsorted(ends, to_a), np.searchsorted(ends, to_b)
    last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    written = np.concatenate([_written(side_a, "|")[a, last_a[: len(a)].astype(np.int8)], _written(side_b, ";")[b, last_b[: len(b)].astype(np.int8)]])[order].tolist()
    count = lambda x: np.bincount((x >> _OFFSET_BITS).astype(np.int64), minlength=rows)
    n_a, n_b = count(from_a), count(from_b)
    cuts = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    told = [hashlib.sha256("".join(written[x:y])[:-1].encode()).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])]
    docs = {
        "n_a": n_a, "n_b": n_b, "n_groups": np.bincount((from_a[np.append(True, last_a[:-1])[: len(a)]] >> _OFFSET_BITS).astype(np.int64), minlength=rows),
        "n_links": count(where), "groups_sha256": told, "words": codes, "n_words": np.bincount(doc_of, minlength=rows),
    }
    return docs, {"pairs": distinct, "times": np.bincount(pair, minlength=len(distinct)), "sizes": sizes, "links": of_words}


def _list(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.record_batch([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _block_row(block: int, lots: list[dict]) -> pa.RecordBatch:
    """The pairs of ids of all lots of a block, how often they are linked, and the pairs of each word."""
    every = np.concatenate([lot["pairs"] for lot in lots])
    pairs, places = np.unique(every, return_inverse=True)
    times = np.bincount(places, np.concatenate([lot["times"] for lot in lots]), len(pairs)).astype(np.int64)
    links, base = [], 0
    for lot in lots:
        links.append(places[base + lot["links"]])
        base += len(lot["pairs"])
    whole = lambda x, kind: _list(x, np.array([len(x)]), kind)
    return _rows(
        1, block=pa.array([block], pa.int64()), pairs=whole(pairs, pa.int64()), times=whole(times, pa.int64()),
        sizes=whole(np.concatenate([lot["sizes"] for lot in lots]), pa.int32()), links=whole(np.concatenate(links).astype(np.int32), pa.int32()),
    )


def _aligned(path_a: str, path_b: str):
    def run(batches):
        side_a, side_b = _sides(path_a, path_b)
        block, lots, base = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part, raw, at in blocks(batch, "text", LOT):
                docs, facts = align(side_a, side_b, raw, at, side_b.separates)
                n = part.num_rows
                yield _rows(
                    n, block=pa.array([block] * n, pa.int64()), doc=part.column(0), groups_sha256=pa.array(docs["groups_sha256"], pa.string()),
                    words=_list(docs["words"] + np.int32(base), docs["n_words"], pa.int32()),
                    **{k: pa.array(docs[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")},
                )
                base += len(facts["sizes"])
                lots.append(facts)
                if len(lots) == LOTS:
                    yield _block_row(block, lots)
                    block, lots, base = block + 1, [], 0
        if lots:
            yield _block_row(block, lots)

    return run


class _Sums:
    """Of the words of a block: the sum of their links' counts, and how many links have the highest of their B id."""

    def __init__(self, sizes: np.ndarray, links: np.ndarray):
        self.links, self.ends = links, np.concatenate([[0], np.cumsum(sizes)])
        self.place, self.times, self.top = [], [], []

    def per_word(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(np.concatenate([np.zeros(0, np.int64), *self.place]), kind="stable")
        out = []
        for looked_up in (self.times, self.top):
            value = np.concatenate([np.zeros(0, np.int64), *looked_up])[order]
            out.append(np.diff(np.concatenate([[0], np.cumsum(value[self.links].astype(np.int64))])[self.ends]))
        return tuple(out)


def _summed(batches):
    """Per document ``n_best`` and ``count_sum``. Rows of a block: its words' links, what was looked up, its documents."""
    sums, words = None, None
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        edges = (np.flatnonzero(kinds[1:] != kinds[:-1]) + 1).tolist()
        for x, y in zip([0, *edges], [*edges, len(kinds)]):
            part = batch.slice(x, y - x)
            if kinds[x] == 0:
                for row in range(y - x):
                    get = lambda name: part.column(name).slice(row, 1).flatten().to_numpy()  # noqa: E731, B023
                    sums, words = _Sums(get("sizes"), get("links")), None
            elif kinds[x] == 1:
                for held_in, name in ((sums.place, "place"), (sums.times, "times"), (sums.top, "top")):
                    held_in.append(part.column(name).flatten().to_numpy().astype(np.int64))
            else:
                if words is None:
                    words = sums.per_word()
                lists = part.column("words")
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                codes = lists.flatten().to_numpy()
                count_sum, n_best = (np.diff(np.concatenate([[0], np.cumsum(w[codes])])[ends]) for w in words)
                kept = [part.column(name) for name in ("doc", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.record_batch([*kept, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), part.column("groups_sha256")], list(_RESULT))


_RESULT = {"doc": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_best": "long", "count_sum": "long", "groups_sha256": "string"}


def overlap_counts(df: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: ``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A document is a space and its text; side A are the ids of the byte-level tokenizer at ``path_a``, side B those of
    the piece tokenizer at ``path_b``, without special tokens, whose strings in a text are plain text. A null or empty
    text, and one that the tokens of a side do not spell, has no tokens: zeros, and an empty ``groups_sha256``. Links
    are pairs of an A and a B token whose byte ranges overlap; groups are cut where tokens of both sides end and are
    written as ``a1,a2|b1;a3|b2`` for the digest. The count of a pair of ids is its number of links in all documents;
    ``n_best`` counts the links whose count is the highest of their B id, ties included, ``count_sum`` sums counts.
    Each row is a document of its own, also where keys repeat or are null. A long text is aligned in one piece. Only the
    two named columns are read; ``key`` is a long. An empty table gives no rows.
    """
    spaced = F.when(F.length(text) > 0, F.concat(F.lit(" "), F.col(text))).otherwise("")
    source = df.select(F.col(key).cast("long").alias("doc"), spaced.alias("text"))
    found = cut_lineage(source.transform(arrow_map, _aligned(path_a, path_b), _ROWS, "align"))
    of_blocks = found.filter(F.col("sizes").isNotNull())
    listed = of_blocks.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "p")).select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = listed.groupBy("pair").agg(F.sum("times").alias("times"))
    id_b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    counts = cut_lineage(counts)
    highest = counts.groupBy(id_b.alias("id_b")).agg(F.max("times").alias("highest"))
    judged = splittable_join(counts.withColumn("id_b", id_b), highest, "id_b").select("pair", "times", (F.col("times") == F.col("highest")).cast("long").alias("top"))
    looked_up = splittable_join(listed.drop("times"), judged, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "times", "top")).alias("got"))
    rows = (
        of_blocks.select("block", F.lit(0).alias("kind"), "sizes", "links")
        .unionByName(looked_up.select("block", F.lit(1).alias("kind"), F.col("got.place").alias("place"), F.col("got.times").alias("times"), F.col("got.top").alias("top")), allowMissingColumns=True)
        .unionByName(found.filter(F.col("sizes").isNull()).select("block", F.lit(2).alias("kind"), *_DOCS.replace(" long", "").replace(" string", "").split(", "), "words"), allowMissingColumns=True)
    )
    together = rows.repartition("block").sortWithinPartitions("block", "kind")
    return together.transform(arrow_map, _summed, ", ".join(f"{c} {t}" for c, t in _RESULT.items())).withColumnRenamed("doc", key)
