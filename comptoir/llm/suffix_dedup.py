"""Removal of repeated passages by suffix arrays over shards that content decides.

Every window of ``length`` bytes names an anchor: of the ``GRAM`` byte strings inside it, the leftmost with
the smallest hash. Equal windows name equal anchors, so each anchor's windows can be judged in one shard, on
their own. Windows in a row with the same anchor form one segment. Only anchors that occur twice or more go
on; a shard's distinct segments are laid end to end, their suffixes sorted by induced sorting, and permuted
common prefixes tell which windows are equal. The earliest of each is kept, all others are covered bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import U64, arrow_map, blocks, mix, powers, utf8
from comptoir.llm.suffix_array import closed, heads, permuted_prefixes, suffix_array
from comptoir.session import cut_lineage

LENGTH = 100
GRAM = 32
_STEP = 1 << 20
"""Bytes of a text, or of several, whose windows are looked at together."""
_PLACE = 23
"""Bits for a place within such a block."""
SHARD_BYTES = 2 << 20
"""Bytes of distinct segments that share a suffix array; anchors are never split between two."""
HOT = 1000
"""Occurrences of an anchor from which its windows are dealt by what they hold, not by the anchor alone."""
_BAND = 8
_APART = 0xFD


def segments(raw: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end, each segment's row, first window, number of windows, anchor hash, and how
    far the anchor lies behind the first window's start."""
    n, most = len(raw), length - gram + 1
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, np.int64))
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum((raw.astype(U64) + U64(1)) * up[:n], out=total[1:])
    hashes = mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    low = U64((1 << _PLACE) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=U64)
    reach = 1
    while 2 * reach <= most:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < most:
        least = np.minimum(least[: -(most - reach)], least[most - reach :])
    anchor = (least & low).astype(np.int64)  # one per window start
    rows = np.flatnonzero(np.diff(at) >= length)
    turn = np.zeros(len(anchor) + 1, np.int8)
    np.add.at(turn, at[rows], 1)
    np.add.at(turn, at[rows + 1] - length + 1, -1)
    inside = np.cumsum(turn[:-1]).astype(bool)
    begins = inside.copy()
    begins[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    begins[at[rows]] = True
    begin = np.flatnonzero(begins)
    row = np.searchsorted(at, begin, "right") - 1
    end = np.minimum(np.append(begin[1:], len(anchor)), at[row + 1] - length + 1)
    return row, begin - at[row], end - begin, hashes[anchor[begin]], anchor[begin] - begin


def _pieces(batch: pa.RecordBatch, text: str, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(row numbers, bytes, starts, first byte) of blocks; a longer text comes in parts that share windows' ends."""
    done = 0
    for part, raw, at in blocks(batch, text, _STEP):
        rows = np.arange(done, done + part.num_rows)
        done += part.num_rows
        if len(raw) <= 2 * _STEP:
            yield rows, raw, at, 0
            continue
        for r in range(part.num_rows):
            own = raw[at[r] : at[r + 1]]
            for a in range(0, max(1, len(own) - length + 1), _STEP):
                sub = own[a : a + _STEP + length - 1]
                yield rows[r : r + 1], sub, np.array([0, len(sub)]), a


def _anchors(source: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for rows, raw, at, first in _pieces(batch, "text", length):
                row, begin, windows, anchor, lead = segments(raw, at, length, gram)
                if len(row):
                    yield pa.record_batch([
                        pa.array(anchor.view(np.int64)), pa.array(ids[rows[row]]), pa.array(begin + first),
                        pa.array((windows << 16 | lead).astype(np.int32)),
                    ], ["anchor", "doc", "begin", "extent"])

    return source.transform(arrow_map, run, "anchor long, doc long, begin long, extent int")


def _flat(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Of a column of lists of structs: the row of each struct, and its fields."""
    wide = column.cast(pa.list_(column.type.value_type)) if not pa.types.is_list(column.type) else column
    sizes = np.asarray(pc.fill_null(pc.list_value_length(wide), 0))
    structs = wide.flatten()
    return np.repeat(np.arange(len(sizes)), sizes), {f.name: np.asarray(structs.field(i)) for i, f in enumerate(structs.type)}


def _extract(length: int):
    """Segments' bytes by shard, each once per batch, where it begins first."""
    def run(batches):
        for batch in batches:
            raw, at = utf8(batch.column(1))
            row, span = _flat(batch.column(2))
            whole, docs = raw.tobytes(), np.asarray(batch.column(0))
            found: dict[tuple[int, bytes], tuple[int, int]] = {}

            def add(shards, docs, begins, froms, tos):
                for shard, doc, begin, a, b in zip(shards.tolist(), docs.tolist(), begins.tolist(), froms.tolist(), tos.tolist()):
                    key, place = (shard, whole[a:b]), (doc, begin)  # noqa: B023
                    if key not in found or place < found[key]:  # noqa: B023
                        found[key] = place  # noqa: B023

            begin, windows, lead = span["begin"], span["extent"].astype(np.int64) >> 16, span["extent"].astype(np.int64) & 0xFFFF
            plain = ~span["hot"].astype(bool)
            begins = at[row] + begin
            add(span["anchor"][plain], docs[row[plain]], begin[plain], begins[plain], (begins + windows + length - 1)[plain])
            # windows as far from a frequent anchor meet equal ones there: deal them by the bytes all of a band hold
            for band in range(length // _BAND + 1):
                hot = np.flatnonzero(~plain & (lead // _BAND >= band) & (np.maximum(0, lead - windows + 1) // _BAND <= band))
                if not len(hot):
                    continue
                own = (begins + lead)[hot] - band * _BAND
                cores = [xxhash.xxh64_intdigest(whole[x : x - _BAND + 1 + length], band) for x in own.tolist()]
                first = np.maximum(begins[hot], own - _BAND + 1)
                last = np.minimum((begins + windows)[hot] - 1, own)
                add(np.array(cores, U64).view(np.int64), docs[row[hot]], first - at[row[hot]], first, last + length)
            if found:
                yield _segment_batch(found)

    return run


def _segment_batch(found: dict) -> pa.RecordBatch:
    keys, places = list(found), list(found.values())
    return pa.record_batch([
        pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.binary()),
        pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64()),
    ], ["shard", "bytes", "doc", "begin"])


def earliest(found: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, first and after of runs of windows that begin nowhere earlier, of segments (doc, begin, bytes)
    that are distinct, from a suffix array over all of them."""
    found = sorted(found, key=lambda f: f[:2])
    apart = bytes([_APART])
    text = closed(np.frombuffer(apart.join([s for _, _, s in found]) + apart, np.uint8))
    word = heads(text, length + 8)
    order = suffix_array(text, length, word)
    same = permuted_prefixes(word, order, length, length) >= length
    first = np.minimum.reduceat(order, np.flatnonzero(~same[order]))  # documents and places ascend in the text
    sizes = np.array([len(s) for _, _, s in found])
    starts = np.append(0, np.cumsum(sizes + 1))[:-1]
    kept = np.zeros(len(text) + 1, np.int8)
    kept[first] = 1
    inside = np.zeros(len(text) + 1, np.int8)
    inside[starts] = 1
    inside[starts + sizes - length + 1] -= 1
    kept &= np.cumsum(inside, dtype=np.int8)
    turns = np.flatnonzero(np.diff(kept, prepend=0))
    a, b = turns[::2], turns[1::2]
    of = np.searchsorted(starts, a, "right") - 1
    shift = np.array([begin for _, begin, _ in found])[of] - starts[of]
    return np.array([doc for doc, _, _ in found])[of], a + shift, b + shift


def _shards(length: int):
    def judged(found: dict[tuple[int, bytes], tuple[int, int]]) -> pa.RecordBatch:
        kept = earliest([(*place, piece) for (_, piece), place in found.items()], length)
        return pa.record_batch([pa.array(c, pa.int64()) for c in kept], ["doc", "first", "after"])

    def run(batches):
        """Rows come by shard, bytes, doc and begin: a segment's first row holds its earliest place."""
        found, size, last = {}, 0, (None, None)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            shard, piece = np.asarray(batch.column(0)), batch.column(1)
            turns = np.ones(n, bool)
            turns[1:] = shard[1:] != shard[:-1]
            turns[0] = shard[0] != last[0]
            new = turns.copy()
            if n > 1:
                new[1:] |= np.asarray(pc.not_equal(piece.slice(1), piece.slice(0, n - 1)))
            new[0] |= piece[0].as_py() != last[1]
            last = (shard[-1], piece[-1].as_py())
            # bytes of new segments before each row: a shard that starts after 2 MB of them starts a new suffix array
            before = size + np.append(0, np.cumsum(np.where(new, np.asarray(pc.binary_length(piece)), 0)))
            start = 0
            while True:
                opens = np.flatnonzero(turns[start:] & (before[start:-1] >= SHARD_BYTES + before[start] - size)) + start
                cut = int(opens[0]) if len(opens) else n
                rows = np.flatnonzero(new[start:cut]) + start
                for key, place in zip(zip(shard[rows].tolist(), piece.take(rows).to_pylist()), zip(
                        np.asarray(batch.column(2))[rows].tolist(), np.asarray(batch.column(3))[rows].tolist())):
                    found[key] = place
                if cut == n:
                    size += int(before[n] - before[start])
                    break
                if found:
                    yield judged(found)
                found, size, start = {}, 0, cut
        if found:
            yield judged(found)

    return run


def _gone(at: np.ndarray, spans: tuple, kept: tuple, length: int) -> np.ndarray:
    """Which bytes of texts laid end to end are covered by windows in ``spans`` but not in ``kept``."""
    turn = np.zeros(at[-1] + 2, np.int32)
    row, span = spans
    begin = at[row] + span["b"]
    np.add.at(turn, begin, 1)
    np.add.at(turn, begin + span["n"], -1)
    row, keep = kept
    np.add.at(turn, at[row] + keep["first"], -1)
    np.add.at(turn, at[row] + keep["after"], 1)
    repeated = np.cumsum(turn) > 0
    cover = repeated.astype(np.int32)
    cover[length:] -= repeated[:-length]
    return np.cumsum(cover[: at[-1]]) > 0


def _numbered(df: DataFrame, key: str, text: str, carry: Sequence[str]) -> DataFrame:
    """``doc`` (a number that ascends with the key), ``id``, ``text`` and ``row`` (the columns to carry). Keys
    that are null or repeat are numbered anew, in the order of key (null first) and text."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("int")
    source = df.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), row.alias("row"))
    unclear = source.groupBy("id").count().filter("id IS NULL OR count > 1")
    if unclear.isEmpty():
        return source.select(F.col("id").alias("doc"), "id", "text", "row")
    ordered = source.orderBy(F.asc_nulls_first("id"), "text")
    return cut_lineage(ordered.select(F.monotonically_increasing_id().alias("doc"), "id", "text", "row"))


def remove_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, carry: Sequence[str] = ()) -> DataFrame:
    """Per document: ``key``, ``n_bytes``, ``removed`` (runs of removed bytes, from and to), ``kept`` (the
    remaining bytes). Where columns to ``carry`` are named, also ``row`` (a struct of them) and ``kept_text``
    (what is kept, without the rests of characters that a cut went through).

    A byte goes if a string of ``length`` bytes that covers it also begins earlier: in a document of a smaller
    key, or earlier in the same one. Strings are judged on the input, and none spans documents. Null and empty
    texts and those shorter than ``length`` lose nothing. Rows that share a key, or have none, count in the
    order of their texts, so a repeated row loses all it holds in common with the one before; an empty table
    gives no rows. Only the named columns are read; bytes are binary, as a cut may fall inside a character.
    """
    docs = _numbered(df, key, text, carry)
    found = _anchors(docs.select("doc", "text"), length, GRAM)
    # written, so that both sides of the join are plain shuffles, which Spark can split at a frequent anchor
    often = cut_lineage(found.groupBy("anchor").count().filter("count > 1").select("anchor", (F.col("count") > HOT).alias("hot")))
    spans = cut_lineage(
        found.join(often.hint("shuffle_merge"), "anchor").groupBy("doc").agg(F.collect_list(F.struct("begin", "extent", "anchor", "hot")).alias("spans")),
    )
    # the same columns and kind of join as at the end, so that the texts are shuffled once for both
    dealt = (
        docs.join(spans.hint("shuffle_merge"), "doc", "left").select("doc", "text", "spans", "id", "row")
        .transform(arrow_map, _extract(length), "shard long, bytes binary, doc long, begin long")
    )
    kept = (
        dealt.repartition("shard").sortWithinPartitions("shard", "bytes", "doc", "begin")
        .transform(arrow_map, _shards(length), "doc long, first long, after long")
        .groupBy("doc").agg(F.collect_list(F.struct("first", "after")).alias("kept"))
    )
    marks = spans.select("doc", F.transform("spans", lambda s: F.struct(s["begin"].alias("b"), F.shiftright(s["extent"], 16).alias("n"))).alias("spans")).join(kept.hint("shuffle_merge"), "doc", "left")

    def run(batches):
        runs_of = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        for batch in batches:
            for part, raw, at in blocks(batch, "text"):
                gone = _gone(at, _flat(part.column(2)), _flat(part.column(3)), length)
                before, after = np.append(False, gone[:-1]), np.append(gone[1:], False)
                filled = np.flatnonzero(np.diff(at))  # a run ends with its text
                before[at[filled]] = False
                after[at[filled + 1] - 1] = False
                begin, end = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
                row = np.searchsorted(at, begin, "right") - 1
                runs = pa.StructArray.from_arrays([pa.array(begin - at[row]), pa.array(end - at[row])], ["from", "to"])
                cuts = pa.array(np.searchsorted(row, np.arange(len(at))).astype(np.int32))
                left = np.append(0, np.cumsum(~gone))[at]
                body = raw[~gone].tobytes()
                texts = [body[a:b] for a, b in zip(left.tolist(), left[1:].tolist())]
                out = [part.column(0), pa.array(np.diff(at)), pa.ListArray.from_arrays(cuts, runs).cast(runs_of), pa.array(texts, pa.binary())]
                if carry:
                    out += [pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string()), part.column(4)]
                yield pa.record_batch(out, ["id", "n_bytes", "removed", "kept", "kept_text", "row"][: len(out)])

    whole = docs.join(marks.hint("shuffle_merge"), "doc", "left").select("id", "text", "spans", "kept", "row")
    ddl = "id long, n_bytes long, removed array<struct<from:bigint,to:bigint>>, kept binary"
    if carry:
        ddl += f", kept_text string, row {whole.schema['row'].dataType.simpleString()}"
    return whole.transform(arrow_map, run, ddl).withColumnRenamed("id", key)


def brute_force(texts: list[tuple[int, bytes]], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The same by a table of all strings; for tests on small texts."""
    seen, out = set(), {}
    for doc, text in sorted(texts):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if text[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(text[i : i + length])
        left = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out[doc] = (len(text), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest())
    return out
