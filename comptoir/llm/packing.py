"""Best-fit packing of token pieces into sequences, first inside partitions, then over a narrowing tree.

Every round fits the pieces of a task best-fit, largest first. Bins that come out nearly full are final.
An underfull bin is taken apart again and its pieces go on as bins of one piece, so that a later round,
with pieces from more partitions in a task, is free to join them in any way. The last round keeps all bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import arrow_map, held, utf8
from comptoir.llm.vocab import ByteSide, ranges, word_starts
from comptoir.session import cut_lineage

SEQUENCE = 1024
NEARLY_FULL = 4
"""Tokens that may stay free in a bin that a round before the last makes final."""
FAN_IN = 8
"""Partitions of a round that meet in one task of the next."""
TASK_PIECES = 200_000
"""Pieces that a task packs together; more are packed in several lots, so a task's memory is bounded."""
END_ID = 2

_BLOCK_CHARS = 4_000_000
_ROWS = pa.schema([
    ("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
_DDL = "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Encoder:
    """Ids of texts by the tokenizers library, which sees each distinct word of a block once, and late words not again."""

    def __init__(self, path: str):
        self.side = ByteSide(path, specials_as_text=False)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        raw, at = utf8(pa.array(texts, pa.string()))
        starts = word_starts(raw, at)
        edges = np.append(starts, len(raw)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(raw.tobytes())]).dictionary_encode()
        codes = words.indices.to_numpy()
        ids, begin, _ = self.side.encode(words.dictionary.to_pylist())
        size = np.diff(begin)[codes]
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, at)]
        whole, cuts = ids[ranges(begin[:-1][codes], size)].astype("<u4").tobytes(), (4 * ends).tolist()
        return [whole[x:y] for x, y in zip(cuts, cuts[1:])]


def _encoder(path: str) -> Encoder:
    kept = held.setdefault("packing", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def cut(ids: bytes, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document; only the first piece may be shorter than ``size``."""
    n = len(ids) // 4
    first = n % size or min(n, size)
    begins = [0, *range(first, n, size)]
    for piece, (a, b) in enumerate(zip(begins, [*begins[1:], n])):
        yield piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers; largest first, each into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r is set if some bin has r free
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(item)
        if room > n:
            by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins


def _pack(pieces: list[tuple], ids: Iterator[int], size: int, last: bool) -> pa.RecordBatch:
    """Pieces (key, piece, start, length, crc) with sequence and offset, both null for those that go on."""
    rows = []
    for members in best_fit([p[3] for p in pieces], size):
        full = last or size - sum(pieces[m][3] for m in members) <= NEARLY_FULL
        sequence, offset = next(ids) if full else None, 0
        for m in members:
            rows.append((*pieces[m], sequence, offset if full else None))
            offset += pieces[m][3]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROWS)], schema=_ROWS)


def _numbers(level: int) -> Iterator[int]:
    """Sequence numbers that no other task or round gives."""
    n = (level << 58) | (TaskContext.get().partitionId() << 34)
    while True:
        yield n
        n += 1


def pack(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", size: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents with their place: ``key, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and an end id; null and empty texts are the end id alone. Each row is a document
    of its own, also where keys repeat or are null. Only the two named columns are read; ``key`` is a long.
    An empty table gives no rows. Each round is a written table, so sequence numbers survive lost executors.
    """
    def local(batches):
        encoder, numbers, open_pieces = _encoder(path), _numbers(0), []
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            row = 0
            while row < len(texts):
                stop, chars = row, 0
                while stop < len(texts) and (stop == row or chars < _BLOCK_CHARS):
                    chars += len(texts[stop])
                    stop += 1
                whole = []
                for k, ids in zip(keys[row:stop], encoder.encode(texts[row:stop])):
                    for piece in cut(ids + end, size):
                        if piece[2] == size:
                            whole.append((k, *piece, next(numbers), 0))
                        else:
                            open_pieces.append((k, *piece))
                if whole:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*whole), _ROWS)], schema=_ROWS)
                if len(open_pieces) >= TASK_PIECES:
                    yield _pack(open_pieces, numbers, size, last=False)
                    open_pieces = []
                row = stop
        if open_pieces:
            yield _pack(open_pieces, numbers, size, last=False)

    def merge(level: int, last: bool):
        def run(batches):
            numbers, pieces = _numbers(level), []
            for batch in batches:
                pieces.extend(zip(*[batch.column(i).to_pylist() for i in range(5)]))
                if len(pieces) >= TASK_PIECES:
                    yield _pack(pieces, numbers, size, last)
                    pieces = []
            if pieces:
                yield _pack(pieces, numbers, size, last)

        return run

    source = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = cut_lineage(source.transform(arrow_map, local, _DDL, "packing"))
    done, level = placed.filter(F.col("sequence_id").isNotNull()), 0
    tasks = max(1, source.rdd.getNumPartitions())
    while True:
        going = placed.filter(F.col("sequence_id").isNull())
        left, level = going.count(), level + 1
        fewest = max(1, -(-left // TASK_PIECES))
        tasks, before = max(fewest, -(-tasks // FAN_IN)), tasks
        last = tasks == fewest or tasks >= before
        mixed = F.xxhash64("key", "piece", "ids_crc32")
        spread = going.repartition(tasks, mixed).sortWithinPartitions(mixed)
        placed = cut_lineage(spread.transform(arrow_map, merge(level, last), _DDL))
        done = done.unionByName(placed.filter(F.col("sequence_id").isNotNull()))
        if last:
            return done.withColumnRenamed("key", key)
