"""Vector helpers shared by the operators: bytes of Arrow text columns, word and n-gram hashes."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number modulo 2**64, and of its inverse."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_MULTIPLIER, _INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and where each row begins (one more entry at the end)."""
    wide = column.cast(pa.large_binary())
    if not len(wide):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(batch: pa.RecordBatch, text: str, size: int = (1 << 20) - 1) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``size`` bytes of text each, one row at least, with their bytes and starts."""
    raw, at = utf8(batch.column(batch.schema.get_field_index(text)))
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield batch.slice(row, end - row), raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def words(raw: np.ndarray, at: np.ndarray, fold_case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (a run of anything but blanks and the controls 9 to 13), and where each row's words begin."""
    n = len(raw)
    if not n:
        return np.zeros(0, U64), np.zeros(len(at), np.int64)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = at[:-1][at[:-1] < n]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = at[1:][at[1:] > 0] - 1
    ends[last] = inside[last]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if fold_case:
        raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum((raw.astype(U64) + U64(1)) * up[:n], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin]), np.searchsorted(begin, at)


def shingles(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``n`` words in a row per row, in ascending order, and where each row's begin.

    A row of fewer words, but one at least, has a single shingle of all its words.
    """
    count = np.diff(at)
    rows = len(count)
    owner = np.repeat(np.arange(rows), count)
    total = len(hashes)
    grams = np.zeros(total, U64)
    padded = np.concatenate([hashes, np.zeros(n, U64)])
    left = np.repeat(at[1:], count) - np.arange(total)  # words from here to the end of the row
    for j in range(n):
        factor = U64(pow(_MULTIPLIER, 2 * j + 3, 1 << 64))
        grams += np.where(left > j, padded[j : j + total] * factor, U64(0))
    whole = (left >= n) | ((left == np.repeat(count, count)) & (np.repeat(count, count) < n))
    grams, owner = mix(grams[whole]), owner[whole]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(rows + 1))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of the application, once: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="comptoir-")  # on the driver, which serves the file from there
        context.addPyFile(shutil.make_archive(f"{folder}/comptoir-{context.applicationId}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


held: dict[str, dict] = {}
"""What operators keep in a worker from task to task, by the operator's name."""


def arrow_map(df: DataFrame, run: Callable, schema: str, keeps: str | None = None) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers.

    A worker serves many stages; what other operators than ``keeps`` left in it is freed first.
    """
    ship(df.sparkSession)

    def alone(batches):
        for name in [n for n in held if n != keeps]:
            del held[name]
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim is not None:
            trim(0)

    return df.mapInArrow(alone, schema)
