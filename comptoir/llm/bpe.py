"""Byte-pair encoding with a pair occurrence index, and decoding.

The distinct words of a block are laid end to end and every pair of neighbouring symbols is mapped to
all its positions. Active pairs are taken by ascending rank, each is merged at all its positions at once,
and only the lists of the pairs next to a merge are updated.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import arrow_map, held

# The white space of the Unicode property, as a pattern's \s has it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
_SPACES = regex.compile(f"[{_SPACE}]+")

KEPT_WORDS = 300_000
"""Encoded words that a worker keeps from block to block (memory only; results don't depend on it)."""
_KEPT_CHARS = 48
_BLOCK_CHARS = 2_500_000


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown, other = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in shown:
            shown[b], other = chr(other), other + 1
    return [shown[b] for b in range(256)]


class Vocabulary:
    """A tokenizer file of the word kind: NFC, white space as one blank, lower case, words with an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            if a in ids and b in ids and a + b in ids:
                self.ranks.setdefault(ids[a] * self.size + ids[b], (rank, ids[a + b]))
        self.ranked = np.array(sorted(self.ranks), np.int64)
        alphabet = _byte_alphabet()
        self.inner = [ids[c] for c in alphabet]
        self.last = [ids[c + self.end] for c in alphabet]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", _SPACE)
        self.split = regex.compile(pattern)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}  # by chunk without white space
        self.coded: dict[str, bytes] = {}  # by word

    def pieces(self, chunk: str) -> list[str]:
        """The words of a chunk without white space."""
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # lower case by character, not by place
        return self.split.findall(chunk.lower())

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words together through the pair occurrence index."""
        symbols: list[int] = []
        begins: list[int] = []
        for word in words:
            begins.append(len(symbols))
            raw = word.encode("utf-8")
            symbols.extend([self.inner[b] for b in raw[:-1]])
            symbols.append(self.last[raw[-1]])
        n, size, ranks = len(symbols), self.size, self.ranks
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for b in begins:
            before[b] = -1
            if b:
                after[b - 1] = -1
        if n:
            after[n - 1] = -1
        places = self._places(np.array(symbols, np.int64), np.array(after, np.int64))
        active = [(ranks[p][0], p) for p in places]
        heapq.heapify(active)
        while active:
            _, pair = heapq.heappop(active)
            at = places.pop(pair, None)
            if at is None:
                continue
            (a, b), joined = divmod(pair, size), ranks[pair][1]
            at.sort()
            for i in at:
                j = after[i]
                if symbols[i] != a or j < 0 or symbols[j] != b:
                    continue  # an overlapping merge took one of the two
                symbols[i], symbols[j] = joined, -1
                k = after[i] = after[j]
                h = before[i]
                if k >= 0:
                    before[k] = i
                    near = joined * size + symbols[k]
                    if near in places:
                        places[near].append(i)
                    elif near in ranks:
                        places[near] = [i]
                        heapq.heappush(active, (ranks[near][0], near))
                if h >= 0:
                    near = symbols[h] * size + joined
                    if near in places:
                        places[near].append(h)
                    elif near in ranks:
                        places[near] = [h]
                        heapq.heappush(active, (ranks[near][0], near))
        ends = [*begins[1:], n]
        return [[s for s in symbols[b:e] if s >= 0] for b, e in zip(begins, ends)]

    def _places(self, symbols: np.ndarray, after: np.ndarray) -> dict[int, list[int]]:
        """All places of every pair that has a rank."""
        at = np.flatnonzero(after >= 0)
        pairs = symbols[at] * self.size + symbols[at + 1]
        ranked = self.ranked[np.minimum(np.searchsorted(self.ranked, pairs), len(self.ranked) - 1)] == pairs
        at, pairs = at[ranked], pairs[ranked]
        order = np.argsort(pairs, kind="stable")
        at, pairs = at[order], pairs[order]
        cuts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else []
        return {int(pairs[a]): at[a:b].tolist() for a, b in zip(cuts, [*cuts[1:], len(pairs)])}

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode chunks not yet known, and the words among them not yet seen."""
        new = list(chunks)
        split = [self.pieces(c) for c in new]
        coded = self.coded
        distinct = list({p for ps in split for p in ps}.difference(coded))
        for word, ids in zip(distinct, self.encode_words(distinct)):
            coded[word] = np.array(ids, "<u4").tobytes()
        for chunk, ps in zip(new, split):
            self.known[chunk] = coded[ps[0]] if len(ps) == 1 else b"".join([coded[p] for p in ps])
        if len(coded) > KEPT_WORDS:
            coded.clear()
        else:
            for word in distinct:
                if len(word) > _KEPT_CHARS:
                    del coded[word]

    def _chunks(self, text: str) -> list[str]:
        return text.split() if not _ODD_SPACE.search(text) else [c for c in _SPACES.split(text) if c]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = []
        for text in texts:
            special = any(s in text for s in self.special)
            parts.append([text] if not special else self.special_split.split(text))
        chunked = [[(self.special.get(p) if len(ps) > 1 else None, p if p in self.special and len(ps) > 1 else self._chunks(p)) for p in ps] for ps in parts]
        new: set[str] = set()
        for ps in chunked:
            for mark, cs in ps:
                if mark is None:
                    new.update(set(cs).difference(self.known))
        self.learn(new)
        known = self.known
        for ps in chunked:
            yield b"".join(np.array([mark], "<u4").tobytes() if mark is not None else b"".join([known[c] for c in cs]) for mark, cs in ps)
        if len(known) > KEPT_WORDS:
            known.clear()
        else:
            for c in new:
                if len(c) > _KEPT_CHARS:
                    del known[c]

    def decode(self, ids: bytes) -> str:
        """The tokens with blanks between, special ones included, as a tokenizer file without a decoder has it."""
        return " ".join([self.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def vocabulary(path: str) -> Vocabulary:
    """One per worker and file."""
    kept = held.setdefault("bpe", {})
    if path not in kept:
        kept[path] = Vocabulary(path)
    return kept[path]


def _text_blocks(column: pa.Array) -> Iterator[list[str]]:
    block, chars = [], 0
    for text in column.to_pylist():
        block.append(text)
        chars += len(text)
        if chars >= _BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def encode(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``ids`` (binary: little-endian unsigned 32-bit integers) of every whole text.

    Special tokens written in a text become their ids. A null or empty text has no ids. Rows stay as they
    are, repeated ones too; only the two named columns are read. ``path`` must be readable where tasks run.
    """
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            row = 0
            for texts in _text_blocks(batch.column(1)):
                coded = pa.array(list(vocab.encode(texts)), pa.binary())
                yield pa.record_batch([batch.column(0).slice(row, len(texts)), coded], ["key", "ids"])
                row += len(texts)

    source = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.transform(arrow_map, run, f"key {kind}, ids binary", "bpe").withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` (text). Null ids decode to an empty text."""
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                texts = pa.array([vocab.decode(x) for x in part.column(1).to_pylist()], pa.string())
                yield pa.record_batch([part.column(0), part.column(1), texts], ["key", "ids", "decoded"])

    source = df.select(F.col(key).alias("key"), F.coalesce(F.col(ids), F.lit(b"")).alias("ids"))
    kind = source.schema["key"].dataType.simpleString()
    return source.transform(arrow_map, run, f"key {kind}, ids binary, decoded string", "bpe").withColumnRenamed("key", key)
