"""Words of texts that a tokenizer takes one by one, and tokenizers that remember the words they have seen."""

from __future__ import annotations

import json
import os

import numpy as np

KEPT_WORDS = 300_000
"""Words that a worker remembers of late; as many from before are kept beside them."""
KEPT_BYTES = 64
_RUN_BYTES = 1 << 16
_WHITE_BYTES = frozenset([*range(9, 14), *range(28, 33)])
_WHITE = np.isin(np.arange(256), list(_WHITE_BYTES))
# Fixed value: how byte-level tokenizers cut a text before they join bytes.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level tokenizers show each byte by: itself where it is printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """One tokenizer: ids of words, and the bytes and lengths of its entries."""

    def __init__(self, entries: list[bytes]):
        self.bytes = entries
        self.length = np.array([len(e) for e in entries], np.int64)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.uneven: set[bytes] = set()
        self.special: list[bytes] = []

    def runs(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def plain_run(self, text: str) -> list[int]:
        """Ids of a text in ASCII."""
        return self.runs([text])[0]

    def alone(self, word: str) -> bool:
        """Whether a word is not to be joined with others: one without a blank before it, or with white space that
        another word's blank could join."""
        return word[0] != " " or len(word) == 1 or word[1].isspace() or word[-1].isspace()

    def _learn(self, new: list[bytes]) -> None:
        """Many words in one text, which their lengths cut again; one by one where that does not come out even."""
        plain = [w for w in new if w.isascii()]
        others = [w for w in new if not w.isascii()] if len(plain) < len(new) else []
        odd = {w for w in plain if w[0] != 32 or len(w) == 1 or w[1] in _WHITE_BYTES or w[-1] in _WHITE_BYTES}
        if odd:
            plain = [w for w in plain if w not in odd]
        odd.update(w for w in others if self.alone(w.decode()))
        others = [w for w in others if w not in odd]
        for words, run in ((plain, self.plain_run), (others, lambda text: self.runs([text])[0])):
            begin = 0
            while begin < len(words):
                end, size = begin, 0
                while end < len(words) and (end == begin or size < _RUN_BYTES):
                    size += len(words[end])
                    end += 1
                lot, begin = words[begin:end], end
                whole = b"".join(lot)
                if any(s in whole for s in self.special):
                    odd.update(lot)
                    continue
                listed = run(whole.decode())
                ids = np.array(listed, "<i4")
                at = np.concatenate([[0], np.cumsum(self.length[ids])])
                wanted = np.cumsum([0, *map(len, lot)])
                cuts = np.searchsorted(at, wanted)
                if at[-1] == wanted[-1] and (at[cuts] == wanted).all() and b"".join(map(self.bytes.__getitem__, listed)) == whole:
                    raw, cuts = ids.tobytes(), (4 * cuts).tolist()
                    self.known.update(zip(lot, map(raw.__getitem__, map(slice, cuts[:-1], cuts[1:]))))
                else:
                    odd.update(lot)
        for w, ids in zip(odd, self.runs([w.decode() for w in odd])):
            self.known[w] = np.array(ids, "<i4").tobytes()
            if b"".join(map(self.bytes.__getitem__, ids)) != w:
                self.uneven.add(w)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words, where each word's begin, and which words their tokens spell."""
        known, older = self.known, self.older
        new = []
        for w in words:
            if w not in known:
                ids = older.get(w)
                if ids is None:
                    new.append(w)
                else:
                    known[w] = ids
        self._learn(new)
        coded = list(map(known.__getitem__, words))
        at = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) >> 2, out=at[1:])
        even = np.fromiter((w not in self.uneven for w in words), bool, len(words)) if self.uneven else np.ones(len(words), bool)
        for w in new:
            if len(w) > KEPT_BYTES:
                del known[w]
                self.uneven.discard(w)
        if len(known) > KEPT_WORDS:
            self.older, self.known = known, {}
            self.uneven = {w for w in self.uneven if w in known}
        return np.frombuffer(b"".join(coded), "<i4"), at, even


class ByteSide(Side):
    """A byte-level tokenizer of the tokenizers library.

    Words in ASCII, about which no two Unicode tables differ, go through tiktoken where the file's joins are its entries
    in order: that library then joins the same bytes, with less around it.
    """

    def __init__(self, path: str, specials_as_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = specials_as_text
        letters, vocabulary = byte_letters(), self.library.get_vocab(with_added_tokens=False)
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        entries = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
        for token, i in vocabulary.items():
            entries[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in added.items():
            entries[i] = token.encode()
        super().__init__(entries)
        self.special = [] if specials_as_text else [t.encode() for t in added]
        self.plain = _plain(path, {t: i for t, i in vocabulary.items() if t not in added}, entries)

    def runs(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def plain_run(self, text: str) -> list[int]:
        return self.plain.encode_ordinary(text) if self.plain else super().plain_run(text)


def _plain(path: str, vocabulary: dict[str, int], entries: list[bytes]):
    """The same tokenizer in tiktoken, or None where ids do not ascend in the order of joins."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    cut = stored.get("pre_tokenizer") or {}
    joins = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in stored["model"]["merges"]]
    ascending = all(x < y for x, y in zip(joins, joins[1:])) and len(vocabulary) == len(joins) + 256 and min(joins, default=256) >= 256
    if not ascending or stored.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    return tiktoken.Encoding("words", pat_str=_CUTS, mergeable_ranks={entries[i]: i for i in vocabulary.values()}, special_tokens={})


def word_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where words begin: with every document, and with each blank between two characters that are no white space.

    Byte-level tokenizers, and piece tokenizers without pieces that hold a space behind other characters, join nothing
    that such a blank parts: it begins a token. Characters of three bytes that begin as the rarer white space does (and
    U+0085 and U+00A0) count as such here, which joins words and is as right.
    """
    n = len(raw)
    blank = np.flatnonzero(raw[1:-1] == 32) + 1 if n > 2 else np.zeros(0, np.int64)
    before, after = raw[blank - 1], raw[blank + 1]
    rare = (after == 0xC2) | ((after >= 0xE1) & (after <= 0xE3))
    rare |= (raw[blank - 2] == 0xC2) & ((before == 0x85) | (before == 0xA0))
    long = raw[blank - 3]
    rare |= (before >= 0x80) & (long >= 0xE1) & (long <= 0xE3)
    starts = np.zeros(n + 1, bool)
    starts[blank[~(_WHITE[before] | _WHITE[after] | rare)]] = True
    starts[at[:-1]] = True
    return np.flatnonzero(starts[:n])


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)
