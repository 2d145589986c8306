from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from comptoir.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, root string, number long, tree string, total int"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree(digests):
    """The root, and per leaf the groups it lies in with its place, level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        groups = [digests[i : i + 8] for i in range(0, len(digests), 8)]
        for p, path in enumerate(paths):
            path.append((groups[at[p] // 8], at[p] % 8))
            at[p] //= 8
        digests = [sha("".join(g)) for g in groups]
    return digests[0], paths


def brute(rows):
    out, subroots = [], []
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    for lang in sorted(by_lang, key=lambda x: (x is not None, (x or "").encode())):
        members = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        subroots.append((members, *tree([leaf(r, r[4]) for r in members])))
    root, above = tree([s[1] for s in subroots]) if subroots else (None, [])
    for (members, subroot, paths), top in zip(subroots, above):
        for row, path in zip(members, paths):
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node, proof = leaf(row, text), ""
            for group, place in path + top:
                proof += "".join(group[:place] + group[place + 1 :])
                node = sha("".join([*group[:place], node, *group[place + 1 :]]))
            out.append((row[0], leaf(row, row[4]), subroot, root, sha(proof), node, node == root))
    return sorted(out, key=str)


def found(spark, rows, depth):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.manifest(df, depth).collect()), key=str)


def corpus(n, langs, seed=1):
    r = random.Random(seed)
    rows = [(i, r.choice(["web", None]), r.choice(langs), r.choice([i, None]), r.choice(["Some Text é", "lower", "", None, "ß" * 9 + str(i)])) for i in range(n)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, langs, depth", [(700, ["en", "de", None], 1), (700, ["en"], 2), (90, [f"l{i}" for i in range(70)] + ["é", "Z", ""], 4), (5000, ["en", "en", "fr"], 4)])
def test_against_brute_force(spark, n, langs, depth):
    rows = corpus(n, langs)
    got = found(spark, rows, depth)
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_nulls_ties_repeats_and_long_texts(spark):
    """Repeated rows are leaves of their own, rows that share an id stand in the order of their leaves."""
    rows = [(None, None, None, None, None)] * 3 + [(7, "a", "en", 1, "A B")] * 9 + [(7, "b", "en", 1, "C"), (2, "", "", 0, ""), (1, "a", "en", 9, "Long Word " * 100_000)]
    assert found(spark, rows, 1) == brute(rows)
    assert found(spark, rows[:1], 4) == brute(rows[:1])


def test_empty_table(spark):
    df = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert df.count() == 0 and df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_queue_and_reversed_sweep():
    digests = [str(i).encode() for i in range(30)]
    nodes = merkle.climb(digests, 2)
    assert [len(level) for level in nodes] == [30, 4, 1]
    proofs = merkle.hand_down(nodes, b"above")
    assert proofs[17] == b"".join(digests[16:17] + digests[18:24]) + b"".join(nodes[1][:2] + nodes[1][3:]) + b"above"
    assert [merkle.height(n) for n in (0, 1, 2, 8, 9, 64, 65)] == [0, 0, 1, 1, 2, 2, 3]
