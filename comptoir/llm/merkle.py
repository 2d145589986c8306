"""Merkle manifest of a dataset: a tree of digests per language, a tree over those, and a proof for every row.

Time-forward processing. Nodes are labelled by level and number, leaves first. Going up, every node sends its digest
to its parent through a queue ordered by label, so a node finds its children's digests together and in order when its
turn comes; going down, in reversed order, every node hands its proof suffix (the digests beside the path from it to
the root) to its children. The queue is external: between rounds it is Spark's shuffle, sorted within partitions by
tree, block and number, which spills; inside a task only the messages of one block of neighbouring nodes are in
memory. A round climbs ``DEPTH`` levels, so rounds grow with the logarithm of the largest tree.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm.arrays import arrow_map
from comptoir.operators.positions import with_positions
from comptoir.session import cut_lineage

FAN = 8
DEPTH = 4
"""Levels that a round climbs, so ``FAN ** DEPTH`` neighbouring nodes are in a task's memory together."""
TAMPERED = 3
"""Rows whose id has a checksum divisible by this are verified on a tampered text."""
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64


def _digest(hexes: bytes) -> bytes:
    return hashlib.sha256(hexes).hexdigest().encode()


def height(total: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while total > 1:
        total, levels = -(-total // FAN), levels + 1
    return levels


def climb(digests: list[bytes], levels: int) -> list[list[bytes]]:
    """All digests of a block, level by level, from a queue of messages to parents ordered by label."""
    tree: list[list[bytes]] = [digests, *[[] for _ in range(levels)]]
    queue = [((1, i // FAN, i), d) for i, d in enumerate(digests)] if levels else []  # in order: a heap already
    while queue:
        level, number = queue[0][0][:2]
        children = []
        while queue and queue[0][0][:2] == (level, number):
            children.append(heapq.heappop(queue)[1])
        tree[level].append(_digest(b"".join(children)))
        if level < levels:
            heapq.heappush(queue, ((level + 1, number // FAN, number), tree[level][-1]))
    return tree


def hand_down(tree: list[list[bytes]], suffix: bytes) -> list[bytes]:
    """The proof suffixes of a block's first level, from that of its top node: labels in reversed order."""
    above = [suffix]
    for nodes in reversed(tree[:-1]):
        below = []
        for number in range(len(nodes)):
            first = number - number % FAN
            beside = b"".join(nodes[first:number]) + b"".join(nodes[number + 1 : first + FAN])
            below.append(beside + above[number // FAN])
        above = below
    return above


def fold(leaf: bytes, proof: bytes, path: list[tuple[int, int]]) -> bytes:
    """The root that a leaf and its proof lead to. ``path`` holds (number in the level, nodes in the level) of each tree."""
    node, used = leaf, 0
    for number, total in path:
        while total > 1:
            place = number % FAN
            size = min(FAN, total - (number - place))
            beside = proof[used : used + (size - 1) * _HEX]
            node = _digest(beside[: place * _HEX] + node + beside[place * _HEX :])
            used += len(beside)
            number, total = number // FAN, -(-total // FAN)
    return node


def _blocks(batches) -> Iterator[list[dict]]:
    """Rows of one tree and block, across batches."""
    rows, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["block"]) != last and rows:
                yield rows
                rows = []
            last = (row["tree"], row["block"])
            rows.append(row)
    if rows:
        yield rows


def _climb(rows: list[dict], depth: int) -> list[list[bytes]]:
    return climb([r["digest"].encode() for r in rows], min(depth, height(rows[0]["total"])))


def _up(depth: int):
    """One node per block: the one that its members climb to."""
    def run(batches):
        for rows in _blocks(batches):
            top = _climb(rows, depth)[-1][0]
            yield pa.record_batch({
                "tree": pa.array([rows[0]["tree"]], pa.string()), "number": pa.array([rows[0]["block"]], pa.int64()),
                "total": pa.array([-(-rows[0]["total"] // FAN**depth)], pa.int64()), "digest": pa.array([top.decode()], pa.string()),
            })

    return run


def _down(depth: int):
    """The proof suffix of every member of a block; the message from above comes first."""
    def run(batches):
        for message, *rows in _blocks(batches):
            yield pa.record_batch({
                "tree": pa.array([message["tree"]] * len(rows), pa.string()), "number": pa.array([r["number"] for r in rows], pa.int64()),
                "suffix": pa.array(hand_down(_climb(rows, depth), message["suffix"]), pa.binary()),
            })

    return run


def _prove(depth: int):
    """As ``_down`` for the leaves of rows: the digest of the whole proof, and the root recomputed by it."""
    def run(batches):
        for message, *rows in _blocks(batches):
            above, folded, digests, n = (message["tree_number"], message["trees"]), [], [], len(rows)
            for row, proof in zip(rows, hand_down(_climb(rows, depth), message["suffix"])):
                digests.append(_digest(proof).decode())
                folded.append(fold(row["judged"].encode(), proof, [(row["number"], row["total"]), above]).decode())
            yield pa.record_batch({
                "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()), "leaf": pa.array([r["digest"] for r in rows], pa.string()),
                "subroot": pa.array([message["subroot"]] * n, pa.string()), "root": pa.array([message["root"]] * n, pa.string()),
                "proof_sha256": pa.array(digests, pa.string()), "folded_root": pa.array(folded, pa.string()),
                "verified": pa.array([f == message["root"] for f in folded], pa.bool_()),
            })

    return run


_NODE = "tree string, number long, total long, digest string"
_PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _in_blocks(df: DataFrame, *first: str | Column) -> DataFrame:
    return df.repartition("tree", "block").sortWithinPartitions("tree", "block", *first)


def _block(depth: int) -> Column:
    return F.expr(f"number div {FAN**depth}").alias("block")


def grow(leaves: DataFrame, depth: int) -> list[DataFrame]:
    """The written tables of nodes by round, leaves first: ``tree, number, total, digest``; the last holds the roots."""
    rounds = [leaves]
    most = leaves.agg(F.max("total")).first()[0] or 0
    while most > 1:
        last = rounds[-1]
        rounds.append(cut_lineage(_in_blocks(last.select("tree", _block(depth), "number", "total", "digest"), "number").transform(arrow_map, _up(depth), _NODE)))
        most = -(-most // FAN**depth)
    return rounds


def _with_messages(nodes: DataFrame, messages: DataFrame, depth: int) -> DataFrame:
    """Members of blocks after the message for their block, which is named by the number of its top node."""
    sent = messages.withColumnRenamed("number", "block")
    return _in_blocks(nodes.withColumn("block", _block(depth)).unionByName(sent, allowMissingColumns=True), F.col("suffix").isNull(), "number")


def deliver(rounds: list[DataFrame], messages: DataFrame, depth: int) -> DataFrame:
    """Proof suffixes ``tree, number, suffix`` of the nodes of the first of ``rounds``, from those of the last."""
    for nodes in reversed(rounds[:-1]):
        messages = cut_lineage(_with_messages(nodes, messages, depth).transform(arrow_map, _down(depth), "tree string, number long, suffix binary"))
    return messages


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(F.col(c)) for c in FIELDS[:-1]], _field(text)), 256)


def manifest(df: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row.

    A row's leaf is the digest of its fields, each ``-`` if null, else its number of bytes, a colon and the value;
    null, empty and very long values need nothing else. Leaves of a language stand in the order of ``doc_id``, null
    first; rows that share an id stand in the order of their leaves, so that repeated rows are leaves of their own and
    the roots depend on nothing but the rows. A null language is a tree of its own, before all others. ``root`` is
    recomputed into ``folded_root`` from the row's proof and its leaf, or from the leaf of a tampered text (its
    letters A to Z in lower case) where 3 divides the checksum of the id; a null id is not tampered with. An empty
    table gives no rows. Columns other than the five named ones are not read. ``doc_id`` is a long.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    tampered = F.translate("text", upper, lower)
    digests = cut_lineage(df.select(*FIELDS).select(  # written, as ranges are sampled first: texts are read once
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("tree"), leaf_digest(F.col("text")).alias("digest"),
        F.when(chosen, leaf_digest(tampered)).alias("judged"),
    ))
    placed = cut_lineage(
        with_positions(digests, ["tree"], [F.col("doc_id").asc_nulls_first(), "digest"], "number", "total")
        .withColumn("judged", F.coalesce("judged", "digest"))
    )
    rounds = grow(placed.select("tree", "number", "total", "digest"), depth)
    subroots = rounds[-1].select(F.lit("").alias("all"), "tree", "digest")
    ranked = cut_lineage(with_positions(subroots, ["all"], [F.col("tree").asc_nulls_first()], "number", "total"))
    top = grow(ranked.select(F.col("all").alias("tree"), "number", "total", "digest"), depth)
    root = top[-1].first()
    handed = deliver(top, top[-1].select("tree", "number", F.lit(b"").alias("suffix")), depth)
    known = cut_lineage(
        ranked.select("tree", F.col("number").alias("tree_number"), F.col("total").alias("trees"), F.col("digest").alias("subroot"))
        .join(handed.select(F.col("number").alias("tree_number"), "suffix"), "tree_number")
    )
    at_roots = known.select("tree", F.lit(0).cast("long").alias("number"), "suffix")
    # the last step down, to the leaves, takes place where they are proved
    messages = deliver(rounds[1:], at_roots, depth) if len(rounds) > 1 else at_roots
    facts = known.select(
        F.col("tree").alias("__tree"), "tree_number", "trees", "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"),
    )
    addressed = messages.join(facts, F.col("tree").eqNullSafe(F.col("__tree"))).drop("__tree")
    return _with_messages(placed, addressed, depth).transform(arrow_map, _prove(depth), _PROVED)
