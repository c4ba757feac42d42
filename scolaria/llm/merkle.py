"""A Merkle manifest of a corpus: trees of digests in blocks of fixed height, each laid out as by van Emde Boas."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scolaria.llm.shared import ascii_lower, written

ARITY = 16
#: Levels of nodes in a block: a block holds up to ARITY ** (LEVELS - 1) leaves, here 4096.
LEVELS = 4
LEAVES = ARITY ** (LEVELS - 1)
DIGEST = 32

LEAF = "key string, at long, total long, name string, digest binary, other binary"
BLOCK = "key string, block long, total long, levels int, names array<string>, others array<binary>, nodes binary"
PATH = "key string, block long, name string, digest binary, lefts array<string>, rights array<string>"
PROOF = "key string, name string, leaf string, proof_sha256 string, folded_root string, subroot string"


def tree_size(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where the nodes index of a depth (the root has 0) lie in a tree of so many levels.

    The tree is cut at half its height: first comes the top, then the trees below it from left to right, each laid out
    in the same way. So a walk from a leaf to the root stays within few cache lines or pages whatever their size.
    """
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    span = ARITY ** (depth - top)
    return tree_size(top) + index // span * tree_size(levels - top) + address(depth - top, index % span, levels - top)


def widths(leaves: int, levels: int) -> list[int]:
    """The nodes at every depth of a tree over so many leaves, all of which stand at the last depth."""
    out = [leaves]
    for _ in range(levels - 1):
        out.insert(0, -(-out[0] // ARITY))
    return out


def levels_over(leaves: int) -> int:
    """The levels of a tree that ends as soon as one node remains."""
    levels = 1
    while leaves > 1:
        leaves, levels = -(-leaves // ARITY), levels + 1
    return levels


class Block:
    """A subtree of the manifest: nodes[address(depth, i, levels)] is the i-th node of a depth; absent places are zero,
    and what would follow the last node is cut off."""

    def __init__(self, nodes: np.ndarray, leaves: int, levels: int) -> None:
        self.nodes, self.levels, self.widths = nodes, levels, widths(leaves, levels)

    @classmethod
    def over(cls, leaves: list[bytes], levels: int) -> Block:
        there = widths(len(leaves), levels)
        last = max(int(address(depth, np.array(width - 1), levels)) for depth, width in enumerate(there))
        block = cls(np.zeros((last + 1, DIGEST), np.uint8), len(leaves), levels)
        block.nodes[address(levels - 1, np.arange(len(leaves)), levels)] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, DIGEST)
        for depth in range(levels - 2, -1, -1):
            made = b"".join(hashlib.sha256(run).digest() for run in block.runs(depth + 1))
            block.nodes[address(depth, np.arange(there[depth]), levels)] = np.frombuffer(made, np.uint8).reshape(-1, DIGEST)
        return block

    @classmethod
    def of_bytes(cls, data: bytes, leaves: int, levels: int) -> Block:
        return cls(np.frombuffer(data, np.uint8).reshape(-1, DIGEST), leaves, levels)

    def row(self, depth: int) -> np.ndarray:
        return self.nodes[address(depth, np.arange(self.widths[depth]), self.levels)]

    def runs(self, depth: int) -> list[bytes]:
        """The digests of every ARITY consecutive nodes of a depth as one hex text."""
        text = self.row(depth).tobytes().hex().encode()
        return [text[at : at + 2 * DIGEST * ARITY] for at in range(0, len(text), 2 * DIGEST * ARITY)]

    def paths(self) -> Iterator[list[tuple[bytes, bytes]]]:
        """For every leaf: what stands left and right of it in its run, then of its parent, up to below the root."""
        runs = [self.runs(depth) for depth in range(self.levels - 1, 0, -1)]
        for at in range(self.widths[-1]):
            path = []
            for level in runs:
                at, k = divmod(at, ARITY)
                path.append((level[at][: 2 * DIGEST * k], level[at][2 * DIGEST * (k + 1) :]))
            yield path


def fold(node: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that follows from a node's hex digest and what stands left and right of it on every level."""
    for left, right in path:
        node = hashlib.sha256(left + node + right).hexdigest().encode()
    return node


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    """Hex digest of a row of documents with this text."""
    return F.sha2(F.concat(*[_field(column) for column in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)]), 256)


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def placed(rows: DataFrame, *order: Column) -> DataFrame:
    """rows (key, ...) with at, a row's place among those of its key by order, from 0, and total, how many there are.

    The rows are range-partitioned, so a key with most of them lies in many partitions. What the places of a partition
    begin at follows from one row for each partition and key in it.
    """
    in_order = written(rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order).withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftright("row", 33)  # the partition that wrote the row
    runs = in_order.groupBy("key", part.alias("part")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    of_key = Window.partitionBy("key")
    before = F.sum("n").over(of_key.orderBy("part")) - F.col("n")
    runs = written(runs.select("key", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(of_key).alias("total")))
    met = in_order.withColumn("part", part).join(runs, ["key", "part"])
    return met.withColumn("at", F.col("row") + F.col("shift")).drop("row", "shift", "part")


def _stored(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("at")
    total = int(group["total"].iloc[0])
    levels = levels_over(total) if total <= LEAVES else LEVELS
    block = Block.over([bytes(digest) for digest in group["digest"]], levels)
    row = (group["key"].iloc[0], int(group["at"].iloc[0]) // LEAVES, total, levels, group["name"].tolist(), group["other"].tolist(), block.nodes.tobytes())
    return pd.DataFrame([row], columns=[column.split()[0] for column in BLOCK.split(", ")])


def climb(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, from the leaves (LEAF) up, and key, digest, height of every key's one remaining node.

    A block takes LEAVES aligned leaves of a key; the roots of a key's blocks are the leaves of the next round, until
    it has one block. So the tree of the largest key takes a round for every LEVELS - 1 of its levels.
    """
    rounds: list[DataFrame] = []
    roots: list[DataFrame] = []
    while True:
        block = F.floor(F.col("at") / LEAVES).alias("block")
        blocks = written(leaves.groupBy("key", block).applyInPandas(_stored, BLOCK))
        rounds.append(blocks)
        root = F.substring("nodes", 1, DIGEST).alias("digest")
        roots.append(blocks.where(f"total <= {LEAVES}").select("key", root, F.lit(len(rounds) - 1).alias("height")))
        above = blocks.where(f"total > {LEAVES}")
        if above.isEmpty():
            break
        total = F.ceil(F.col("total") / LEAVES).alias("total")
        leaves = above.select("key", F.col("block").alias("at"), total, F.lit(None).cast("string").alias("name"), root, F.lit(None).cast("binary").alias("other"))
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return rounds, written(out)


def _expanded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """PATH of the leaves of blocks: their place, their own path inside the block, then that of the block."""
    for frame in frames:
        for key, number, levels, names, nodes, lefts, rights in zip(*[frame[c] for c in ("key", "block", "levels", "names", "nodes", "lefts", "rights")]):
            block = Block.of_bytes(bytes(nodes), len(names), int(levels))
            above = [(left.encode(), right.encode()) for left, right in zip(lefts, rights)]
            paths = [path + above for path in block.paths()]
            yield pd.DataFrame({
                "key": key, "block": int(number) * LEAVES + np.arange(len(names)), "name": list(names), "digest": [row.tobytes() for row in block.row(block.levels - 1)],
                "lefts": [[left.decode() for left, _ in path] for path in paths], "rights": [[right.decode() for _, right in path] for path in paths],
            })


def _proven(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """PROOF of the leaves of blocks."""
    for frame in frames:
        for key, levels, names, others, nodes, lefts, rights, subroot in zip(*[frame[c] for c in ("key", "levels", "names", "others", "nodes", "lefts", "rights", "subroot")]):
            block = Block.of_bytes(bytes(nodes), len(names), int(levels))
            above = [(left.encode(), right.encode()) for left, right in zip(lefts, rights)]
            leaves = [row.tobytes() for row in block.row(block.levels - 1)]
            rows = []
            for name, leaf, other, inside in zip(names, leaves, others, block.paths()):
                path = inside + above
                shown = leaf if other is None else bytes(other)
                proof = hashlib.sha256(b"".join(left + right for left, right in path)).hexdigest()
                rows.append((key, name, leaf.hex(), proof, fold(shown.hex().encode(), path).decode(), subroot))
            yield pd.DataFrame(rows, columns=[column.split()[0] for column in PROOF.split(", ")])


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The last round's blocks with the path above them: BLOCK, lefts, rights and the columns of tops (key, height, ...).

    tops has the path of every key's root; height is the round of the block that ends in it.
    """
    found = None
    for height in range(len(rounds) - 1, -1, -1):
        paths = tops.where(F.col("height") == height).withColumn("block", F.lit(0).cast("long"))
        if found is not None:
            expanded = found.select("key", "block", "levels", "names", "nodes", "lefts", "rights").mapInPandas(_expanded, PATH)
            inner = expanded.select("key", "block", "lefts", "rights").join(tops.drop("lefts", "rights"), "key")
            paths = paths.unionByName(inner)
        found = rounds[height].join(written(paths), ["key", "block"])
    return found


@dataclass(frozen=True)
class Manifest:
    """rounds: blocks of the sources' trees, the first with the documents; top: those of the tree over the sources;
    subroots: key, digest, height; root: hex, null without rows. Tables lie in the shared folder."""

    rounds: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: str | None


def build_manifest(docs: DataFrame, text: Column | None = None) -> Manifest:
    """The trees over docs (doc_id, source, lang, n_chars, text); a leaf's other digest is that of text, where it is given
    and not null. Within a source leaves are ordered by doc_id (null first), equal ids by their digests."""
    key = F.coalesce(F.concat(F.lit("/"), F.col("source").cast("string")), F.lit(""))  # a null source before all others
    other = F.lit(None).cast("binary") if text is None else F.unhex(text)
    leaves = written(docs.select(key.alias("key"), "doc_id", F.unhex(leaf_digest(F.col("text"))).alias("digest"), other.alias("other"), F.monotonically_increasing_id().alias("n")))
    in_place = placed(leaves, F.asc_nulls_first("doc_id"), F.col("digest"), F.col("n"))
    rounds, subroots = climb(in_place.select("key", "at", "total", F.col("doc_id").cast("string").alias("name"), "digest", "other"))
    sources = placed(subroots.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest"), F.col("name"))
    top, root = climb(sources.withColumn("other", F.lit(None).cast("binary")))
    found = root.first()
    return Manifest(rounds, top, subroots, bytes(found["digest"]).hex() if found else None)


def prove(manifest: Manifest) -> DataFrame:
    """PROOF and root for every document of the manifest, folded from its other digest where it has one."""
    none = F.array().cast("array<string>")
    tops = manifest.subroots.sparkSession.createDataFrame([("", len(manifest.top) - 1)], "key string, height int")
    sources = descend(manifest.top, tops.select("key", "height", none.alias("lefts"), none.alias("rights"))).select("key", "block", "levels", "names", "nodes", "lefts", "rights")
    sources = written(sources.mapInPandas(_expanded, PATH)).select(F.col("name").alias("key"), F.lower(F.hex("digest")).alias("subroot"), "lefts", "rights")
    blocks = descend(manifest.rounds, sources.join(manifest.subroots.select("key", "height"), "key"))
    columns = ("key", "levels", "names", "others", "nodes", "lefts", "rights", "subroot")
    return blocks.select(*columns).mapInPandas(_proven, PROOF).withColumn("root", F.lit(manifest.root).cast("string"))


def audit_tampering(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs (doc_id, source, lang, n_chars, text).

    A leaf is the digest of the row's fields, a null one told from an empty one; sources, a null one included, have one
    tree each, and their roots another. Where tampered() says so, the folded root starts from the row with its text in
    lower case; verified tells whether it still is the root. Repeated rows are leaves of their own; an empty table gives
    an empty table; a very long text costs its digest only; other columns are left out.
    """
    changed = F.when(tampered(F.col("doc_id")), leaf_digest(ascii_lower(F.col("text"))))
    proofs = prove(build_manifest(docs, changed))
    kind = docs.schema["doc_id"].dataType
    return proofs.select(F.col("name").cast(kind).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
