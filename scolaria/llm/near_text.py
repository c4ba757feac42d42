"""Near duplicates by text: SimHash fingerprints find candidates, MinHash bands those whose fingerprints lie too far
apart, and the exact Jaccard similarity of word shingles decides."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.llm.components import component_labels
from scolaria.llm.shared import ascii_lower, drop_kept, text_or_empty, whole_runs, written
from scolaria.llm.simhash import first_of_each, links_within, majority, shingle_hashes

SHINGLE = 5
#: Bits in which fingerprints of candidates differ: eight segments of a byte. Similar pairs differ by up to twice as many,
#: where segments would let nearly all pairs meet; the bands are for those.
RADIUS = 7
SIMILARITY = 0.8
SEED = 42
#: A pair of similarity s shares a band with probability 1 - (1 - s ** ROWS) ** BANDS: all but 5 in 100 000 at 0.8.
BANDS, ROWS = 25, 5
CHUNK = 4096
#: Members of a band that one task compares with as many others; sketch bits of a set, as 64-bit words.
BLOCK, SKETCH = 256, 16
STRIP, FEW = 32, 8
#: What two blocks that meet share: their band and the numbers of both.
MEETING = ["band", "low", "high"]

_RANDOM = np.random.default_rng(SEED)
_MIXED = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def bands(hashes: np.ndarray) -> list[int]:
    """One number a band: equal where two sets have the same least values there. An empty set has none."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        part = (hashes[at : at + CHUNK, None] ^ _MIXED) * _FACTORS
        least = np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0))
    return (least * _FOLDS).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()


def node_of(text: Column) -> Column:
    """A number of the words of a text: equal for texts of the same words, whatever white space and ASCII case."""
    return F.xxhash64(F.trim(F.regexp_replace(ascii_lower(text), r"[ \t\n\x0B\f\r]+", " ")))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """64 * SKETCH parities: bit b tells whether an odd number of the hashes falls on b. Two sketches differ in no more bits
    than their sets in members."""
    bits = np.zeros(64 * SKETCH, np.uint8)
    places, counts = np.unique(hashes.view(np.uint64) % np.uint64(len(bits)), return_counts=True)
    bits[places.astype(np.int64)] = counts & 1
    return np.packbits(bits, bitorder="little").view("<u8")


def candidates(sizes: np.ndarray, sketches: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Pairs (i of left, j of right) that may be similar: sets of sizes a and b with Jaccard similarity s differ in
    (a + b) (1 - s) / (1 + s) members, so pairs whose sketches differ in more bits are none."""
    share = (1 - similarity) / (1 + similarity)
    for at in range(0, len(left), STRIP):
        strip = left[at : at + STRIP]
        apart = np.bitwise_count(sketches[strip, None] ^ sketches[None, right]).sum(axis=2, dtype=np.int64)
        both = sizes[strip, None] + sizes[None, right]
        for i, j in zip(*np.nonzero(apart <= both * share + 1e-9)):
            yield int(strip[i]), int(right[j])


def linked(nodes: Sequence[int], hashes: Sequence[np.ndarray], similarity: float = SIMILARITY, side: Sequence[int] | None = None) -> list[tuple[int, int]]:
    """Links that join every two members of similarity or more into one component, each between two such members.

    hashes are sets as sorted arrays. With sides (0 or 1), only members of different sides are compared. Two members that
    links have already joined are not compared, so a group of near copies takes few comparisons a member; those that
    cannot be similar are told by their sketches, a strip at a time, so a group of others takes no comparison of sets.
    """
    sizes = np.array([len(one) for one in hashes], np.int64)
    root = list(range(len(nodes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def pairs() -> Iterator[tuple[int, int]]:
        if len(nodes) <= FEW:
            yield from ((i, j) for i in range(len(nodes)) for j in range(i) if side is None or side[i] != side[j])
            return
        order = np.argsort(sizes, kind="stable")
        sketches = np.stack([sketch(one) for one in hashes])
        if side is None:
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            yield from ((i, j) for i, j in candidates(sizes, sketches, order, order, similarity) if place[i] < place[j])
        else:
            sides = np.asarray(side)[order]
            yield from candidates(sizes, sketches, order[sides == 0], order[sides == 1], similarity)

    out = []
    for i, j in pairs():
        if find(i) == find(j) or min(sizes[i], sizes[j]) < similarity * max(sizes[i], sizes[j]) - 1e-9:
            continue
        common = len(np.intersect1d(hashes[i], hashes[j], assume_unique=True))
        if common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9:
            root[find(j)] = find(i)
            out.append((nodes[i], nodes[j]))
    return out


def clusters(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """node, band of the nodes (node, fp) whose fingerprint is within radius bits of another's, or the same: one band for
    each component of such links, so any two nodes within radius share it."""
    fps = written(nodes.groupBy("fp").count())
    labels = component_labels(written(links_within(fps.select("fp"), radius))).withColumnRenamed("node", "fp")
    alike = fps.join(labels, "fp", "left").where(F.col("label").isNotNull() | (F.col("count") > 1))
    named = written(alike.select("fp", F.xxhash64(F.lit("fingerprints"), F.coalesce("label", "fp")).alias("band")))
    return nodes.select("node", "fp").join(named, "fp").select("node", "band")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, component_id (the smallest doc_id reachable) of every row of docs (doc_id, text).

    Texts are linked whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, or that have the same
    words. Texts of one word sequence are one node, so copies cost a count. Candidates are the nodes whose SimHash
    fingerprints links within radius bits join, and, for similar texts that lie further apart, those that share a band of
    their MinHash values. Such a component is treated as one more band: bands with the same members are compared once.
    Only texts with a candidate are hashed into sets. The members of a band are dealt into blocks of about BLOCK, and a
    task compares one block with itself or with one other. A null text has no words, like an empty one; a text of fewer
    words than a shingle is one shingle.
    """

    def banded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drop_kept()
        for frame in frames:
            fps, found = np.empty(len(frame), np.uint64), []
            for i, text in enumerate(frame["text"]):
                hashes = shingle_hashes(text, SHINGLE, SEED)
                fps[i] = majority(hashes)
                found.append(bands(np.unique(hashes)))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "node": frame["node"], "fp": fps.view(np.int64), "bands": found})

    def hashed_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [np.unique(shingle_hashes(text, SHINGLE, SEED)).view(np.int64) for text in frame["text"]]
            yield pd.DataFrame({"node": frame["node"], "hashes": found})

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(frames, MEETING):
            starts = np.flatnonzero((frame[MEETING] != frame[MEETING].shift()).any(axis=1))
            nodes, hashes = frame["node"].to_numpy(), frame["hashes"].to_numpy()
            right, apart = (frame["part"] == frame["high"]).to_numpy(int), (frame["low"] != frame["high"]).to_numpy()
            found: list[tuple[int, int]] = []
            for a, b in zip(starts, [*starts[1:], len(frame)]):
                found += linked(nodes[a:b].tolist(), hashes[a:b], similarity, right[a:b] if apart[a] else None)
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of(text_or_empty("text")).alias("node"), "text")
    hashed = written(texts.mapInPandas(banded, "doc_id long, node long, fp long, bands array<long>"))
    nodes = written(hashed.groupBy("node").agg(F.min("doc_id").alias("least"), F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands")))
    laid = nodes.select("node", F.explode("bands").alias("band")).unionByName(clusters(nodes, radius))
    crowds = laid.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("first"), F.bit_xor(F.xxhash64("node")).alias("all")).where("n > 1")
    parts = F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")
    crowds = written(crowds.groupBy("n", "first", "all").agg(F.min("band").alias("band")).select("band", parts))
    members = written(laid.join(crowds, "band"))
    wanted = texts.select("node", "text").join(members.select("node").distinct(), "node", "left_semi")
    sets = written(wanted.groupBy("node").agg(F.any_value("text").alias("text")).mapInPandas(hashed_sets, "node long, hashes array<long>"))
    dealt = members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("node", "band", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    met = met.join(sets, "node").repartition(*MEETING).sortWithinPartitions(*MEETING)
    links = written(met.mapInPandas(compared, "a long, b long"))

    labels = component_labels(links)
    roots = nodes.select("node", "least").join(labels, "node", "left").withColumn("root", F.coalesce("label", "node"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(roots.select("node", "root").join(least, "root").select("node", "component_id"))
    return hashed.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs of one document of each component: see simhash.first_of_each."""
    return first_of_each(docs, near_duplicates(docs, similarity))
