"""Near duplicates by SimHash: fingerprints within a few bits are linked, links grow into components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.llm.components import component_labels
from scolaria.llm.shared import document_columns, whole_rows, written

SHINGLE = 3
SEED = 42
RADIUS = 2
TILE = 4096
CHUNK = 1 << 16


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """A hash of each run of shingle words. bytes.lower() and bytes.split() know ASCII letters and white space only."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    n = max(len(words) - shingle + 1, 1)
    firsts = [0, *(ends[: n - 1] + 1).tolist()]
    lasts = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(firsts, lasts)), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits, each 1 if set in over half the hashes; 0 of none."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a whole text."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id (long) and fp (the fingerprint's 64 bits as a signed long) of every row of docs."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = np.array([fingerprint(text, shingle, seed) for text in frame["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "fp": fps.view(np.int64)})

    return docs.selectExpr("cast(doc_id as long) AS doc_id", "text").mapInPandas(hashed, "doc_id long, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def segments_of(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 segments of the 64 bits. Fingerprints within radius agree on one of them at least."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def tile_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i in left, j in right) of all pairs of two tiles within radius bits, compared strip by strip.

    Both are ordered by their number of ones; a strip meets only those rows whose number of ones is within radius.
    """
    ones_left, ones_right = np.bitwise_count(left), np.bitwise_count(right)
    order_left, order_right = np.argsort(ones_left, kind="stable"), np.argsort(ones_right, kind="stable")
    sorted_ones = ones_right[order_right].astype(np.int16)
    found_i, found_j = [], []
    for at in range(0, len(left), 64):
        strip = order_left[at : at + 64]
        low, high = int(ones_left[strip[0]]) - radius, int(ones_left[strip[-1]]) + radius
        span = order_right[np.searchsorted(sorted_ones, low) : np.searchsorted(sorted_ones, high, side="right")]
        i, j = np.nonzero(np.bitwise_count(left[strip, None] ^ right[None, span]) <= radius)
        found_i.append(strip[i])
        found_j.append(span[j])
    return np.concatenate(found_i or [np.empty(0, int)]), np.concatenate(found_j or [np.empty(0, int)])


def spanning(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """A forest of the graph of pairs (a, b): as few links as hold its components together, each to its smallest member."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    label, left, right = np.arange(len(nodes)), flat[: len(a)], flat[len(a) :]
    while True:
        least = np.minimum(label[left], label[right])
        lower = label.copy()
        np.minimum.at(lower, left, least)
        np.minimum.at(lower, right, least)
        lower = lower[lower]
        if np.array_equal(lower, label):
            break
        label = lower
    for i in np.flatnonzero(label != np.arange(len(nodes))):
        yield int(nodes[label[i]]), int(nodes[i])


def _compared(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links inside each run of equal (segment, bits, tile, other). Rows come sorted by these; a run has two tiles at most."""
    keys = ["segment", "bits", "tile", "other"]
    held: list[pd.DataFrame] = []

    def links(run: pd.DataFrame) -> Iterator[tuple[int, int]]:
        fps, right = run["fp"].to_numpy().view(np.uint64), run["side"].to_numpy()
        if run["tile"].iloc[0] == run["other"].iloc[0]:
            i, j = tile_pairs(fps, fps, radius)
            i, j = i[i < j], j[i < j]
            a, b = fps[i], fps[j]
        else:
            one, two = fps[right == 0], fps[right == 1]
            i, j = tile_pairs(one, two, radius)
            a, b = one[i], two[j]
        return spanning(a.view(np.int64), b.view(np.int64))

    def small_runs(frame: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Runs of one tile and few rows, all at once: each row against the row d further on, d = 1, 2, ..."""
        fps = frame["fp"].to_numpy().view(np.uint64)
        left = np.repeat(starts + sizes, sizes) - np.arange(len(fps)) - 1  # rows after this one in its run
        pairs = []
        for d in range(1, int(sizes.max(initial=1))):
            i = np.flatnonzero(left >= d)
            i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= radius]
            pairs.append(np.stack([fps[i], fps[i + d]], axis=1))
        return np.concatenate(pairs or [np.empty((0, 2), np.uint64)]).view(np.int64)

    def finish(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        new = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(frame)))
        small = (sizes <= 64) & (frame["tile"].to_numpy()[starts] == frame["other"].to_numpy()[starts])
        few = frame[np.repeat(small, sizes)]
        if len(few):
            counts = sizes[small]
            pairs = small_runs(few, np.cumsum(counts) - counts, counts)
            if len(pairs):
                yield pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})
        for start, size in zip(starts[~small], sizes[~small]):
            pairs = list(links(frame.iloc[start : start + size]))
            if pairs:
                yield pd.DataFrame(pairs, columns=["a", "b"])

    for frame in frames:
        if not len(frame):
            continue
        last = frame[keys].iloc[-1]
        open_from = int(np.argmax((frame[keys] == last).all(axis=1).to_numpy()))
        if held and open_from == 0 and (held[0][keys].iloc[0] == last).all():
            held.append(frame)
            continue
        yield from finish(pd.concat([*held, frame.iloc[:open_from]]).reset_index(drop=True)) if held or open_from else ()
        held = [frame.iloc[open_from:]]
    if held:
        yield from finish(pd.concat(held).reset_index(drop=True))


def links_within(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """a, b: links between fingerprints (column fp, each once) that join every two within radius bits into one component.

    Every fingerprint is laid under each of its radius + 1 segments. Rows of one segment value make tiles of about tile
    rows: one by itself where they are few, else tiles by number of ones and hash. Two tiles meet only if their numbers
    of ones are within radius; then all their pairs are compared. Of each large meeting a forest is kept: every member of
    a component there, linked to its smallest.
    """
    laid = distinct.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)).alias("bits")) for i, (shift, width) in enumerate(segments_of(radius))])).alias("at"),
    ).select("fp", "at.segment", "at.bits")
    key = ["segment", "bits"]
    large = written(laid.groupBy(*key).count().where(F.col("count") > tile).drop("count"))
    crowded = written(laid.join(large, key, "left_semi"))
    lone = laid.join(large, key, "left_anti").select("fp", *key, F.lit(0).alias("tile"), F.lit(0).alias("other"), F.lit(0).alias("side"))

    ones = F.bit_count("fp").cast("int")
    tiles = crowded.withColumn("ones", ones).groupBy(*key, "ones").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
    tiles = written(tiles)
    numbered = tiles.select(*key, "ones", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    number = lambda ones, part: (ones.cast("int") * 1_000_000 + part).alias("n")
    near = numbered.select(*key, F.explode(F.sequence("ones", F.col("ones") + radius)).alias("ones"), number(F.col("ones"), F.col("part")).alias("tile"))
    meetings = near.join(numbered.select(*key, "ones", number(F.col("ones"), F.col("part")).alias("other")), [*key, "ones"])
    meetings = meetings.where(F.col("tile") <= F.col("other")).select(*key, "tile", "other")
    placed = crowded.withColumn("ones", ones).join(tiles, [*key, "ones"])
    placed = placed.select("fp", *key, number(F.col("ones"), F.pmod(F.xxhash64("fp"), F.col("parts"))).cast("int").alias("n"))
    sides = meetings.select(*key, "tile", "other", F.explode(F.when(F.col("tile") == F.col("other"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("side"))
    sides = sides.withColumn("n", F.when(F.col("side") == 0, F.col("tile")).otherwise(F.col("other")))
    met = placed.join(sides, [*key, "n"]).select("fp", *key, "tile", "other", "side")

    dealt = lone.unionByName(met).repartition(*key, "tile", "other").sortWithinPartitions(*key, "tile", "other")
    return dealt.mapInPandas(lambda frames: _compared(frames, radius), "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, tile: int = TILE) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable) of every row of docs (doc_id, text).

    A null text has no words, like an empty one; texts without words have fingerprint 0 and are linked like others. A
    text of fewer words than a shingle is one shingle. Rows of one fingerprint are one node, so copies cost a count. A
    null doc_id is never a component_id unless its whole component has none. An empty table gives an empty table.
    """
    hashed = written(fingerprints(docs, shingle, seed))
    nodes = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = written(links_within(nodes.select("fp"), radius, tile))
    labels = component_labels(links)
    roots = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("label", "fp"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(roots.select("fp", "root").join(least, "root").select("fp", "component_id"))
    return hashed.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, tile: int = TILE) -> DataFrame:
    """The rows of docs of one document of each component: see first_of_each."""
    return first_of_each(docs, near_duplicates(docs, radius, shingle, seed, tile))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of docs of one document of each component of found (doc_id, component_id): that with the smallest doc_id.
    Of rows that share this id one stays, with the text of the least hash. Rows without an id can't be told apart and
    stay."""
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("id")).distinct()
    rows = whole_rows(docs).select("doc", F.col("doc.doc_id").cast("long").alias("id"))
    first = rows.join(kept, "id", "left_semi").groupBy("id").agg(F.min_by("doc", F.xxhash64("doc.text")).alias("doc"))
    return document_columns(first.select("doc").unionByName(rows.where(F.col("id").isNull()).select("doc")))
