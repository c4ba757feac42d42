"""Benchmark passages in documents: item-sized windows are found by SimHash and verified by their shingles."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.llm.shared import document_columns, drop_kept, row_key, whole_rows, written
from scolaria.llm.simhash import segments_of

WORD = re.compile(r"\w+")
SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 16
BLOCK_ITEMS = 20_000
REGION_WORDS = 50_000
MATCHES = "array<struct<item_id:long,similarity:double,distance:int,first_word:long,n_words:long>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingle_counts(ids: list[int], shingle: int = SHINGLE) -> Counter:
    """How often each run of shingle words stands in ids; fewer words are one shingle."""
    return Counter(tuple(ids[i : i + shingle]) for i in range(max(len(ids) - shingle + 1, 1))) if ids else Counter()


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the lesser counts over the sum of the greater ones."""
    least = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return least / max(sum(a.values()) + sum(b.values()) - least, 1)


class HammingBlocks:
    """Fingerprints under each of radius + 1 blocks of their bits: one within radius of a query shares a block with it."""

    def __init__(self, fps: np.ndarray, radius: int) -> None:
        self.fps, self.radius, self.blocks = fps, radius, []
        for shift, width in segments_of(radius):
            values = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            order = np.argsort(values, kind="stable")
            self.blocks.append((np.uint64(shift), np.uint64((1 << width) - 1), order, values[order]))

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and distance of every pair within radius."""
        codes = []
        for shift, mask, order, values in self.blocks:
            wanted = (queries >> shift) & mask
            first, end = np.searchsorted(values, wanted), np.searchsorted(values, wanted, side="right")
            sizes = end - first
            ends = np.cumsum(sizes)
            places = order[np.repeat(first - (ends - sizes), sizes) + np.arange(sizes.sum())]
            codes.append(np.repeat(np.arange(len(queries)), sizes) * len(self.fps) + places)
        query, place = np.divmod(np.unique(np.concatenate(codes)), len(self.fps))
        distance = np.bitwise_count(queries[query] ^ self.fps[place]).astype(np.int64)
        close = distance <= self.radius
        return query[close], place[close], distance[close]


def _votes(words: list[str]) -> np.ndarray:
    """Running sums of the words' hash bits: row i has the votes of the first i words."""
    hashes = np.array([xxhash.xxh64_intdigest(word) for word in words], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def _fingerprints(votes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return np.packbits(2 * (votes[starts + size] - votes[starts]) > size, axis=1, bitorder="little").view("<u8").ravel()


class BenchmarkIndex:
    """Items by length, each length with the fingerprints of its items in Hamming blocks."""

    def __init__(self, items: Iterable[tuple[int, str | None]], similarity: float = SIMILARITY, radius: int = RADIUS, shingle: int = SHINGLE) -> None:
        self.similarity, self.shingle = similarity, shingle
        self.vocabulary: dict[str, int] = {}
        self.multipliers = np.random.default_rng(5).integers(1, 1 << 63, shingle, np.uint64) * np.uint64(2) + np.uint64(1)
        by_size: dict[int, list] = {}
        sizes_of: dict[int, set[int]] = {}
        self.short: dict[tuple[int, ...], list[int]] = {}
        for item_id, text in items:
            words = words_of(text)
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words]
            if len(ids) < shingle:
                if ids:
                    self.short.setdefault(tuple(ids), []).append(item_id)
                continue
            by_size.setdefault(len(ids), []).append((item_id, shingle_counts(ids, shingle), _fingerprints(_votes(words), np.array([0]), len(words))[0]))
            for key in self._keys(np.array(ids)).tolist():
                sizes_of.setdefault(key, set()).add(len(ids))
        self.items = {size: [(i, counts) for i, counts, _ in found] for size, found in by_size.items()}
        self.blocks = {size: HammingBlocks(np.array([fp for *_, fp in found], np.uint64), radius) for size, found in by_size.items()}
        self.keys = np.array(sorted(sizes_of), np.uint64)
        self.sizes_of = [sizes_of[key] for key in self.keys.tolist()]
        self.short_sizes = sorted({len(ids) for ids in self.short})

    def _keys(self, ids: np.ndarray) -> np.ndarray:
        """A number for each run of shingle words."""
        n = len(ids) - self.shingle + 1
        return sum(ids[k : k + n].astype(np.uint64) * m for k, m in enumerate(self.multipliers))

    def _anchors(self, ids: np.ndarray) -> dict[int, np.ndarray]:
        """For each item length, the places of shingles that an item of that length has."""
        if len(ids) < self.shingle or not len(self.keys):
            return {}
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        places = np.flatnonzero(known[self.shingle :] - known[: -self.shingle] == self.shingle)
        if not len(places):
            return {}
        keys = self._keys(ids)[places]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hits = self.keys[at] == keys
        found: dict[int, list[int]] = {}
        for place, key in zip(places[hits].tolist(), at[hits].tolist()):
            for size in self.sizes_of[key]:
                found.setdefault(size, []).append(place)
        return {size: np.array(places) for size, places in found.items()}

    def matches(self, text: str | None) -> list[tuple[int, float, int, int, int]]:
        """item_id, similarity, distance, first word and words of the best window of every item that the text holds.

        A window without a shingle of an item has similarity 0 to it, so windows are fingerprinted only where they cover a
        shingle that some item of their length has. A text of fewer words than such an item is one window, and is held
        against all items of that length by their shingles, at any distance.
        """
        words = words_of(text)
        ids = np.fromiter((self.vocabulary.get(word, -1) for word in words), np.int64, len(words))
        best: dict[int, tuple] = {}
        for size, places in self._anchors(ids).items():
            if len(words) < size:
                self._compare_whole(words, ids, size, best)
                continue
            # Starts of windows over a shared shingle, in regions of bounded length.
            starts = np.unique((places[:, None] - np.arange(size - self.shingle + 1)).ravel())
            starts = starts[(starts >= 0) & (starts + size <= len(words))]
            cuts = np.flatnonzero((np.diff(starts) > size) | (np.diff(starts // REGION_WORDS) > 0)) + 1
            for region in np.split(starts, cuts):
                if len(region):
                    self._compare(words, ids, region, size, best)
        for size in self.short_sizes:
            for start in np.flatnonzero(ids[: max(len(ids) - size + 1, 0)] >= 0).tolist():
                for item_id in self.short.get(tuple(ids[start : start + size].tolist()), ()):
                    best.setdefault(item_id, (item_id, 1.0, 0, start, size))
        return [best[item_id] for item_id in sorted(best)]

    def _compare_whole(self, words: list[str], ids: np.ndarray, size: int, best: dict[int, tuple]) -> None:
        if len(ids) - self.shingle + 1 < self.similarity * (size - self.shingle + 1) - 1e-9:
            return  # too few shingles to be similar
        counts, fp = shingle_counts(ids.tolist(), self.shingle), _fingerprints(_votes(words), np.array([0]), len(words))[0]
        for (item_id, wanted), item_fp in zip(self.items[size], self.blocks[size].fps):
            found = weighted_similarity(counts, wanted)
            if found >= self.similarity and (item_id not in best or (-found, 0) < (-best[item_id][1], best[item_id][3])):
                best[item_id] = (item_id, found, int(np.bitwise_count(fp ^ item_fp)), 0, len(words))

    def _compare(self, words: list[str], ids: np.ndarray, starts: np.ndarray, size: int, best: dict[int, tuple]) -> None:
        base = int(starts[0])
        votes = _votes(words[base : int(starts[-1]) + size])
        query, place, distance = self.blocks[size].near(_fingerprints(votes, starts - base, size))
        counts: dict[int, Counter] = {}
        for q, p, d in zip(query.tolist(), place.tolist(), distance.tolist()):
            item_id, wanted = self.items[size][p]
            start = int(starts[q])
            if start not in counts:
                counts[start] = shingle_counts(ids[start : start + size].tolist(), self.shingle)
            found = weighted_similarity(counts[start], wanted)
            if found >= self.similarity and (item_id not in best or (-found, start) < (-best[item_id][1], best[item_id][3])):
                best[item_id] = (item_id, found, d, start, size)


def benchmark_blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> Iterator[list[tuple[int, str | None]]]:
    """The benchmark's items in blocks of about block_items, dealt by hash; only one is on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    blocks = max(1, -(-items.count() // block_items))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [(row[0], row[1]) for row in part.toLocalIterator()]


def _matcher(index: Broadcast) -> Callable[[Column], Column]:
    names = ("item_id", "similarity", "distance", "first_word", "n_words")

    @F.pandas_udf(MATCHES)
    def matched(texts: pd.Series) -> pd.Series:
        drop_kept()
        return pd.Series([[dict(zip(names, match)) for match in index.value.matches(text)] for text in texts], dtype=object)

    return matched


def _matched_rows(docs: DataFrame, block: list[tuple[int, str | None]], similarity: float, radius: int) -> DataFrame:
    """row, matches of the texts of docs that hold an item of the block, written; the block's index is dropped again."""
    index = docs.sparkSession.sparkContext.broadcast(BenchmarkIndex(block, similarity, radius))
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), _matcher(index)(F.col("text")).alias("matches"))
    found = written(rows.where(F.size("matches") > 0).dropDuplicates(["row"]))
    index.destroy()
    return found


def find_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc and matches (possibly empty) for every row of docs (doc_id, text).

    A match is an item (item_id, text) of which a window of the item's number of words has similarity or more: weighted
    by counts, over shingles of five words in lower case. Words are runs of letters, digits and underscores, so case,
    punctuation and line ends don't hide a passage. An item of fewer words matches where exactly they stand; an item
    without words, or a null text on either side, never matches. Of one item the most similar window is reported, the
    first of equals. Repeated rows and items match one by one; an empty benchmark matches nothing.

    A benchmark of up to block_items items is one index, broadcast. A larger one takes a pass over the texts for each block;
    what a pass found is written, and its index dropped, before the next one is made, so memory holds one block.

    A text of fewer words than an item is compared with it as a whole, by its shingles alone. Other windows are found if
    they are within radius bits of the item. With one end replaced as far as 0.8 allows, 3 of 3000 simulated windows of
    the test tables' items were beyond 16 bits (17 to 19), so a match at the threshold may be missed.
    """
    rows = whole_rows(docs)
    blocks = benchmark_blocks(benchmark, block_items)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        index = docs.sparkSession.sparkContext.broadcast(BenchmarkIndex(first, similarity, radius))
        return rows.withColumn("matches", _matcher(index)(F.col("doc.text")))
    found = _matched_rows(docs, first, similarity, radius)
    for block in chain([second], blocks):
        found = found.unionByName(_matched_rows(docs, block, similarity, radius))
    of_row = found.groupBy("row").agg(F.sort_array(F.flatten(F.collect_list("matches"))).alias("found"))
    keyed = rows.withColumn("row", row_key(F.col("doc.doc_id"), F.col("doc.text")))
    return keyed.join(of_row, "row", "left").select("doc", F.coalesce("found", F.array().cast(MATCHES)).alias("matches"))


def without_contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that hold no benchmark item, as find_contamination sees it."""
    return document_columns(find_contamination(docs, benchmark, **options).where(F.size("matches") == 0).select("doc"))
