"""Token ids of a corpus in wavelet-matrix shards: compressed bit planes that answer access, count and occurrence lookups."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scolaria.llm.token_ids import encoder_of
from scolaria.session import shared_folder

MAGIC = b"WVM2"
BLOCK = 512  # bits between two rank samples
SHARD_TOKENS = 1 << 20
BATCH_CHARS = 2_000_000


class WaveletMatrix:
    """A sequence of ids as bit planes, most significant first. Every plane orders the ids for the next one: those with
    bit 0 first, then those with bit 1, each in the order they had. Planes hold one bit an id and a count every BLOCK bits."""

    def __init__(self, size: int, planes: list[np.ndarray]) -> None:
        self.size, self.words = size, planes
        ones = [np.bitwise_count(plane).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64) for plane in planes]
        self.samples = [np.concatenate([[0], np.cumsum(count)]) for count in ones]
        self.zeros = [size - int(sample[-1]) for sample in self.samples]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        level = ids.astype(np.uint16 if len(ids) and ids.max() < 1 << 16 else np.uint32)
        planes = []
        for bit in range(int(level.max()).bit_length() if len(level) else 0)[::-1]:
            mask = (level & level.dtype.type(1 << bit)).astype(bool)
            packed = np.zeros(-(-max(len(level), 1) // BLOCK) * (BLOCK // 8), np.uint8)
            packed[: -(-len(level) // 8)] = np.packbits(mask, bitorder="little")
            planes.append(packed.view("<u8"))
            level = level[np.concatenate([np.flatnonzero(~mask), np.flatnonzero(mask)])]  # places: far quicker than masks
        return cls(len(level), planes)

    def _bits(self, plane: int) -> np.ndarray:
        return np.unpackbits(self.words[plane].view(np.uint8), count=self.size, bitorder="little").view(bool)

    def rank(self, plane: int, end: int) -> int:
        """How many of the plane's first end bits are 1."""
        words, block = self.words[plane], end // BLOCK
        full = words[block * (BLOCK // 64) : end // 64]
        rest = int(words[end // 64]) & ((1 << end % 64) - 1) if end % 64 else 0
        return int(self.samples[plane][block]) + int(np.bitwise_count(full).sum()) + rest.bit_count()

    def select(self, plane: int, bit: int, k: int) -> int:
        """The place of the plane's k-th bit, from 0, of this value."""
        before = self.samples[plane] if bit else np.arange(len(self.samples[plane])) * BLOCK - self.samples[plane]
        block = int(np.searchsorted(before, k, side="right")) - 1
        words = self.words[plane][block * (BLOCK // 64) : (block + 1) * (BLOCK // 64)]
        held = np.unpackbits(words.view(np.uint8), bitorder="little")
        return block * BLOCK + int(np.flatnonzero(held == bit)[k - int(before[block])])

    def access(self, place: int) -> int:
        value = 0
        for plane in range(len(self.words)):
            ones, bit = self.rank(plane, place), int(self.words[plane][place // 64]) >> place % 64 & 1
            value, place = value << 1 | bit, self.zeros[plane] + ones if bit else place - ones
        return value

    def _range(self, value: int) -> tuple[int, int]:
        first, end = 0, self.size
        if value >> len(self.words):
            return 0, 0
        for plane in range(len(self.words)):
            ones, ones_end = self.rank(plane, first), self.rank(plane, end)
            if value >> (len(self.words) - 1 - plane) & 1:
                first, end = self.zeros[plane] + ones, self.zeros[plane] + ones_end
            else:
                first, end = first - ones, end - ones_end
        return first, end

    def count(self, value: int) -> int:
        first, end = self._range(value)
        return end - first

    def occurrence(self, value: int, k: int) -> int:
        """The place of the k-th occurrence, from 0, of value."""
        first, end = self._range(value)
        if not 0 <= k < end - first:
            raise IndexError(f"{value} stands {end - first} times")
        place = first + k
        for plane in reversed(range(len(self.words))):
            bit = value >> (len(self.words) - 1 - plane) & 1
            place = self.select(plane, bit, place - self.zeros[plane] if bit else place)
        return place

    def ids(self) -> np.ndarray:
        """The whole sequence, by undoing the order of each plane from the last to the first."""
        level = np.zeros(self.size, np.uint16 if len(self.words) <= 16 else np.uint32)
        for plane in reversed(range(len(self.words))):
            mask, zeros = self._bits(plane), self.zeros[plane]
            above = np.empty_like(level)
            above[np.flatnonzero(~mask)] = level[:zeros]
            above[np.flatnonzero(mask)] = level[zeros:] | level.dtype.type(1 << (len(self.words) - 1 - plane))
            level = above
        return level.astype(np.uint32)


def shard_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard: magic, counts, then compressed sections (ids of documents, whether they are null, lengths, planes)."""
    matrix = WaveletMatrix.of(ids)
    known = np.array([i is not None for i in doc_ids], bool)
    sections = [np.array([i or 0 for i in doc_ids], "<i8"), np.packbits(known), lengths.astype("<i8"), *matrix.words]
    compressor = zstandard.ZstdCompressor(level=1)
    packed = [compressor.compress(section.tobytes()) for section in sections]
    return MAGIC + struct.pack("<qqi", len(doc_ids), len(ids), len(matrix.words)) + b"".join(struct.pack("<q", len(p)) + p for p in packed)


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Ids of the documents in a shard, their numbers of tokens, and the tokens."""
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    documents, tokens, _ = struct.unpack_from("<qqi", data, 4)
    unpacked, sections, at = zstandard.ZstdDecompressor(), [], 4 + struct.calcsize("<qqi")
    while at < len(data):
        (size,) = struct.unpack_from("<q", data, at)
        sections.append(unpacked.decompress(data[at + 8 : at + 8 + size]))
        at += 8 + size
    known = np.unpackbits(np.frombuffer(sections[1], np.uint8), count=documents)
    ids = [int(i) if k else None for i, k in zip(np.frombuffer(sections[0], "<i8"), known)]
    return ids, np.frombuffer(sections[2], "<i8"), WaveletMatrix(tokens, [np.frombuffer(s, "<u8") for s in sections[3:]])


def batches_of(texts: list[str | None], most_chars: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of texts with about most_chars code points at most; a longer text comes alone."""
    first, chars = 0, 0
    for i, text in enumerate(texts):
        if i > first and chars + len(text or "") > most_chars:
            yield slice(first, i)
            first, chars = i, 0
        chars += len(text or "")
    if first < len(texts):
        yield slice(first, len(texts))


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> str:
    """Writes the ids of all texts, in ascending doc_id order, and returns the folder.

    A row of the folder's table is one shard: part and shard give its place in the order, before the ids that part has
    ahead of it, payload the shard itself (shard_bytes). A document lies in one shard whole; a shard is closed at the
    first document end past shard_tokens ids. Null ids come first; equal ids are ordered by the text's hash, null as empty.
    """

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part = encoder_of(tokenizer_path), TaskContext.get().partitionId()
        shard, before = 0, 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def closed() -> pd.DataFrame:
            nonlocal shard, before, doc_ids, held, size
            row = (part, shard, before, size, shard_bytes(doc_ids, np.array([len(x) for x in held]), np.concatenate(held)))
            shard, before, doc_ids, held, size = shard + 1, before + size, [], [], 0
            return pd.DataFrame([row], columns=["part", "shard", "before", "n_tokens", "payload"])

        for frame in frames:
            texts, keys = frame["text"].tolist(), [None if pd.isna(i) else int(i) for i in frame["doc_id"].astype("Int64")]
            for piece in batches_of(texts):
                ids, starts = encoder.encode(texts[piece])
                for key, first, end in zip(keys[piece], starts[:-1], starts[1:]):
                    doc_ids.append(key)
                    held.append(np.append(ids[first:end], np.uint32(end_id)))
                    size += len(held[-1])
                    if size >= shard_tokens:
                        yield closed()
        if doc_ids:
            yield closed()

    folder = shared_folder(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text").asc()]  # a range's sample goes to the driver: no texts in it
    texts.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInPandas(
        encode, "part int, shard int, before long, n_tokens long, payload binary"
    ).write.parquet(folder)
    return folder


def read_documents(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the shards in folder.

    The only table that is broadcast holds one row for each task that wrote shards.
    """

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part_start, before, payload in zip(frame["part_start"], frame["before"], frame["payload"]):
                doc_ids, lengths, matrix = open_shard(bytes(payload))
                ids = matrix.ids().astype("<u4")
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - lengths, ends)]
                yield pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "start": part_start + before + ends - lengths, "n_tokens": lengths, "ids_crc32": np.array(sums, np.int64)})

    shards = docs.sparkSession.read.schema("part int, shard int, before long, n_tokens long, payload binary").parquet(folder)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("part_tokens").over(ahead), F.lit(0)).alias("part_start"))
    return shards.join(F.broadcast(starts), "part").select("part_start", "before", "payload").mapInPandas(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """write_shards, then read_documents. A null text is an empty one and has the end id alone; repeated rows are stored
    as often as they come; an empty table gives an empty table; other columns are left out."""
    return read_documents(docs, write_shards(docs, tokenizer_path, end_id, shard_tokens))
