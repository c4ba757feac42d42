"""Documents packed into token windows by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from scolaria.llm.token_ids import encoder_of
from scolaria.llm.token_store import batches_of

WINDOW = 2048
MAX_OPEN = 4096
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: A piece: id of its document, ids of that document before it, its ids, all ids of that document.
Piece = tuple[int | None, int, np.ndarray, int]


class SumOfSquares:
    """Windows of one stream of documents. levels[h] counts the partially filled windows that hold h ids.

    A document's full windows stand alone. Its rest goes, whole, to the level that leaves the least sum of squared
    counts, the fullest one of equals; level 0 opens a window. A window that is full is closed. With more than max_open
    partial windows, and at the end, the partial ones are poured together: the emptiest are cut to fill the fullest, and
    what is left, less than a window, is cut at powers of two, which need no padding.
    """

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN) -> None:
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0

    def _level(self, size: int) -> int:
        above, below = self.levels[size:], self.levels[: self.window - size + 1]
        cost = 2 * (above - below) + 2
        cost[0] -= 1  # no window of level 0 goes
        cost[-1] -= 1  # a full window isn't counted
        usable = below > 0
        usable[0] = True
        cost[~usable] = np.iinfo(np.int64).max
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[Piece]]:
        """The windows that this document closes."""
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            yield [(doc_id, start, ids[start : start + self.window], len(ids))]
        size = len(ids) - whole
        if not size:
            return
        level = self._level(size)
        pieces = self.open[level].pop() if level else []
        pieces.append((doc_id, whole, ids[whole:].copy(), len(ids)))
        if level:
            self.levels[level] -= 1
            self.n_open -= 1
        if level + size == self.window:
            yield pieces
            return
        self.levels[level + size] += 1
        self.n_open += 1
        self.open.setdefault(level + size, []).append(pieces)
        if self.n_open > self.max_open:
            yield from self.flush()

    def flush(self) -> Iterator[list[Piece]]:
        """All partial windows, poured together."""
        partial = [pieces for level in sorted(self.open, reverse=True) for pieces in self.open[level]]
        self.levels[:] = 0
        self.open, self.n_open = {}, 0
        window: list[Piece] = []
        room = self.window
        first, last = 0, len(partial) - 1
        rest: list[Piece] = []
        while first <= last or rest:
            if not window and first <= last:  # the fullest window left
                window, first = partial[first], first + 1
                room = self.window - sum(len(ids) for _, _, ids, _ in window)
                continue
            if not rest:  # the emptiest
                rest, last = partial[last][::-1], last - 1
            doc_id, start, ids, total = rest.pop()
            window.append((doc_id, start, ids[:room], total))
            if len(ids) > room:
                rest.append((doc_id, start + room, ids[room:], total))
            room -= len(window[-1][2])
            if not room:
                yield window
                window, room = [], self.window
        size = self.window
        while window:
            size //= 2
            if sum(len(ids) for _, _, ids, _ in window) >= size:
                head, window = _split(window, size)
                yield head


def _split(pieces: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
    head: list[Piece] = []
    tail: list[Piece] = []
    for doc_id, start, ids, total in pieces:
        if size:
            head.append((doc_id, start, ids[:size], total))
        if len(ids) > size:
            tail.append((doc_id, start + size, ids[size:], total))
        size = max(0, size - len(ids))
    return head, tail


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW, max_open: int = MAX_OPEN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every row of docs (doc_id, text).

    A document's ids are those of its whole text, then end_id; a null text is an empty one and has end_id alone. Each
    partition of docs is packed as one stream, without a shuffle: sequence ids start at the partition's number times 2^33,
    so they are unique and the same when a lost task runs again. Equal rows are packed one by one; an empty table gives
    none; other columns are left out. Memory holds a batch of texts and max_open partial windows.
    """

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, streams = encoder_of(tokenizer_path), SumOfSquares(window, max_open)
        sequence = TaskContext.get().partitionId() << 33
        names = [column.split()[0] for column in SCHEMA.split(", ")]
        rows: list[tuple] = []

        def note(windows: Iterator[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in windows:
                offset = 0
                for doc_id, start, ids, total in pieces:
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset))
                    offset += len(ids)
                sequence += 1

        def frame_of() -> pd.DataFrame:
            frame = pd.DataFrame(rows, columns=names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            rows.clear()
            return frame

        for frame in frames:
            texts, keys = frame["text"].tolist(), [None if pd.isna(i) else int(i) for i in frame["doc_id"].astype("Int64")]
            for piece in batches_of(texts):
                ids, starts = encoder.encode(texts[piece])
                for key, first, end in zip(keys[piece], starts[:-1], starts[1:]):
                    note(streams.add(key, np.append(ids[first:end], np.uint32(end_id))))
                yield frame_of()
        note(streams.flush())
        yield frame_of()

    return docs.selectExpr("cast(doc_id as long) AS doc_id", "text").mapInPandas(packed, SCHEMA)
