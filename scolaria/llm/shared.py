"""What several operators need: rows kept whole beside derived columns, keys of rows, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.session import shared_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_SPACE = " \t\n\x0b\x0c\r"


T = TypeVar("T")
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps from one of its tasks to the next: one object, made when it is first asked for.

    Workers live on through all stages of an application, so whoever asks for another name has the last one dropped.
    """
    if name not in _KEPT:
        drop_kept()
        _KEPT[name] = make()
    return _KEPT[name]


def drop_kept() -> None:
    """For tasks that keep nothing: frees what an earlier stage has left in their worker."""
    _KEPT.clear()


def written(frame: DataFrame) -> DataFrame:
    """frame as a table in the shared folder: its lineage ends there, so a lost executor costs a read and no recomputation."""
    path = shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def whole_runs(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of frames that are sorted by keys, cut so that rows of equal keys come in one frame."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = frame[keys].iloc[-1]
        others = np.flatnonzero((frame[keys] != last).any(axis=1).to_numpy())
        first = int(others[-1]) + 1 if len(others) else 0
        if held and not first and (held[-1][keys].iloc[-1] == last).all():
            held.append(frame)
            continue
        if held or first:
            yield pd.concat([*held, frame.iloc[:first]], ignore_index=True)
        held = [frame.iloc[first:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def whole_rows(frame: DataFrame) -> DataFrame:
    """One struct column doc holding every input column, so that derived columns cannot clash with them."""
    return frame.select(F.struct(*[F.col(f"`{name}`") for name in frame.columns]).alias("doc"))


def text_or_empty(column: str = "doc.text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def row_key(doc_id: Column, text: Column) -> Column:
    """A digest of id and text: rows that share it are equal to every operator here."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("")))))


def document_columns(frame: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of the doc struct again; text, if given, replaces the text, and n_chars follows it."""
    fields = frame.schema["doc"].dataType
    out = {field.name: F.col(f"doc.`{field.name}`") for field in fields}
    if text is not None:
        out["text"] = text
        if "n_chars" in out:
            out["n_chars"] = F.length(text).cast(fields["n_chars"].dataType)
    return frame.select(*[column.alias(name) for name, column in out.items()])
