"""What each of five filters removes in every order: counted from one word a document that says which subsets it survives."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.llm.shared import written

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10  # words; per cent of words; per cent of code points
SYMBOL = re.compile(rb"[#$%&*|]")
NOT_CAPITAL = bytes(sorted(set(range(256)) - set(range(ord("A"), ord("Z") + 1))))

REPORT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_failures(text: bytes, code_points: int) -> int:
    """The filters A to D that a UTF-8 text fails, one bit each. bytes.split parts at ASCII white space, and at nothing else."""
    words = text.split()
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1
        | (100 * len(text.translate(None, NOT_CAPITAL)) > MAX_CAPITALS * code_points) << 2
        | (SYMBOL.search(text) is not None) << 3
    )


def survival_words() -> np.ndarray:
    """One 32-bit word for each set of failed filters: bit s is 1 if a document survives the subset s of the filters."""
    return np.array([sum(1 << s for s in range(SUBSETS) if not s & fails) for fails in range(SUBSETS)], np.uint32)


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the words have a 1 at each of the 32 places.

    A carry-save adder turns three words of one weight into their sum and a carry of twice the weight, at all places at
    once; when two words or fewer of a weight are left, their bits are counted and the carries follow.
    """
    places = np.arange(32, dtype=np.uint32)
    counts, weight = np.zeros(32, np.int64), 1
    while len(words):
        carries = [words[:0]]
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            half = a ^ b
            carries.append(a & b | half & c)
            words = np.concatenate([half ^ c, words[3 * third :]])
        counts += weight * (words[:, None] >> places & 1).sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries), 2 * weight
    return counts


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, fails of every row of docs (doc_id, text, lang): the failed filters, one bit each from A on.

    E needs the whole table: a text fails it if a row with a smaller doc_id has the same text, by its sha256. A null id
    is neither smaller nor larger than another. Copies are first reduced to the smallest id of a text, in every task
    before the shuffle; the join that follows can be split where one text has many rows.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            digests = [hashlib.sha256(text).digest() for text in frame["text"]]
            fails = [text_failures(text, n) for text, n in zip(frame["text"], frame["code_points"])]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "part": frame["part"], "digest": digests, "fails": np.array(fails, np.int32)})

    texts = F.coalesce("text", F.lit(""))
    plain = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), texts.cast("binary").alias("text"), F.length(texts).alias("code_points"))
    seen = plain.mapInPandas(read, "doc_id string, part string, digest binary, fails int")
    seen = written(seen.withColumn("doc_id", F.col("doc_id").cast("long")))
    copied = seen.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return seen.join(written(copied), "digest", "left").select("doc_id", "part", F.col("fails").bitwiseOR(F.when(copy, 1 << 4).otherwise(0)).alias("fails"))


def survivors(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, label (all, good, toxic), subset, n: the rows of failed that survive each subset of the filters.

    A document is good or toxic if any of its rows in labels (doc_id, quality, toxic) says 1. Every batch of rows becomes
    words and is counted at once, so a task holds a batch and returns 32 counts for each part and label in it.
    """
    table = survival_words()

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = table[frame["fails"].to_numpy()]
            for part, at in frame.groupby("part").indices.items():
                for label, chosen in (("all", None), ("good", "good"), ("toxic", "toxic")):
                    held = words[at] if chosen is None else words[at][frame[chosen].to_numpy(bool)[at]]
                    yield pd.DataFrame({"part": part, "label": label, "subset": np.arange(SUBSETS, dtype=np.int32), "n": positional_popcounts(held)})

    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marked = failed.join(told, "doc_id", "left")
    marked = marked.select("part", "fails", *[F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")])
    return marked.mapInPandas(counted, "part string, label string, subset int, n long").groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))


def part_report(part: str, n: dict[str, np.ndarray]) -> pd.DataFrame:
    """The rows of one part from the survivors of every subset: every order of the filters, every step."""
    rows = []
    every, shapley = SUBSETS - 1, dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            after = before | bit
            lost = {label: int(kept[before] - kept[after]) for label, kept in n.items()}
            shapley[name] += lost["all"]
            failing = int(n["all"][0] - n["all"][bit])
            only = int(n["all"][every ^ bit] - n["all"][every])
            rows.append(["".join(order), step, int(n["all"][after]), lost["all"], failing - lost["all"], only, lost["good"], lost["toxic"]])
            before = after
    names = [column.split()[0] for column in REPORT.split(", ")]
    frame = pd.DataFrame(rows, columns=names[1:-1])
    frame["shapley"] = [shapley[order[step - 1]] for order, step in zip(frame["filter_order"], frame["step"])]
    return frame.assign(part=part)[names]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for every part (lang; null is the empty one), order of the five filters and step in it: see REPORT.

    kept survive the filters up to this step, removed go at it, redundant fail its filter but went before, unique_fails
    fail no other filter; good_lost and toxic_lost are the labelled ones of removed; shapley adds removed of this filter
    over all orders. A null text is an empty one; repeated rows count one by one, and rows that share id and text are not
    copies of each other; a table without rows has no parts; other columns are not read. All figures are differences
    of survivors; a part has 96 of them.
    """

    def reported(group: pd.DataFrame) -> pd.DataFrame:
        n = {label: np.zeros(SUBSETS, np.int64) for label in ("all", "good", "toxic")}
        for label, subset, count in zip(group["label"], group["subset"], group["n"]):
            n[label][subset] = count
        return part_report(group["part"].iloc[0], n)

    return survivors(failures(docs), labels).groupBy("part").applyInPandas(reported, REPORT)
