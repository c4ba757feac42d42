"""Exact duplicates: frequent digests are settled by a broadcast of their winners, all others by a shuffle of digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.llm.shared import ascii_lower, text_or_empty, whole_rows, written

#: Digests that the summary counts at a time, digests broadcast at most, and partial summaries merged before the last one.
TRACKED, HOT, BRANCHES = 4096, 1000, 64


def text_digest(text: Column) -> Column:
    """Hex sha256 of the text with A-Z in lower case: equal for equal texts. A collision is not looked for."""
    return F.sha2(ascii_lower(text), 256)


def frequent_digests(hashed: DataFrame, tracked: int = TRACKED, hot: int = HOT) -> DataFrame:
    """text_sha256 of hot rows at most: those that may be frequent in hashed (text_sha256).

    The summary behind approx_top_k is that of Misra and Gries: a bounded table of counters, and once it is full every
    counter loses the same amount and those at zero go. It never misses a digest with more than 3.5 / tracked of all
    rows. Tasks summarise what they read, BRANCHES tasks merge these summaries, one merges the branches.
    """
    branches = hashed.groupBy((F.spark_partition_id() % BRANCHES).alias("branch")).agg(F.expr(f"approx_top_k_accumulate(text_sha256, {tracked})").alias("summary"))
    one = F.lit(0).alias("one")  # grouped, as without rows there is no summary to merge
    merged = branches.groupBy(one).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {tracked}), {hot})").alias("found"))
    return merged.select(F.explode("found").alias("found")).where("found.count > 1").select(F.col("found.item").alias("text_sha256"))


def _winners(hashed: DataFrame) -> DataFrame:
    grouped = hashed.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size"))
    return grouped.select("text_sha256", F.col("last.doc_id").alias("keep_id"), F.col("last.row").alias("keep_row"), "group_size")


def _marked(hashed: DataFrame, tracked: int, hot: int) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept, text_sha256 of every row of the written table hashed (row, doc_id, text_sha256).

    The sketch only proposes digests; their winners and sizes are counted from all rows before they are broadcast.
    """
    candidates = written(frequent_digests(hashed, tracked, hot))
    winners = written(_winners(hashed.join(F.broadcast(candidates), "text_sha256", "left_semi")))
    heavy = hashed.join(F.broadcast(winners), "text_sha256")
    light = hashed.join(F.broadcast(winners), "text_sha256", "left_anti")
    groups = written(_winners(light).where("group_size > 1"))
    rest = light.join(groups, "text_sha256", "left")
    rest = rest.select(
        "text_sha256", "doc_id", "row",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("keep_row", "row").alias("keep_row"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
    )
    every = heavy.unionByName(rest)
    return every.select("row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, tracked: int = TRACKED, hot: int = HOT) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs (doc_id, text), those that go included.

    Texts are equal when they are the same after A-Z became a-z; a null text is an empty one. Of equal texts the row
    with the largest doc_id stays; a null id is less than any other, and a group of null ids has a null keep_id. Rows
    that repeat an id and a text are counted one by one, and exactly one of them stays. An empty table gives an empty
    table; other columns are left out.

    The text is read once, to write its digest; every later step reads the narrow table of digests.
    """
    hashed = docs.select("doc_id", text_digest(text_or_empty("text")).alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
    return _marked(written(hashed), tracked, hot).drop("row")


def without_duplicates(docs: DataFrame, tracked: int = TRACKED, hot: int = HOT) -> DataFrame:
    """The rows of docs that exact_duplicates keeps, with all their columns."""
    rows = written(whole_rows(docs).select("doc", text_digest(text_or_empty()).alias("text_sha256"), F.monotonically_increasing_id().alias("row")))
    losers = _marked(rows.select("row", F.col("doc.doc_id").alias("doc_id"), "text_sha256"), tracked, hot).where(~F.col("kept")).select("row")
    return rows.join(losers, "row", "left_anti").select("doc.*")
