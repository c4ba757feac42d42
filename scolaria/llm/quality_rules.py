"""Quality rules as a cascade: the rule that rejects most for its cost is asked first, the rest only of what is left."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.llm.shared import ASCII_SPACE, text_or_empty, whole_rows, written

WINDOW = 8
SAMPLE_ROWS, SEED = 2000, 7
#: How often a rule is evaluated on each row of the sample, and how often its time is taken, of which the least counts.
COPIES, RUNS = 50, 3


@dataclass(frozen=True)
class Rule:
    """rejects: a condition on the columns of base_counts that is true for a document to reject."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-12)


def _letters(kind: str) -> Column:
    return F.length(F.regexp_replace(text_or_empty(), rf"[^\p{{{kind}}}]+", ""))


def default_rules() -> list[Rule]:
    """Rules beyond the base ones. Each one is total: a text without words, lines or letters is never rejected by a ratio."""
    return [
        Rule("symbols", 10 * F.col("n_symbols") > 3 * F.col("n_words")),
        Rule("duplicate_lines", 2 * F.col("n_dup_lines") > F.col("n_word_lines")),
        Rule("word_length", (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
        Rule("shouting", 2 * _letters("Lu") > _letters("L")),
        Rule("exclamations", 10 * (F.length(text_or_empty()) - F.length(F.translate(text_or_empty(), "!", ""))) > 3 * F.col("n_words")),
        Rule("no_letters", 2 * _letters("L") < F.col("word_chars")),
    ]


def base_counts(docs: DataFrame) -> DataFrame:
    """doc, n_words, word_chars, n_symbols, n_word_lines, n_dup_lines, n_repeat_words (long) and base_failed for every row.

    Words are runs without ASCII white space; a null text has none. n_repeat_words counts the words inside 8-word windows
    that stand twice or more in the text. A window is known by a 64-bit hash of its words' hashes.
    """
    rows = whole_rows(docs).select("doc", F.translate(text_or_empty(), ASCII_SPACE, " " * len(ASCII_SPACE)).alias("plain"), F.split(text_or_empty(), "\n", -1).alias("lines"))
    rows = rows.select(
        "doc",
        F.filter(F.split("plain", " ", -1), lambda word: word != "").alias("words"),
        F.filter("lines", lambda line: F.btrim(line, F.lit(ASCII_SPACE)) != "").alias("lines"),
        F.length(F.translate("plain", " ", "")).cast("long").alias("word_chars"),
    )
    rows = rows.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))
    last = F.size("hashes") - WINDOW  # start of the last window, from 0
    windows = F.when(last >= 1, F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))).otherwise(F.array().cast("array<long>"))
    rows = rows.select("doc", "words", "lines", "word_chars", windows.alias("windows"))
    placed = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda window, i: F.struct(window.alias("window"), i.alias("place")))),
    ).otherwise(F.array().cast("array<struct<window:long,place:int>>"))
    rows = rows.select("doc", "words", "lines", "word_chars", placed.alias("placed"))
    same = lambda i, window: F.coalesce(F.get("placed", i)["window"] == window, F.lit(False))
    repeated = F.filter("placed", lambda item, i: same(i - 1, item["window"]) | same(i + 1, item["window"]))
    rows = rows.select("doc", "words", "lines", "word_chars", F.sort_array(F.transform(repeated, lambda item: item["place"])).alias("places"))
    covered = F.transform("places", lambda place, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - place, F.lit(WINDOW))))
    counted = rows.select(
        "doc",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        (F.length(text_or_empty()) - F.length(F.translate(text_or_empty(), "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_word_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0), lambda total, words: total + words).cast("long").alias("n_repeat_words"),
    )
    return counted.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def estimates(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, copies: int = COPIES) -> list[Estimate]:
    """Seconds a row and share of rejected rows of each rule on a sample of about sample_rows rows.

    Every row is taken with the same probability where it lies, so no text moves, and a hot id is sampled like others. A
    rule is timed over copies of the sample, above the time of a job that reads the same columns without the rule. The
    sample only sets the order of the cascade; which rows are kept doesn't depend on it. The counts are written before
    they are filtered: a condition pushed below them would carry their whole expressions along.
    """
    fraction = min(1.0, sample_rows / max(docs.count(), 1))
    sample = written(base_counts(docs.sample(fraction, SEED)))
    left = sample.where(~F.col("base_failed"))
    shares = left.agg(F.count(F.lit(1)), *[F.count_if(rule.rejects) for rule in rules]).first()
    rows = shares[0]
    repeated = left.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    counts = ("n_words", "word_chars", "n_symbols", "n_word_lines", "n_dup_lines", "copy")
    reading = [F.sum(F.length(text_or_empty())), *[F.sum(name) for name in counts]]

    def seconds(*more: Column) -> float:
        times = []
        for _ in range(RUNS):
            frame = repeated.agg(*reading, *more)  # a new one, as a frame keeps what it has shuffled
            began = time.perf_counter()
            frame.collect()
            times.append(time.perf_counter() - began)
        return min(times)

    nothing = seconds()
    above = [max(seconds(F.count_if(rule.rejects)) - nothing, 0.0) for rule in rules]
    return [Estimate(rule.name, spent / max(rows * copies, 1), rejected / max(rows, 1)) for rule, spent, rejected in zip(rules, above, shares[1:])]


def cascade(counted: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """counted with rejected_by: base, the name of the first rule that rejects, or null. Later rules are not evaluated then."""
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(rule.rejects, F.lit(rule.name))
    return counted.withColumn("rejected_by", verdict)


def apply_rules(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """base_counts with rejected_by, by the cascade in the order of rejections per second on the sample.

    A null or empty text has no words, so it fails the base rule; an empty table gives an empty table; equal rows get
    equal verdicts; ties of worth keep the order of rules. rejected_by names one of the rules that reject a row; which
    one follows the measured order, whether there is one does not.
    """
    rules = list(default_rules() if rules is None else rules)
    worth = {found.name: found.worth for found in estimates(docs, rules, sample_rows)}
    return cascade(base_counts(docs), sorted(rules, key=lambda rule: -worth[rule.name]))
