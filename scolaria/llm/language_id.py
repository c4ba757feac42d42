"""Language of web pages: the text's likelihood, the declared language, the address suffix and the host's prior in one posterior."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scolaria.llm.html_text import blocks_of, host_of
from scolaria.llm.shared import written

LETTERS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 15
MAX_WORDS_KEPT = 200_000
SAMPLE_PER_LANGUAGE = 1000
ALPHA = 0.5  # added to each n-gram's count
TEMPER = 0.1  # n-grams overlap, so each counts as this part of an independent one
KAPPA = 5.0  # pages that a level's parent stands for
ADDED = 1.0  # pages added to each evidence table, dealt by the evidence's share of all pages
DECLARED = r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})(?![a-z])"""


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of hashed letter n-grams, a row for each language."""

    languages: tuple[str, ...]
    logs: np.ndarray

    def posterior(self, text: str) -> np.ndarray:
        """Share of each language by the text alone; a text without letters says nothing."""
        scores = TEMPER * self.logs[:, grams(text)].sum(axis=1)
        odds = np.exp(scores - scores.max())
        return odds / odds.sum()


_KNOWN: dict[str, list[int]] = {}  # words of this process and their buckets


def _buckets(word: str) -> list[int]:
    found = _KNOWN.get(word)
    if found is None:
        if len(_KNOWN) >= MAX_WORDS_KEPT:
            _KNOWN.clear()
        marked = f"_{word}_"
        runs = [*word, *(marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1))]
        found = _KNOWN[word] = [zlib.crc32(run.encode()) % BUCKETS for run in runs]
    return found


def grams(text: str | None) -> np.ndarray:
    """Hash buckets of the one to three letter runs of every word, its ends marked; whole text, lower case."""
    found: list[int] = []
    for word in LETTERS.findall((text or "").lower()):
        found += _buckets(word)
    return np.array(found, np.int64)


def train_text_model(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> TextModel:
    """Counts over sample different texts of documents (text, lang) of each language, those with the least hashes.

    Rows without text or language are left out. Every language that has a text is learned, from sample texts at most; a
    text is read once, and counts as often as it has copies. What reaches the driver has BUCKETS rows for each language at most, what is
    broadcast to choose the sample as many hashes as are taken.
    """

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for frame in frames:
            for language, text, copies in zip(frame["lang"], frame["text"], frame["copies"]):
                counts.setdefault(language, np.zeros(BUCKETS, np.int64))
                counts[language] += copies * np.bincount(grams(text), minlength=BUCKETS)
        for language, count in counts.items():
            there = np.flatnonzero(count)
            yield pd.DataFrame({"lang": language, "bucket": there, "n": count[there]})

    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.xxhash64("text").alias("hash"), "text")
    least = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    taken = written(labelled.select("lang", "hash").distinct().withColumn("place", least).where(F.col("place") <= sample).select("lang", "hash"))
    chosen = labelled.join(F.broadcast(taken), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    found = chosen.mapInPandas(counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    counts = np.full((len(languages), BUCKETS), ALPHA)
    counts[[languages.index(x) for x in found["lang"]], found["bucket"].to_numpy(int)] += found["n"].to_numpy(float)
    return TextModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts)


def _sums(languages: tuple[str, ...]) -> Column:
    """The expected number of pages of each language."""
    return F.array(*[F.sum(F.get("shares", F.lit(i))) for i in range(len(languages))])


def _smoothed(own: Column, parent: Column) -> Column:
    """Shares at one level of the address, drawn towards the level above by KAPPA pages of it."""
    total = F.aggregate(own, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(own, parent, lambda count, share: (count + KAPPA * share) / (total + KAPPA))


def _without(total: str) -> Column:
    """A level's counts without this page's own part."""
    return F.zip_with(total, "shares", lambda a, b: F.greatest(a - b, F.lit(0.0)))


def _likelihood(given: Column, each: Column, share: Column) -> Column:
    """Of each language: the share of its pages that have this evidence, ADDED pages of the evidence's own share added."""
    return F.zip_with(given, each, lambda n, total: (n + ADDED * share) / (total + ADDED))


def identify_languages(pages: DataFrame, docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """page_id, url, lang, confidence, text_lang, declared of every row of pages (page_id, url, html).

    Languages are those of docs.lang. Text likelihoods come from a letter n-gram model of a sample of docs; they give each
    page its shares by text. Summed over all pages, these make tables: pages by declared language (the html element's
    lang; one that isn't a language here is "other", none is "none"), by address suffix (the host's last label), by
    domain (its last two) and by host. The posterior is text x P(declared | language) x P(suffix | language) x prior,
    where the prior of a host leans on that of its domain, and that on all pages, and leaves the page itself out.

    A page without text rests on the rest; a null url is host ""; ties go to the first language by name; without any
    labelled document lang is null. Repeated rows count as so many pages. Other columns are left out.
    """
    model = train_text_model(docs, sample)
    languages = model.languages
    if not languages:
        nothing = F.lit(None).cast("string")
        return pages.select("page_id", "url", nothing.alias("lang"), F.lit(None).cast("double").alias("confidence"), nothing.alias("text_lang"), nothing.alias("declared"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def by_text(htmls: pd.Series) -> pd.Series:
        texts = ["\n".join(article or loose) for article, loose in map(blocks_of, htmls)]
        return pd.Series([shared.value.posterior(text) for text in texts], dtype=object)

    named = F.array(*[F.lit(language) for language in languages])
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), DECLARED, 1))
    host = host_of(F.col("url"))
    labels = F.split(host, r"\.")
    read = written(
        pages.select(
            "page_id", "url", host.alias("host"), F.element_at(labels, -1).alias("suffix"),
            F.array_join(F.slice(F.reverse(labels), 1, 2), ".").alias("domain"),
            F.when(declared == "", "none").when(F.array_contains(named, declared), declared).otherwise("other").alias("declared"),
            by_text(F.coalesce("html", F.lit(""))).alias("shares"),
        )
    )
    totals = [n or 0.0 for n in read.agg(_sums(languages)).first()[0]]
    all_pages, total = F.array(*[F.lit(n) for n in totals]), F.lit(sum(totals))
    by_declared = read.groupBy("declared").agg(_sums(languages).alias("of_declared"), F.count("*").alias("n_declared"))
    by_suffix = read.groupBy("suffix").agg(_sums(languages).alias("of_suffix"), F.count("*").alias("n_suffix"))
    by_domain = read.groupBy("domain").agg(_sums(languages).alias("of_domain"))
    hosts = read.groupBy("host", "domain", "suffix").agg(_sums(languages).alias("of_host"))
    hosts = written(hosts.join(by_domain, "domain").join(by_suffix, "suffix").drop("domain", "suffix"))
    # What is broadcast has one row for each language, "other" and "none".
    joined = read.join(hosts, "host").join(F.broadcast(by_declared), "declared")
    everywhere = F.array(*[F.lit((n + 1 / len(languages)) / (sum(totals) + 1)) for n in totals])
    prior = _smoothed(_without("of_host"), _smoothed(_without("of_domain"), everywhere))
    evidence = joined.select(
        "page_id", "url", "declared", "shares", prior.alias("prior"),
        _likelihood(F.col("of_declared"), all_pages, F.col("n_declared") / total).alias("for_declared"),
        _likelihood(F.col("of_suffix"), all_pages, F.col("n_suffix") / total).alias("for_suffix"),
    )
    product = F.array(*[F.get("shares", F.lit(i)) * F.get("prior", F.lit(i)) * F.get("for_declared", F.lit(i)) * F.get("for_suffix", F.lit(i)) for i in range(len(languages))])
    scored = evidence.select("page_id", "url", "declared", "shares", product.alias("odds"))
    first_of = lambda column: F.get(named, F.array_position(column, F.array_max(column)).cast("int") - 1)
    confidence = F.array_max("odds") / F.aggregate("odds", F.lit(0.0), lambda a, b: a + b)
    return scored.select("page_id", "url", first_of("odds").alias("lang"), confidence.alias("confidence"), first_of("shares").alias("text_lang"), "declared")
