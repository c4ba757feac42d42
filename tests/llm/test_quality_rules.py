import re

import pytest
from pyspark.sql import functions as F

from scolaria.llm.quality_rules import Rule, apply_rules, base_counts, cascade, default_rules, estimates
from tests.llm.conftest import CLASHES, ODD


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    "a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "a a a a a a a a", "a a a a a a a a a", "x\ny\nx\n x\n\n", "w " * 19, "w%d " % 1 * 25,
    " ".join(f"w{i}" for i in range(50)), "#*$%&|<> a", "UPPER CASE ONLY " * 9, "1 2 3 4 5 6 7 8 9 " * 4,
]


def test_counts(docs_of):
    pairs = [*enumerate(TEXTS, 100), *ODD]
    got = sorted(
        ((r.doc.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in base_counts(docs_of(pairs, *CLASHES)).collect()), key=str
    )
    assert got == sorted(((i, *brute(text)) for i, text in pairs), key=str)


def test_verdict_does_not_depend_on_the_order(docs_of):
    counted = base_counts(docs_of([*enumerate(TEXTS), *ODD]))
    kept = lambda rules: sorted((str(r.doc.doc_id), r.rejected_by is None) for r in cascade(counted, rules).collect())
    assert kept(default_rules()) == kept(default_rules()[::-1])


def test_later_rules_are_not_asked(docs_of):
    """A rule that would fail on a row is never reached by a row that an earlier rule rejects."""
    counted = base_counts(docs_of([(1, " ".join(f"w{i}" for i in range(30)))]))
    first = Rule("all", F.col("n_words") > 0)
    broken = Rule("broken", F.raise_error(F.lit("asked")).isNull())
    assert cascade(counted, [first, broken]).first().rejected_by == "all"
    with pytest.raises(Exception, match="asked"):
        cascade(counted, [broken, first]).collect()


def test_junk_goes_and_prose_stays(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc.doc_id", "rejected_by", "n_words").join(labels, "doc_id").collect()
    good = [r for r in judged if r.quality == 1 and r.n_words >= 20]
    bad = [r for r in judged if r.quality == 0]
    assert sum(r.rejected_by is None for r in good) >= 0.95 * len(good)
    assert sum(r.rejected_by is not None for r in bad) >= 0.8 * len(bad)


def test_no_rows(docs_of):
    assert apply_rules(docs_of([])).collect() == []


def test_cost_is_that_of_the_rule(docs_of):
    """A rule with much work on a text costs more than one on a count; shares are those of the sample, hot ids and nulls included."""
    texts = [" ".join(f"w{(i * k) % 1000}" for i in range(400)) for k in range(1, 201)]
    dear = Rule("dear", F.sha2(F.repeat(F.col("doc.text"), 100), 512) == "")
    cheap = Rule("cheap", F.col("n_words") > 100)
    docs = docs_of([(None if k % 3 else k, text) for k, text in enumerate(texts)])
    costs = {found.name: found for found in estimates(docs, [dear, cheap], copies=20)}
    assert costs["dear"].seconds > 10 * costs["cheap"].seconds
    assert (costs["dear"].rejected, costs["cheap"].rejected) == (0, 1) and costs["cheap"].worth > costs["dear"].worth == 0


def test_the_sample_is_bounded(docs_of, spark):
    """A table of one id, ten times the sample: about the sample's rows are measured, and no text is sorted."""
    docs = docs_of([(7, " ".join(f"w{i}" for i in range(30)))]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000)))).repartition(4)
    taken = docs.sample(200 / docs.count(), 7).count()
    assert 100 < taken < 300
    assert [found.rejected for found in estimates(docs, [Rule("all", F.lit(True))], sample_rows=200, copies=2)] == [1]
