import random
import re
from itertools import permutations

import numpy as np

from scolaria.llm.filter_audit import audit, failures, positional_popcounts, survival_words
from tests.llm.conftest import CLASHES, ODD

SPACE = " \t\n\x0b\x0c\r"


def plain_fails(rows):
    """The failed filters of (doc_id, text) rows as sets of letters."""
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(f"[^{SPACE}]+", text)
        fails = set()
        fails |= {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else set()
        fails |= {"D"} if set(text) & set("#$%&*|") else set()
        if doc_id is not None and any(other is not None and other < doc_id and (same or "") == text for other, same in rows):
            fails |= {"E"}
        out.append(fails)
    return out


def brute(rows, parts, labels):
    fails, out = plain_fails(rows), []
    good, toxic = ({i for i, *told in labels if i is not None and told[k] == 1} for k in (0, 1))
    for part in set(parts):
        docs = [(f, rows[i][0]) for i, f in enumerate(fails) if parts[i] == part]
        report, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[0]]
                left = [d for d in left if name not in d[0]]
                shapley[name] += len(gone)
                failing = sum(name in f for f, _ in docs)
                only = sum(f == {name} for f, _ in docs)
                report.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), only, sum(i in good for _, i in gone), sum(i in toxic for _, i in gone)))
        out += [(*row, shapley[row[1][row[2] - 1]]) for row in report]
    return sorted(out)


def result(frame):
    return sorted(map(tuple, frame.collect()))


def test_popcounts_against_plain_counts():
    r = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 4, 7, 100, 5001):
        words = r.integers(0, 1 << 32, n, np.uint64).astype(np.uint32)
        assert positional_popcounts(words).tolist() == [sum(int(w) >> b & 1 for w in words) for b in range(32)]


def test_survival_words():
    words = survival_words()
    assert all((int(words[f]) >> s & 1 == 1) == (f & s == 0) for f in range(32) for s in range(32))


def texts(r):
    """Texts on both sides of every limit."""
    many = [f"w{i}" for i in range(130)]
    return [
        "", None, "short Text", " ".join(many[:99]), " ".join(many[:100]), "\t".join(many[:80] + many[:20]), "\n".join(many[:79] + many[:21]),
        "A" * 10 + "é" * 90, "A" * 11 + "é" * 89, " ".join(many) + " |", " ".join(many) + " ÀÉ", "\x0b".join(many), "\x85".join(many), "\xa0".join(many), "\x1c".join(many),
        " ".join(r.choices(many, k=120)) + " X#", " ".join(w.upper() for w in many),
    ]


def test_audit_against_plain_loops(spark):
    r = random.Random(6)
    kinds = texts(r)
    rows = [(i, r.choice(kinds)) for i in r.sample(range(1000), 150)]
    rows += [(5000, kinds[4]), (5000, kinds[4]), (None, kinds[4]), (None, "no id"), (None, "no id")]
    langs = [r.choice(["en", "fr", None, ""]) for _ in rows]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i, _ in rows if i is not None and r.random() < 0.6]
    labels += [(labels[0][0], 1, 1), (labels[0][0], 0, 0), (None, 1, 1), (10**9, 1, 1)]
    docs = spark.createDataFrame([(i, text, lang, "x") for (i, text), lang in zip(rows, langs)], "doc_id long, text string, lang string, fails string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert result(audit(docs.repartition(5), told)) == brute(rows, [lang or "" for lang in langs], labels)


def test_odd_rows_and_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    more = ("part", "digest", "fails", "first", "n", "good", "code_points", *CLASHES[2:])
    found = [(r.doc_id, r.fails) for r in failures(docs_of(ODD, *more)).collect()]
    want = [(i, sum(1 << "ABCDE".index(c) for c in f)) for (i, _), f in zip(ODD, plain_fails(ODD))]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert len(audit(docs_of(ODD, *more), none).collect()) == 600
    assert audit(docs_of([]), none).collect() == []
