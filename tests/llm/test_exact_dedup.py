import hashlib
import random
from collections import Counter, defaultdict

from scolaria.llm.exact_dedup import exact_duplicates, frequent_digests, without_duplicates
from tests.llm.conftest import CLASHES, ODD


def key_of(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def brute(pairs):
    groups = defaultdict(list)
    for i, text in pairs:
        groups[key_of(text)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: -1 if i is None else i)
        kept = [True] + [False] * (ids.count(keep) - 1)  # of equal ids one row stays
        out += [(i, keep, len(ids), kept.pop(0) if i == keep else False, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def result(frame):
    return sorted(map(tuple, frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def corpus(r, n=3000):
    """A text with a third of all rows, some with tens, many with one; case differs between copies, also beyond ASCII."""
    pairs = []
    for i in r.sample(range(10 * n), n):
        kind = r.random()
        text = "Hot Text" if kind < 0.33 else f"warm {r.randrange(20)}" if kind < 0.6 else f"own {i}" if kind < 0.98 else r.choice(["É", "é", "", None])
        pairs.append((i, text.upper() if text and text[0] != "É" and r.random() < 0.3 else text))
    return pairs


def test_copies_against_plain_loops(docs_of):
    pairs = corpus(random.Random(1))
    for tracked, hot in ((16, 1), (64, 3), (4096, 1000)):
        assert result(exact_duplicates(docs_of(pairs).repartition(6), tracked, hot)) == brute(pairs)


def test_frequent_digests_are_found(spark):
    r = random.Random(2)
    keys = ["hot"] * 4000 + [f"warm{i % 5}" for i in range(4000)] + [f"k{i}" for i in range(4000)]
    r.shuffle(keys)
    found = {row[0] for row in frequent_digests(spark.createDataFrame([(k,) for k in keys], "text_sha256 string").repartition(8), 64, 10).collect()}
    often = {k for k, n in Counter(keys).items() if n > 3.5 / 64 * len(keys)}
    assert often <= found and len(often) == 6 and len(found) <= 10


def test_odd_rows_and_clashing_columns(docs_of):
    pairs = [*ODD, (None, "no id at all but SOME words to read"), (4, "ONE"), (9, None)]
    frame = docs_of(pairs, *CLASHES, "text_sha256", "keep_id", "group_size", "keep_row")
    assert result(exact_duplicates(frame)) == brute(pairs)
    stay = without_duplicates(frame)
    want = [(r[1], r[4]) for r in brute(pairs) if r[3]]
    got = [(r.doc_id, hashlib.sha256(key_of(r.text).encode()).hexdigest()) for r in stay.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert stay.columns == frame.columns
    assert exact_duplicates(docs_of([])).collect() == [] and without_duplicates(docs_of([])).collect() == []


def test_only_digests_are_shuffled(docs_of):
    """No exchange carries text, and the frequent texts' rows meet their winners in a broadcast."""
    plan = exact_duplicates(docs_of(corpus(random.Random(3), 200)))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "text#" not in plan
