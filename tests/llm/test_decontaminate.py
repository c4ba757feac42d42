import random
from collections import Counter

import numpy as np
import pytest

from scolaria.llm.decontaminate import (
    BenchmarkIndex, HammingBlocks, find_contamination, shingle_counts, weighted_similarity, without_contamination, words_of,
)
from tests.llm.conftest import CLASHES, ODD


def brute(text, items, least=0.8):
    """Best window of every item by comparing each window of the item's size."""
    words, out = words_of(text), {}
    for item_id, item in items:
        wanted = words_of(item)
        for start in range(len(words) - len(wanted) + 1) if wanted else ():
            window = words[start : start + len(wanted)]
            if len(wanted) < 5:
                found = float(window == wanted)
            else:
                found = weighted_similarity(shingle_counts(window), shingle_counts(wanted))
            if found >= least and (item_id not in out or found > out[item_id][0]):
                out[item_id] = (found, start, len(wanted))
    return out


def near(words, r, k):
    out = list(words)
    for _ in range(r.choice([0, 1, 1, 2])):
        at = r.randrange(len(out))
        match r.choice("sid"):
            case "s":
                out[at] = f"zz{k}"
            case "i":
                out.insert(at, f"yy{k}")
            case "d":
                del out[at]
    return out


def test_planted_passages_against_every_window():
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 20
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([3, 12, 20, 48, 60, 90])))) for i in range(60)]
    index = BenchmarkIndex(items)
    expected = found = 0
    for k in range(120):
        item_id, item = r.choice(items)
        around = [r.choice(vocabulary) for _ in range(40)]
        text = " ".join(around) + ".\n" + ", ".join(near(item.split(), r, k)).upper() + "! " + " ".join(around)
        want = brute(text, items)
        got = {i: (s, first, n) for i, s, _, first, n in index.matches(text)}
        assert set(got) <= set(want)
        expected, found = expected + len(want), found + len(got)
        for i in got:
            assert got[i][0] == pytest.approx(want[i][0]) and got[i][2] == want[i][2]
    assert expected > 40 and found == expected


def test_blocks_find_all_within_radius():
    random_ = np.random.default_rng(1)
    fps = random_.integers(0, 1 << 63, 300, np.uint64)
    queries = np.concatenate([fps[:50] ^ np.uint64(0b1011), random_.integers(0, 1 << 63, 50, np.uint64)])
    for radius in (0, 3, 16, 40):
        query, place, distance = HammingBlocks(fps, radius).near(queries)
        want = {(i, j, int(q ^ f).bit_count()) for i, q in enumerate(queries) for j, f in enumerate(fps) if int(q ^ f).bit_count() <= radius}
        assert set(zip(query.tolist(), place.tolist(), distance.tolist())) == want and len(query) == len(want)


def test_weighted_similarity():
    a, b = Counter({"x": 3, "y": 1}), Counter({"x": 1, "z": 1})
    assert weighted_similarity(a, b) == 1 / 5 and weighted_similarity(a, a) == 1 and weighted_similarity(Counter(), Counter()) == 0


PASSAGE = " ".join(f"item{i}" for i in range(30))


def test_odd_rows_and_blocks_of_items(spark, docs_of):
    items = [(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (4, "two words"), (None, "no id item has these eight words here"), (5, PASSAGE + " " + PASSAGE)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pairs = [*ODD, (50, PASSAGE), (51, f"{PASSAGE} {PASSAGE}"), (52, "so two\nWords!"), (53, "no id item has these eight words here"), (54, PASSAGE[:60])]
    for block_items in (1, 100):
        frame = find_contamination(docs_of(pairs, *CLASHES), benchmark, block_items=block_items)
        got = {(r.doc.doc_id, m.item_id) for r in frame.collect() for m in r.matches}
        assert got == {(50, 1), (51, 1), (51, 5), (52, 4), (53, None)}
    kept = without_contamination(docs_of(pairs, *CLASHES), benchmark)
    assert set(CLASHES) <= set(kept.columns)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*[str(i) for i, _ in ODD], "54"])


def test_no_rows(spark, docs_of):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert [r.matches for r in find_contamination(docs_of([(1, PASSAGE)]), benchmark).collect()] == [[]]
    assert find_contamination(docs_of([]), benchmark).collect() == []


def test_query_over_the_table(spark, sf_dir):
    from scolaria.llm.queries import QUERIES

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    shingles = {s for _, text in items for s in shingle_counts(words_of(text))}
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        if shingles & set(shingle_counts(words_of(r.text))):  # else nothing can be similar
            want |= {(r.doc_id, item): found for item, (found, _, _) in brute(r.text, items).items()}
    got = {(r.doc_id, r.item_id): r.similarity for r in QUERIES["op3_decontaminate"](spark, sf_dir).collect()}
    assert got == pytest.approx(want) and want


def test_text_shorter_than_the_item():
    """An item without its first or last words is held against the item as a whole, at any distance of fingerprints."""
    r = random.Random(6)
    items = [(i, " ".join(f"w{r.randrange(3000)}" for _ in range(n))) for i, n in enumerate([12, 30, 59, 59, 90] * 6)]
    index = BenchmarkIndex(items)
    for item_id, item in items:
        words = item.split()
        for cut in range(1, len(words) // 5 + 2):
            for part in (words[cut:], words[:-cut]):
                want = weighted_similarity(shingle_counts(part), shingle_counts(words))
                got = [(i, s, first, n) for i, s, _, first, n in index.matches(" ".join(part).upper())]
                assert got == ([(item_id, pytest.approx(want), 0, len(part))] if want >= 0.8 else [])
