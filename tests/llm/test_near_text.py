import random
import time

import numpy as np
import pandas as pd
import xxhash

import corpus_pipeline
from scolaria.llm import near_text
from scolaria.llm.near_text import linked, near_duplicates, one_of_each, sketch
from scolaria.llm.shared import whole_runs
from tests.llm.conftest import CLASHES, ODD
from tests.llm.test_near_copies import groups


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def edited(words, r, n):
    out = list(words)
    for at in r.sample(range(len(out)), n):
        out[at] = f"new{r.randrange(10**6)}"
    return out


def planted(r):
    """Texts of 100 words and copies with up to seven words replaced, and a chain whose ends are far apart."""
    pairs = []
    for _ in range(30):
        words = [f"w{r.randrange(2000)}" for _ in range(100)]
        pairs += [" ".join(words), *(" ".join(edited(words, r, n)) for n in (1, 2, 3, 4, 7))]
    words = [f"c{i}" for i in range(100)]
    for k in range(12):
        pairs.append(" ".join([*(f"n{i}" for i in range(k * 5)), *words[k * 5 :]]))
    return list(enumerate(pairs, 100))


def test_pairs_at_four_fifths_are_found(spark, docs_of):
    """The stage keeps one document of every component of five-word similarity 0.8, all pairs compared."""
    pairs = planted(random.Random(8))
    sets = {i: shingles(text) for i, text in pairs}
    root = groups(list(sets), [(i, j) for i in sets for j in sets if i < j and similar(sets[i], sets[j])])
    want = sorted(set(root.values()))
    got = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs_of(pairs, *CLASHES), "")
    assert sorted(r.doc_id for r in got.collect()) == want and len(want) == 120 < len(pairs)
    assert set(CLASHES) <= set(got.columns)


def simhash(text):
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 5]).encode(), 42) for i in range(max(len(words) - 4, 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_alone_find_all_pairs_within_the_radius(docs_of, monkeypatch):
    """Without any MinHash band: the components of similar pairs inside components of fingerprints, all pairs compared."""
    pairs = planted(random.Random(21))
    monkeypatch.setattr(near_text, "bands", lambda hashes: [])
    sets, fps = {i: shingles(text) for i, text in pairs}, {i: simhash(text) for i, text in pairs}
    every = [(i, j) for i in sets for j in sets if i < j]
    cluster = groups(list(sets), [(i, j) for i, j in every if (fps[i] ^ fps[j]).bit_count() <= near_text.RADIUS])
    root = groups(list(sets), [(i, j) for i, j in every if cluster[i] == cluster[j] and similar(sets[i], sets[j])])
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(pairs)).collect()}
    assert got == root and len(set(root.values())) < len(pairs) - 20


def test_texts_of_one_fingerprint_are_candidates(docs_of, monkeypatch):
    """The same set of shingles in another order of words: one fingerprint, two nodes, which no link of fingerprints joins."""
    monkeypatch.setattr(near_text, "bands", lambda hashes: [])
    ring = [f"r{i}" for i in range(30)]
    pairs = [(7, " ".join([*ring, *ring[:4]])), (3, " ".join([*ring[9:], *ring[:9], *ring[9:13]])), (5, ""), (9, None)]
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(pairs)).collect()}
    assert got == {7: 3, 3: 3, 5: 5, 9: 5}


def test_odd_rows(docs_of):
    kept = sorted(str(r.doc_id) for r in one_of_each(docs_of(ODD)).collect())
    assert kept == sorted(["1", "4", "5", "None", "7", "8", "9"])
    assert one_of_each(docs_of([])).collect() == []


def arrays(sets):
    r = np.random.default_rng(1)
    codes = {x: int(h) for x, h in zip(sorted(set().union(*sets)), r.integers(0, 1 << 63, 100_000, np.int64))}
    return [np.array(sorted(codes[x] for x in one), np.int64) for one in sets]


def test_links_are_similar_and_whole():
    r = random.Random(3)
    sets = [frozenset(r.sample(range(14), r.randint(8, 14))) for _ in range(150)]
    every = [(i, j) for i in range(150) for j in range(i) if similar(sets[i], sets[j])]
    found = linked(range(150), arrays(sets))
    assert all(similar(sets[a], sets[b]) for a, b in found) and len(found) < 150
    assert len(set(groups(range(150), found).values())) == len(set(groups(range(150), every).values()))

    side = [r.randrange(2) for _ in sets]
    across = [(i, j) for i, j in every if side[i] != side[j]]
    found = linked(range(150), arrays(sets), side=side)
    assert all(side[a] != side[b] and similar(sets[a], sets[b]) for a, b in found)
    assert len(set(groups(range(150), found).values())) == len(set(groups(range(150), across).values()))


def test_sketches_never_differ_more_than_their_sets():
    r = np.random.default_rng(2)
    for n in (0, 1, 50, 3000):
        a = np.unique(r.integers(-(1 << 63), 1 << 63, n, np.int64))
        b = np.unique(np.concatenate([a[n // 7 :], r.integers(-(1 << 63), 1 << 63, n // 5, np.int64)]))
        assert np.bitwise_count(sketch(a) ^ sketch(b)).sum() <= len(np.setxor1d(a, b))


def test_a_large_band_of_different_texts():
    """Pages of one site that share two thirds of their shingles: 4096 in one band, as sixteen blocks meet, none linked."""
    r = np.random.default_rng(3)
    site = r.integers(0, 1 << 62, 120, np.int64)
    sets = [np.unique(np.concatenate([site, r.integers(0, 1 << 62, 50, np.int64)])) for _ in range(512)]
    start = time.perf_counter()
    for _ in range(4):
        assert linked(range(512), sets, side=[i % 2 for i in range(512)]) == []
    assert time.perf_counter() - start < 4  # the 20 000 members of a large site make some 3000 such meetings


def test_blocks_of_a_band_lose_no_link(docs_of, monkeypatch):
    """Bands cut into blocks of four give the components of whole ones."""
    pairs = planted(random.Random(5))
    whole = sorted(map(tuple, near_duplicates(docs_of(pairs)).collect()))
    monkeypatch.setattr(near_text, "BLOCK", 4)
    site = [f"s{i}" for i in range(90)]
    more = [(5000 + i, " ".join([*site, f"page{i}", f"own{i}"])) for i in range(60)]
    got = sorted(map(tuple, near_duplicates(docs_of(pairs + more)).collect()))
    assert [row for row in got if row[0] < 5000] == whole
    assert {component for i, component in got if i >= 5000} == {5000}


def test_runs_are_whole():
    r = random.Random(2)
    keys = sorted((r.randrange(6), r.randrange(3)) for _ in range(60))
    rows = pd.DataFrame(keys, columns=["a", "b"])
    for cuts in ([], [0, 0, 60], [1, 2, 3, 30], sorted(r.choices(range(61), k=25))):
        frames = [rows.iloc[x:y] for x, y in zip([0, *cuts], [*cuts, 60])]
        found = list(whole_runs(iter(frames), ["a", "b"]))
        assert pd.concat(found, ignore_index=True).equals(rows)
        ends = [tuple(f.iloc[-1]) for f in found]
        assert len(set(ends)) == len(ends) and all(tuple(f.iloc[0]) != end for f, end in zip(found[1:], ends))
    assert list(whole_runs(iter([rows.iloc[:0]]), ["a", "b"])) == []
