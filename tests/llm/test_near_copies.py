import re

import numpy as np
import pytest
import xxhash

from scolaria.llm.components import component_labels
from scolaria.llm.simhash import as_hex, fingerprint, links_within, near_duplicates, one_of_each, spanning, tile_pairs
from tests.llm.conftest import CLASHES, ODD


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(len(words) - 2, 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute(fps, radius):
    """Smallest member of every fingerprint's component, all pairs compared."""
    fps = np.unique(fps)
    pairs = [(int(a), int(b)) for a in fps for b in fps if a < b and int(a ^ b).bit_count() <= radius]
    return groups([int(f) for f in fps], pairs)


@pytest.mark.parametrize("text", ["", "  \t", "One", "ONE two", "a b c", "É é A b", "w " * 300, " ".join(map(str, range(70_000))), None, "a\x0bb\x0cc d"])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_tiles_and_forest():
    random = np.random.default_rng(2)
    near = random.integers(0, 1 << 63, 1, np.uint64) ^ (np.uint64(1) << random.integers(0, 64, 150, np.uint64))
    fps = np.unique(np.concatenate([near, random.integers(0, 1 << 63, 150, np.uint64)]))
    i, j = tile_pairs(fps, fps, 2)
    want = {(a, b) for a in range(len(fps)) for b in range(len(fps)) if int(fps[a] ^ fps[b]).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
    a, b = fps[i[i < j]].view(np.int64), fps[j[i < j]].view(np.int64)
    forest = list(spanning(a, b))
    nodes = np.unique(np.concatenate([a, b])).tolist()
    assert groups(nodes, forest) == groups(nodes, zip(a.tolist(), b.tolist()))
    assert len(forest) == len(nodes) - len(set(groups(nodes, forest).values()))


@pytest.mark.parametrize("tile", [1, 5, 4096])
@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_join_what_all_pairs_join(spark, tile, radius):
    """Chains and stars of near fingerprints, one crowd that shares two segments, and lone ones."""
    random = np.random.default_rng(radius)
    fps = set(random.integers(0, 1 << 63, 120, np.uint64).tolist())
    chain = int(random.integers(0, 1 << 63))
    for step in range(40):
        chain ^= 1 << int(random.integers(0, 64)) ^ 0
        fps.add(chain)
    crowd = int(random.integers(0, 1 << 63))
    fps |= {crowd ^ int(random.integers(0, 1 << 20)) for _ in range(120)} | {0, (1 << 64) - 1, 1, 3}
    signed = np.array(sorted(fps), np.uint64).view(np.int64)
    links = links_within(spark.createDataFrame([(int(f),) for f in signed], "fp long"), radius, tile).collect()
    got = groups([int(f) & (1 << 64) - 1 for f in signed], [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in links])
    assert got == brute(signed.view(np.uint64), radius)


def test_components_of_long_chains_and_stars(spark):
    random = np.random.default_rng(3)
    names = random.permutation(900).tolist()
    pairs = [(names[i], names[i + 1]) for i in range(200)] + [(names[300], names[i]) for i in range(301, 600)] + [(names[700], names[700]), (names[701], names[702])] * 2
    got = {r.node: r.label for r in component_labels(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = groups({n for p in pairs if p[0] != p[1] for n in p}, [p for p in pairs if p[0] != p[1]])
    assert got == want
    assert component_labels(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_duplicates_of_odd_rows(docs_of):
    base = " ".join(f"word{i}" for i in range(3000))
    pairs = [*ODD, (30, base), (31, base.upper()), (32, base + " more"), (33, base.replace("word7 ", "other ")), (34, " ".join(f"else{i}" for i in range(300)))]
    got = near_duplicates(docs_of(pairs, *CLASHES).repartition(4)).select("doc_id", as_hex_column(), "component_id").collect()
    fps = {(str(i), t): plain_fingerprint(t) for i, t in pairs}
    root = brute(np.array(list(fps.values()), np.uint64), 2)
    least = {}
    for (i, t), f in fps.items():
        if i != "None":
            least[root[f]] = min(least.get(root[f], 1 << 60), int(i))
    want = sorted((str(i), f"{plain_fingerprint(t):016x}", least.get(root[plain_fingerprint(t)])) for i, t in pairs)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert {r.component_id for r in got if r.doc_id in (30, 31)} == {30}
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}


def as_hex_column():
    from pyspark.sql import functions as F

    return as_hex(F.col("fp")).alias("fingerprint")


def test_one_of_each(docs_of):
    got = one_of_each(docs_of(ODD, *CLASHES))
    assert set(CLASHES) <= set(got.columns)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(["1", "4", "5", "7", "8", "9", "None"])
    assert near_duplicates(docs_of([])).collect() == [] and one_of_each(docs_of([])).collect() == []


def test_query_over_the_table(spark, sf_dir):
    from scolaria.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    root = brute(np.array(list(fps.values()), np.uint64), 2)
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(least.get(root[f], 1 << 60), i)
    got = sorted(QUERIES["op10_simhash"](spark, sf_dir).collect())
    assert [tuple(r) for r in got] == sorted((i, f"{f:016x}", least[root[f]]) for i, f in fps.items())
