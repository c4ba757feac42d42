import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from scolaria.llm import toxicity
from scolaria.llm.decontaminate import shingle_counts, words_of
from tests.llm.conftest import CLASHES, ODD
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_near_copies import groups
from tests.llm.test_near_text import shingles, similar


def pairs_of(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def test_every_stage_against_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "packing"]

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = corpus_pipeline.written(stages["toxicity"](spark, docs, sf_dir))
    model = toxicity.train(docs, labels)
    weights, features = model.dense(), toxicity.Features()
    score = lambda text: toxicity.sigmoid(float(weights[features.of(text)].sum(dtype=np.float64)) + model.bias)
    assert out.columns == columns and pairs_of(out) == [p for p in pairs_of(docs) if score(p[1]) < 0.5]
    toxic = {r.doc_id for r in labels.collect() if r.toxic}
    kept = {i for i, _ in pairs_of(out)}
    clean = {r.doc_id for r in labels.collect() if not r.toxic}
    assert len(toxic - kept) >= 0.8 * len(toxic) and len(clean & kept) >= 0.98 * len(clean)

    docs, out = out, corpus_pipeline.written(stages["line_dedup"](spark, out, sf_dir))
    want = sorted(((i, text) for i, _, _, text in brute_lines(pairs_of(docs), 10)), key=str)
    assert out.columns == columns and pairs_of(out) == want
    assert all(r.n_chars == len(r.text) for r in out.collect())

    docs, out = out, corpus_pipeline.written(stages["simhash_near_dedup"](spark, out, sf_dir))
    sets = {i: shingles(text) for i, text in pairs_of(docs)}
    ids, alike = list(sets), []
    for k, i in enumerate(ids):
        alike += [(i, j) for j in ids[:k] if similar(sets[i], sets[j])]  # two empty sets are alike
    root = groups(ids, alike)
    assert out.columns == columns and pairs_of(out) == [p for p in pairs_of(docs) if p[0] in set(root.values())]

    docs, out = out, corpus_pipeline.written(stages["decontamination"](spark, out, sf_dir))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    of_items = {s for _, text in items for s in shingle_counts(words_of(text))}
    held = lambda text: bool(of_items & set(shingle_counts(words_of(text)))) and bool(brute_contamination(text, items))
    assert out.columns == columns and pairs_of(out) == [p for p in pairs_of(docs) if not held(p[1])]
    assert out.count() < docs.count()

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(text, add_special_tokens=False).ids, 1] for i, text in pairs_of(out)}
    pieces = stages["packing"](spark, out, sf_dir).collect()
    assert sum(p.length for p in pieces) == sum(map(len, ids.values())) and {p.doc_id for p in pieces} == set(ids)
    assert all(zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for p in pieces)
    key = lambda p: (p.doc_id, p.start, p.length, p.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, sf_dir).select(*pieces[0].__fields__).collect())) and len(pieces) >= out.count()


def test_odd_rows_through_all_stages(docs_of, spark, tmp_path):
    docs_of(ODD, *CLASHES).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "some words to read but no id")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} <= {i for i, _ in ODD}


def test_empty_tables_through_all_stages(docs_of, spark, tmp_path):
    docs_of([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
