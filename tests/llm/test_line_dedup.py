import hashlib
import time
from collections import Counter

from scolaria.llm.line_dedup import drop_shared_lines
from tests.llm.conftest import CLASHES, ODD

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))


def brute(pairs, least):
    split = [(i, (text or "").split("\n")) for i, text in pairs]
    seen = Counter(k for _, lines in split for k in {key_of(line) for line in lines})
    out = []
    for i, lines in split:
        kept = [line for line in lines if not (key_of(line) and seen[key_of(line)] >= least)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.doc.doc_id, r.n_lines, r.n_dropped, r.kept) for r in frame.collect()), key=str)


def test_lines_of_three_documents(docs_of):
    pairs = [(i, f"own {i}\n Shared Line\t\n\nlast {i % 2}") for i in range(7)] + [(20, "shared line"), (21, "shared line\nshared line"), (22, "SHARED LINE\nÉ\né")]
    for least in (1, 3, 4, 10, 11):
        assert result(drop_shared_lines(docs_of(pairs), least)) == brute(pairs, least)


def test_odd_rows_and_clashing_columns(docs_of):
    frame = drop_shared_lines(docs_of(ODD, *CLASHES), 2)
    assert result(frame) == brute(ODD, 2)
    assert set(CLASHES) <= set(frame.schema["doc"].dataType.names)


def test_no_rows(docs_of):
    assert drop_shared_lines(docs_of([])).collect() == []


def test_query_over_the_table(spark, sf_dir):
    from scolaria.llm.queries import QUERIES

    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = sorted((i, n, d, hashlib.sha256(kept.encode()).hexdigest()) for i, n, d, kept in brute(pairs, 10))
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in QUERIES["op4_line_dedup"](spark, sf_dir).collect())
    assert got == want


def test_time_follows_the_lines_of_a_text(docs_of):
    """A million different lines in one row, some of them in ten other rows."""
    text = "\n".join(f"line {i}" for i in range(1_000_000))
    pairs = [(0, text)] + [(i, "line 7\nline 999999") for i in range(1, 10)]
    start = time.perf_counter()
    got = {r.doc.doc_id: r for r in drop_shared_lines(docs_of(pairs)).collect()}
    assert time.perf_counter() - start < 60
    assert got[0].n_lines == 1_000_000 and got[0].n_dropped == 2 and got[0].kept == text.replace("line 7\n", "", 1).removesuffix("\nline 999999")
    assert got[5].kept == ""


def test_statement_on_repeated_ids(docs_of):
    """Rows that share an id count one by one, in the query as in its SQL."""
    import duckdb

    from scolaria.llm.sql import STATEMENTS

    pairs = [(i // 3, "shared\nown " + str(i)) for i in range(10)] + [(50, "nine\nshared")] + [(60, "nine")] * 8 + [(70, None), (70, None)]
    docs = docs_of(pairs)
    connection = duckdb.connect()
    connection.register("documents", docs.toArrow())
    want = connection.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({STATEMENTS['op4_line_dedup']})").fetchall()
    got = [(i, n, d, hashlib.sha256(kept.encode()).hexdigest()) for i, n, d, kept in result(drop_shared_lines(docs))]
    assert sorted(got) == sorted(want)
