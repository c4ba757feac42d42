import random
import re
import time

import duckdb
from pyspark.sql import functions as F

from scolaria.llm import license_scan
from scolaria.llm.license_scan import DISTINCTIVE, PHRASES, TEMPLATES, matched_templates, needed, scan_licenses, span_of
from scolaria.llm.shared import row_key, whole_rows
from tests.llm.conftest import CLASHES, ODD

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def contained(text, templates, least):
    """label -> greatest share of a template's words in a run of half as many words again as the template has."""
    out, words = {}, words_of(text)
    for label, sentences in templates.items():
        for sentence in sentences:
            wanted, span = set(sentence.split()), span_of(len(sentence.split()))
            telling = wanted & set(DISTINCTIVE.get(label, wanted))
            blocks = [wanted & set(words[k : k + span]) for k in range(len(words)) if words[k] in wanted]
            most = max((len(block) for block in blocks if block & telling), default=0)
            if most >= needed(len(wanted), least):
                out[label] = max(out.get(label, 0), most / len(wanted))
    return out


def brute(text):
    words, starts, base = words_of(text), [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                base.add(label)
    met = contained(text, TEMPLATES, 0.8)
    score = 1.0 if base else max(met.values(), default=0.0)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(met))), score)


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "apache-license apache  LICENSE\nMIT\nLicense", "cc by cc by cc-by", "mit license mit license", "É GNU General\tPublic_License!",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its files", "under the apache license", "mit mit license",
    "this is free and\nunencumbered software released into the public domain", "THIS IS FREE AND UNENCUMBERED SOFTWARE released into public domain", "License",
] + [sentence for sentences in TEMPLATES.values() for sentence in sentences]


def test_scan_against_plain_loops(docs_of):
    pairs = [*enumerate(TEXTS, 100), *ODD]
    got = scan_licenses(docs_of(pairs, *CLASHES)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute(text)) for i, text in pairs), key=str)
    assert scan_licenses(docs_of([])).collect() == []


def rows_of(frame):
    return whole_rows(frame).select("doc", row_key(F.col("doc.doc_id"), F.col("doc.text")).alias("row"))


def test_filters_lose_no_pair(docs_of, monkeypatch):
    """Random small templates and texts, at every threshold: the join finds what counting every block finds, also across segments."""
    r = random.Random(9)
    letters = "abcdefghijklmnop"
    templates = {f"t{i}": [" ".join(r.choices(letters, k=r.randint(2, 7)))] for i in range(12)}
    pairs = [(i, "".join(r.choice(letters[: r.randint(2, 16)]) + r.choice([" ", " ", "\n", " z "]) for _ in range(r.choice([0, 3, 10, 80])))) for i in range(100)]
    rows = rows_of(docs_of(pairs))
    for least, segment in ((0.5, 2048), (0.8, 7), (1.0, 1)):
        monkeypatch.setattr(license_scan, "SEGMENT", segment)
        met = matched_templates(rows, templates, least)
        got = {r.doc.doc_id: (set(r.found), r.best) for r in rows.join(met, "row").collect()}
        want = {i: (set(found), max(found.values())) for i, text in pairs if (found := contained(text, templates, least))}
        assert got == want and len(want) > 10


def test_time_follows_the_length_of_a_text(docs_of):
    """A text of 200 000 words, a third of them of templates, in one row."""
    r = random.Random(4)
    known = [word for sentences in TEMPLATES.values() for sentence in sentences for word in sentence.split()]
    text = " ".join(r.choice(known) if r.random() < 0.33 else f"w{r.randrange(5000)}" for _ in range(200_000))
    start = time.perf_counter()
    (found,) = scan_licenses(docs_of([(1, text + " " + TEMPLATES["isc"][0])])).collect()
    assert "isc" in found.labels and time.perf_counter() - start < 60


def test_labels_do_not_run_into_each_other():
    """No template's own sentence meets a template of another label."""
    for label, sentences in TEMPLATES.items():
        for sentence in sentences:
            assert set(contained(sentence, TEMPLATES, 0.8)) == {label}


WRAPPED = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal",
    "bsd": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:",
    "isc": " * Permission to use, copy, modify, and/or distribute this software for any\n * purpose with or without fee is hereby granted, provided that",
}


def test_wrapped_notices(spark, docs_of, tmp_path):
    """The query finds a notice that runs over a line end, and none in the same words far apart."""
    from scolaria.llm.queries import QUERIES

    spread = " ".join(f"{word} x y z" for word in TEMPLATES["unlicense"][0].split())
    pairs = [*enumerate(WRAPPED.values(), 1), (8, spread), (9, None)]
    docs_of(pairs).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.labels, r.score) for r in QUERIES["op2_license_scan"](spark, str(tmp_path)).collect()}
    assert got == {**{i: (label, 1.0) for i, label in enumerate(WRAPPED, 1)}, 8: ("", 0.0), 9: ("", 0.0)}


def test_windows_against_plain_loops(docs_of):
    pairs = [*enumerate([*TEXTS, *WRAPPED.values(), "x " * 50 + "\n".join(TEXTS)], 100), *ODD]
    rows = rows_of(docs_of(pairs))
    want = {i: (set(found), max(found.values())) for i, text in pairs if (found := contained(text, TEMPLATES, 0.8))}
    met = matched_templates(rows)
    assert {r.doc.doc_id: (set(r.found), r.best) for r in rows.join(met, "row").collect()} == want


def test_statement_on_wrapped_notices(spark, docs_of, tmp_path):
    """The SQL of the query takes the same blocks: notices that wrap, other licenses' words, rows with one id."""
    from scolaria.llm.sql import STATEMENTS

    others = ["Distributed under the Academic Software License, version 1.0", " and so on and on ".join(TEMPLATES["unlicense"][0].split()), None, ""]
    pairs = [*enumerate([*TEXTS, *WRAPPED.values(), *others], 1), (3, WRAPPED["bsd"]), (3, "nothing")]
    docs = docs_of(pairs)
    connection = duckdb.connect()
    connection.register("documents", docs.toArrow())
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    want = connection.execute(f"SELECT {', '.join(columns)} FROM ({STATEMENTS['op2_license_scan']})").fetchall()
    assert sorted(map(tuple, scan_licenses(docs).select(*columns).collect()), key=str) == sorted(want, key=str)


def test_common_words_are_no_notice(docs_of):
    """Other licenses with the common words of a short template, and a template's words spread over a long line."""
    texts = [
        "Distributed under the Academic Software License, version 1.0", "Licensed under the terms set by Acme, release 4.0",
        " and so on and on ".join(TEMPLATES["unlicense"][0].split()), "Distributed under the Boost Software License, version 1.0", "licensed under CC BY 4.0",
    ]
    got = {r.doc_id: r.labels for r in scan_licenses(docs_of(enumerate(texts))).collect()}
    assert got == {0: "", 1: "", 2: "", 3: "bsl-1.0", 4: "cc-by,creative-commons"}
