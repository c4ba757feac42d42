import os

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers_path(spark):
    """Python workers find the package wherever the tests are started."""
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture
def docs_of(spark):
    """(doc_id, text) pairs as documents, with further columns whose names the operators use inside."""

    def make(pairs, *more):
        rows = [(i, text, "en", "src0", None if text is None else len(text), *[f"x{i}" for _ in more]) for i, text in pairs]
        return spark.createDataFrame(rows, SCHEMA + "".join(f", `{name}` string" for name in more))

    return make


CLASHES = ("row", "doc", "lines", "places", "digest", "kept", "words", "score", "fp", "id", "matches", "label", "held_out", "n_words", "loose", "part")
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (5, "same text here for two rows\nsecond line"),
    (6, "same text here for two rows\nsecond line"),
    (None, "no id at all but some words to read"),
    (7, "long " * 200_000),
    (8, "x" * 1_000_000),
    (9, "\0 odd ퟿ 😀 é́ 　 <|endoftext|>"),
]
