"""Lines that many documents share are dropped from all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.llm.shared import ASCII_SPACE, ascii_lower, row_key, text_or_empty, whole_rows, written

MIN_DOCUMENTS = 10
MIN_CHARS = 1


def _key_digest(line: Column, min_chars: int) -> Column:
    key = ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))
    return F.when(F.length(key) >= min_chars, F.md5(key))  # as text: array_distinct hashes texts, but compares binaries pair by pair


def drop_shared_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc (all input columns), kept (text), n_lines, n_dropped, for every row of docs (doc_id, text, ...).

    A text is split at \\n; a null or empty text is one empty line. A line's key is the line without ASCII white space at
    both ends, A-Z in lower case. Keys of min_chars code points or more that stand in min_documents rows or more lose all
    their lines; a row counts once however often it repeats a line, equal rows count one each. Other lines keep their
    bytes and order. A row that loses every line has the empty text; an empty table gives an empty table.

    Lines are compared by 128-bit digests, so that text moves only once, to meet the positions to drop. The generators are
    outer ones: no array is empty, and before an inner one Spark filters by its size, which digests every line twice.
    """
    rows = whole_rows(docs).select("doc", row_key(F.col("doc.doc_id"), F.col("doc.text")).alias("row"), F.split(text_or_empty(), "\n", -1).alias("lines"))
    digests = F.transform("lines", lambda line: _key_digest(line, min_chars))
    shared = written(
        rows.select(F.explode_outer(F.array_distinct(digests)).alias("digest"))
        .where(F.col("digest").isNotNull())
        .groupBy("digest").agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= min_documents)
        .select("digest")
    )
    places = rows.select("row", F.posexplode_outer(digests).alias("place", "digest")).where(F.col("digest").isNotNull())
    dropped = places.join(shared, "digest").groupBy("row").agg(F.sort_array(F.collect_set("place")).alias("places"))
    met = rows.drop("lines").join(dropped, "row", "left").select(
        "doc", F.split(text_or_empty(), "\n", -1).alias("lines"), F.coalesce("places", F.array().cast("array<int>")).alias("places")
    )
    # What stays are the runs of lines between one dropped place and the next.
    stops = met.withColumn("stops", F.concat(F.array(F.lit(-1)), "places", F.array(F.size("lines"))))
    run = lambda i: F.slice("lines", F.get("stops", i) + 2, F.get("stops", i + 1) - F.get("stops", i) - 1)
    kept = F.when(F.size("places") == 0, text_or_empty()).otherwise(F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("places")), run)), "\n"))
    return stops.select("doc", kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"), F.size("places").cast("long").alias("n_dropped"))
