"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from scolaria.llm.license_scan import CONTAINMENT, DISTINCTIVE, PHRASES, TEMPLATES, needed, span_of

SPACE = "concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

#: A row counts once for a line, whether or not another row has its id.
LINES = f"""
WITH numbered AS (SELECT row_number() OVER () AS doc, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split_lines AS (
  SELECT doc, doc_id, pos, line, translate(trim(line, {SPACE}), {UPPER}, {LOWER}) AS line_key
  FROM (SELECT doc, doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM numbered) a),
shared_keys AS (
  SELECT line_key FROM split_lines WHERE length(line_key) >= 1 GROUP BY line_key HAVING count(DISTINCT doc) >= 10),
line_kept AS (
  SELECT doc, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(s.line_key) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE s.line_key IS NULL), '') AS kept
  FROM split_lines l LEFT JOIN shared_keys s ON l.line_key = s.line_key GROUP BY doc)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM line_kept
"""

QUALITY = f"""
WITH plain AS (
  SELECT doc_id, coalesce(text, '') AS text, translate(coalesce(text, ''), {SPACE}, repeat(' ', 6)) AS spaced FROM documents),
word_lists AS (SELECT doc_id, list_filter(string_split(spaced, ' '), lambda w: w <> '') AS words FROM plain),
word_lines AS (
  SELECT doc_id, count(*) AS n_word_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM plain) a WHERE trim(line, {SPACE}) <> '' GROUP BY doc_id),
windows AS (
  SELECT doc_id, place, array_to_string(words[place:place + 7], ' ') AS span
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS place FROM word_lists WHERE len(words) >= 8) a),
repeated AS (
  SELECT doc_id, count(DISTINCT word) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(place, place + 8)) AS word
        FROM (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, span) AS copies FROM windows) a WHERE copies > 1) b
  GROUP BY doc_id),
counted AS (
  SELECT p.doc_id, len(words) AS n_words, length(replace(spaced, ' ', '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_word_lines, 0) AS n_word_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^\\p{{L}}]+', '', 'g')) AS letters,
         length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) AS capitals, length(text) - length(replace(text, '!', '')) AS marks
  FROM plain p JOIN word_lists w ON p.doc_id = w.doc_id LEFT JOIN word_lines l ON p.doc_id = l.doc_id
       LEFT JOIN repeated r ON p.doc_id = r.doc_id),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_word_lines OR word_chars < 2 * n_words
            OR word_chars > 20 * n_words OR 2 * capitals > letters OR 10 * marks > 3 * n_words OR 2 * letters < word_chars) AS kept
FROM judged
"""

NOT_WORD = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(translate({text}, {UPPER}, {LOWER}), {NOT_WORD}), lambda w: w <> '')"


def _phrase(phrase: str) -> str:
    same = " AND ".join(f"words[i + {k}] = '{word}'" for k, word in enumerate(phrase.split()))
    return f"list_filter(range(1, len(words) + 1), lambda i: {same})"


_SETS = ", ".join(
    f"('{label}', {words}, {[word for word in words if word in DISTINCTIVE.get(label, words)]}, {needed(len(words), CONTAINMENT)}, {span_of(len(sentence.split()))})"
    for label, sentences in TEMPLATES.items() for sentence in sentences for words in [sorted(set(sentence.split()))]
)
_PLACES = f"list_concat({', '.join(_phrase(phrase) for phrase in PHRASES)})"
_BASE = ", ".join(f"CASE WHEN len({_phrase(phrase)}) > 0 THEN '{label}' END" for phrase, label in PHRASES.items())

#: Every window of a template's span that starts with a word of the template, in the texts with enough of its words.
LICENSES = f"""
WITH templates(label, wanted, telling, least, span) AS (VALUES {_SETS}),
word_lists AS (SELECT row_number() OVER () AS doc, doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
base AS (
  SELECT doc, doc_id, len(words) AS n_words, {_PLACES} AS places, list_filter([{_BASE}], lambda l: l IS NOT NULL) AS base_list FROM word_lists),
starts AS (
  SELECT doc, label, wanted, telling, least, span, words, unnest(range(1, len(words) + 1)) AS i
  FROM word_lists, templates WHERE len(list_intersect(words, wanted)) >= least),
blocks AS (
  SELECT doc, label, least, len(wanted) AS size, list_intersect(words[i:i + span - 1], wanted) AS block, telling
  FROM starts WHERE list_contains(wanted, words[i])),
met AS (SELECT doc, label, len(block) / size AS share FROM blocks WHERE len(block) >= least AND list_has_any(block, telling)),
found AS (SELECT doc, list(DISTINCT label) AS labels, max(share) AS best FROM met GROUP BY doc)
SELECT b.doc_id, n_words, len(places) AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
       array_to_string(list_sort(base_list), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base_list, coalesce(labels, CAST([] AS VARCHAR[]))))), ',') AS labels,
       CASE WHEN len(base_list) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM base b LEFT JOIN found f ON b.doc = f.doc
"""

COPIES = f"""
WITH hashed AS (SELECT doc_id, sha256(translate(coalesce(text, ''), {UPPER}, {LOWER})) AS text_sha256 FROM documents),
grouped AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM hashed JOIN grouped USING (text_sha256)
"""

_LETTERS = "(VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16))"

FILTER_AUDIT = f"""
WITH plain AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, list_filter(string_split(translate(text, {SPACE}, repeat(' ', 6)), ' '), lambda w: w <> '') AS words FROM plain),
firsts AS (SELECT text, min(doc_id) AS first_id FROM plain GROUP BY text),
failed AS (
  SELECT doc_id, part,
         CAST(len(words) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT)
         + 4 * CAST(100 * (length(s.text) - length(translate(s.text, {UPPER}, ''))) > 10 * length(s.text) AS INT)
         + 8 * CAST(length(s.text) <> length(translate(s.text, '#$%&*|', '')) AS INT) + 16 * CAST(doc_id > first_id AS INT) AS fails
  FROM split s JOIN firsts f ON s.text = f.text),
told AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
  FROM failed LEFT JOIN told USING (doc_id) GROUP BY part, fails),
orders AS (
  SELECT concat(a.l, b.l, c.l, d.l, e.l) AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM {_LETTERS} a(l, bit), {_LETTERS} b(l, bit), {_LETTERS} c(l, bit), {_LETTERS} d(l, bit), {_LETTERS} e(l, bit)
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS earlier
  FROM (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM orders) a),
counted AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (WHERE fails & (earlier | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE fails & earlier = 0 AND fails & bit <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE fails & earlier <> 0 AND fails & bit <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = bit), 0) AS unique_fails,
         coalesce(sum(n_good) FILTER (WHERE fails & earlier = 0 AND fails & bit <> 0), 0) AS good_lost,
         coalesce(sum(n_toxic) FILTER (WHERE fails & earlier = 0 AND fails & bit <> 0), 0) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

#: Levels that the statement of the manifest writes out: enough for 16 ** 6 documents of a source and 16 ** 3 sources.
SOURCE_LEVELS, TOP_LEVELS = 6, 3


def _sized(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(map(_sized, ('doc_id', 'source', 'lang', 'n_chars', text)))}))"


def _crc32(text: str) -> str:
    shifted = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {shifted}), 4294967295)"


def _levels(tree: str, levels: int) -> str:
    """CTEs that lift tree_0 (key, place, h): tree_i has the nodes of level i, tree_run_i their runs where a tree goes on above."""
    out = []
    for i in range(levels):
        out.append(f"""
{tree}_run_{i} AS (
  SELECT key, place // 16 AS run, string_agg(h, '' ORDER BY place) AS digests FROM {tree}_{i}
  WHERE key IN (SELECT key FROM {tree}_{i} GROUP BY key HAVING count(*) > 1) GROUP BY key, run),
{tree}_{i + 1} AS (SELECT key, run AS place, sha256(digests) AS h FROM {tree}_run_{i}),""")
    roots = " UNION ALL ".join(f"SELECT key, min(h) AS h FROM {tree}_{i} GROUP BY key HAVING count(*) = 1" for i in range(levels + 1))
    return "".join(out) + f"\n{tree}_roots AS ({roots}),"


def _folds(tree: str, levels: int, start: str, name: str) -> tuple[str, str]:
    """CTEs that carry start (doc_id, key, place, h, proof) through the runs of a tree."""
    out, last = [], start
    for i in range(levels):
        left, right = "substr(digests, 1, 64 * (place % 16))", "substr(digests, 64 * (place % 16) + 65)"
        out.append(f"""
{name}_{i} AS (
  SELECT f.doc_id, f.key, f.place // 16 AS place, CASE WHEN digests IS NULL THEN h ELSE sha256(concat({left}, h, {right})) END AS h,
         CASE WHEN digests IS NULL THEN proof ELSE concat(proof, {left}, {right}) END AS proof
  FROM {last} f LEFT JOIN {tree}_run_{i} r ON f.key = r.key AND f.place // 16 = r.run),""")
        last = f"{name}_{i}"
    return "".join(out), last


_IN_SOURCE, _AT_SUBROOT = _folds("tree", SOURCE_LEVELS, "shown", "fold")
_OVER_SOURCES, _AT_ROOT = _folds("top", TOP_LEVELS, "at_source", "over")

MANIFEST = f"""
WITH leaves AS (
  SELECT doc_id, coalesce('/' || source, '') AS key, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place,
         {_leaf('text')} AS leaf, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf(f"translate(text, {UPPER}, {LOWER})")} END AS changed
  FROM (SELECT doc_id, CAST(source AS VARCHAR) AS source, lang, n_chars, text FROM documents) d),
tree_0 AS (SELECT key, place, leaf AS h FROM leaves),{_levels("tree", SOURCE_LEVELS)}
sources AS (SELECT key AS name, '' AS key, row_number() OVER (ORDER BY key) - 1 AS place, h FROM tree_roots),
top_0 AS (SELECT key, place, h FROM sources),{_levels("top", TOP_LEVELS)}
shown AS (SELECT doc_id, key, place, coalesce(changed, leaf) AS h, '' AS proof FROM leaves),{_IN_SOURCE}
at_source AS (SELECT f.doc_id, s.key, s.place, f.h, f.proof FROM {_AT_SUBROOT} f JOIN sources s ON f.key = s.name),{_OVER_SOURCES}
top_root AS (SELECT h AS root FROM top_roots)
SELECT l.doc_id, l.leaf, s.h AS subroot, root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM leaves l JOIN sources s ON l.key = s.name JOIN {_AT_ROOT} f ON l.doc_id = f.doc_id CROSS JOIN top_root
"""

STATEMENTS: dict[str, str] = {
    "op2_license_scan": LICENSES,
    "op4_line_dedup": LINES,
    "op7_quality_rules": QUALITY,
    "op11_merkle_manifest": MANIFEST,
    "op12_filter_audit": FILTER_AUDIT,
    "op13_exact_dedup": COPIES,
}
