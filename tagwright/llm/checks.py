"""Queries of this folder as SQL for another engine, each over the whole tables."""

from __future__ import annotations

from tagwright.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def nearest(book: str) -> str:
    """Each part of each vector with its nearest entry of ``book`` and the squared distance."""
    return f"""(
  SELECT row, vec_id, label, part, p, entry, d FROM (
    SELECT x.row, x.vec_id, x.label, x.part, x.p, b.entry,
      CAST(coalesce(list_sum(list_transform(list_zip(x.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0) AS BIGINT) AS d
    FROM pieces x JOIN {book} b ON b.part = x.part)
  QUALIFY row_number() OVER (PARTITION BY row, part ORDER BY d, entry) = 1)"""


def moved(book: str) -> str:
    """``book`` with its entries moved to the means of the parts nearest to them."""
    return f"""(
  SELECT b.part, b.entry, coalesce(m.p, b.p) AS p FROM {book} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY pos) AS p FROM (
      SELECT part, entry, pos, CAST(floor(sum(x) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS mean FROM (
        SELECT part, entry, unnest(p) AS x, unnest(range(len(p))) AS pos FROM {nearest(book)})
      GROUP BY part, entry, pos)
    GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry)"""


ROUND_TABLES = "".join(f"book{at + 1} AS MATERIALIZED {moved(f'book{at}')},\n" for at in range(ROUNDS))

VECTOR_CODES = f"""WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS row, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT row, vec_id, label, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS p
  FROM kept, (SELECT unnest(range({PARTS})) AS part)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, p FROM pieces WHERE row <= {ENTRIES}),
{ROUND_TABLES}coded AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(label) AS label,
    lower(string_agg(printf('%02x', entry), '' ORDER BY part)) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM {nearest(f'book{ROUNDS}')} GROUP BY row),
digest AS (
  SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest"""



def crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda mark: CAST(ascii(mark) AS UBIGINT))"
    step = "xor(s >> 1, (s & 1) * 3988292384::UBIGINT)"
    byte = f"list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda s, z: {step})"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda a, b: {byte}), 4294967295::UBIGINT)"


# A path is the digests of its turns one after the other, 32 characters each.
PREFIX_TRIE = f"""WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - ((c % 20) + 20) % 20 AS base, {crc32('CAST(c AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT c FROM turns)),
built AS (
  SELECT v.c, 0 AS own, t.i, digest, words FROM convs v JOIN turns t ON t.c = v.base AND t.i <= v.h
  UNION ALL SELECT v.c, 1, t.i, digest, words FROM convs v JOIN turns t ON t.c = v.c AND t.i > v.h),
paths AS (
  SELECT c, row_number() OVER place AS depth, string_agg(digest, '') OVER place AS path, words
  FROM built WINDOW place AS (PARTITION BY c ORDER BY own, i)
  UNION ALL SELECT c, 0, '', 0 FROM convs),
lengths AS (SELECT c, max(depth) AS length FROM paths GROUP BY c),
nodes AS (
  SELECT path, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE depth = length) AS ends
  FROM paths JOIN lengths USING (c) GROUP BY path),
children AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (
  SELECT v.*, coalesce(k.n, 0) AS n_children, CAST(k.n IS NULL AS INT) AS leaf, (n_convs - 1) * words AS saved
  FROM nodes v LEFT JOIN children k ON k.path = v.path),
subtrees AS (
  SELECT left(path, 32 * up) AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT path, leaf, saved, unnest(range(depth + 1)) AS up FROM valued) GROUP BY 1)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs,
  CAST(v.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM valued v JOIN subtrees s ON s.path = v.path
LEFT JOIN nodes p ON v.depth > 0 AND p.path = left(v.path, 32 * (v.depth - 1))"""


WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT row, doc_id, text, regexp_extract_all(text, '{WORD}') AS words FROM texts),
places AS (SELECT row, words, unnest(range(1, len(words) - 1)) AS place FROM words WHERE len(words) >= 3),
seen AS (
  SELECT row, place, count(*) OVER (PARTITION BY row, words[place], words[place + 1], words[place + 2]) AS n FROM places),
repeated AS (
  SELECT row, count(DISTINCT place + step) AS n_repeat_words
  FROM seen, (SELECT unnest(range(3)) AS step) WHERE n > 1 GROUP BY row),
split AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts),
lines AS (
  SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM split WHERE regexp_matches(line, '{WORD}') GROUP BY row),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda word: length(word))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_marks, coalesce(n_lines, 0) AS n_lines,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN repeated USING (row) LEFT JOIN lines USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 10 * n_marks > 3 * n_words
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * n_dup_lines > 35 * n_lines) AS kept
FROM measured"""

CHECKS: dict[str, str] = {
    "op7_quality": QUALITY,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_vector_codes": VECTOR_CODES,
}
