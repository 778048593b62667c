"""The queries of this subpackage that SQL can express, as standalone SQL."""

from __future__ import annotations

_LINE_DEDUP = r"""
WITH raw AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts, text IS NULL AS missing FROM documents
),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line FROM raw),
filled AS (
  SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM lines
  WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
),
sized AS (SELECT *, len(regexp_split_to_array(line, '[\x20\x09-\x0D]+')) AS words FROM filled),
ahead AS (
  SELECT *, lead(line) OVER w AS line1, lead(line, 2) OVER w AS line2, lead(words) OVER w AS words1,
    lead(words, 2) OVER w AS words2, lead(pos) OVER w AS pos1, lead(pos, 2) OVER w AS pos2
  FROM sized WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
runs AS (
  SELECT doc_id, pos, CASE
    WHEN words >= 50 THEN [line]
    WHEN words + words1 >= 50 THEN [line, line1]
    WHEN line2 IS NOT NULL THEN [line, line1, line2] END AS run, [pos, pos1, pos2] AS places
  FROM ahead
  UNION ALL
  -- The shortest that end at a line, where they are not the shortest that start at theirs.
  SELECT doc_id, pos, [line, line1], [pos, pos1] FROM ahead WHERE words >= 50 AND words1 < 50
  UNION ALL
  SELECT doc_id, pos, [line, line1, line2], [pos, pos1, pos2] FROM ahead
  WHERE words + words1 >= 50 AND words1 + words2 < 50
),
ranked AS (
  SELECT doc_id, places[1:len(run)] AS places, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS turn
  FROM runs WHERE run IS NOT NULL
),
gone AS (SELECT DISTINCT doc_id, unnest(places) AS pos FROM ranked WHERE turn > 1),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CASE WHEN missing THEN 0 ELSE len(parts)::INTEGER END AS lines_in,
  coalesce(n, 0)::INTEGER AS lines_removed, CASE WHEN NOT missing THEN md5(coalesce(text, '')) END AS kept_md5
FROM raw LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

# Four digits of base32 are five of the hexadecimal ones.
_WARC = r"""
WITH filled AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
),
known AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first
  FROM filled
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM known
"""

_FILL_MIDDLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents
),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n, ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
    ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4
  FROM cut
),
planned AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
),
parts AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
    array_to_string(units[high + 1:], '') AS suffix
  FROM planned
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

_NGRAM_JOIN = r"""
WITH RECURSIVE
split AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
grams AS (
  SELECT DISTINCT row, array_to_string(words[i:i + 4], ' ') AS gram
  FROM (SELECT row, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS i FROM split)
),
sizes AS (SELECT row, count(*) AS n FROM grams GROUP BY row),
counted AS (
  SELECT a.row, b.row AS other, count(*) AS same FROM grams a JOIN grams b USING (gram) WHERE a.row <> b.row GROUP BY a.row, b.row
),
links AS (
  SELECT o.row, o.other FROM counted o JOIN sizes s ON s.row = o.row JOIN sizes t ON t.row = o.other
  WHERE 100 * same >= 80 * (s.n + t.n - same)
),
reach AS (
  SELECT row, row AS other FROM split
  UNION SELECT reach.row, links.other FROM reach JOIN links ON links.row = reach.other
),
lowest AS (SELECT reach.row, min(split.doc_id) AS component_id FROM reach JOIN split ON split.row = reach.other GROUP BY reach.row),
linked AS (SELECT row, count(*) AS n_links FROM links GROUP BY row)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM split LEFT JOIN sizes USING (row) LEFT JOIN lowest USING (row) LEFT JOIN linked USING (row)
"""

# Sums go component by component, as the operator's do.
_NEIGHBOURS = """
WITH fine AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id::BIGINT AS vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.row AS ask, b.row AS row, a.vec_id AS query_id, b.vec_id AS vec_id,
    list_reduce(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]), lambda total, x: total + x) AS score
  FROM fine a JOIN fine b ON a.row <> b.row AND len(a.v) = len(b.v) WHERE a.vec_id % 20 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ask ORDER BY score DESC, vec_id, row) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# Every aligned pair of document, item and shift with enough equal tokens, and every stretch of it.
_DECONTAMINATE = r"""
WITH items AS MATERIALIZED (
  SELECT row_number() OVER () AS item, item_id, tokens, len(tokens) AS n, least(15, len(tokens)) AS need
  FROM (SELECT DISTINCT item_id::BIGINT AS item_id,
    regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') AS tokens FROM benchmark)
  WHERE len(tokens) > 0 AND item_id IS NOT NULL
),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') AS tokens
  FROM documents
),
doc_words AS (SELECT row, unnest(tokens) AS token, unnest(range(len(tokens))) AS p FROM docs),
item_words AS (SELECT item, unnest(tokens) AS token, unnest(range(n)) AS j FROM items),
equal AS MATERIALIZED (SELECT row, item, p - j AS shift, j FROM doc_words JOIN item_words USING (token)),
diagonals AS (
  SELECT row, item, shift, need, greatest(0, -shift) AS lo, least(n, len(docs.tokens) - shift) AS hi
  FROM (SELECT row, item, shift, count(*) AS same FROM equal GROUP BY row, item, shift) JOIN items USING (item) JOIN docs USING (row)
  WHERE 5 * same >= 4 * need
),
points AS (SELECT row, item, shift, need, unnest(range(lo, hi + 1)) AS j FROM diagonals WHERE hi - lo >= need),
sums AS MATERIALIZED (
  SELECT row, item, shift, need, j, count(e.j) OVER (PARTITION BY row, item, shift ORDER BY j
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM points LEFT JOIN equal e USING (row, item, shift, j)
),
covered AS (
  SELECT DISTINCT row, item, shift, unnest(range(a.j, b.j)) AS j FROM sums a JOIN sums b USING (row, item, shift)
  WHERE b.j - a.j >= a.need AND 5 * (b.before - a.before) >= 4 * (b.j - a.j)
),
runs AS (
  SELECT row, item, count(*) AS length
  FROM (SELECT *, j - row_number() OVER (PARTITION BY row, item, shift ORDER BY j) AS island FROM covered)
  GROUP BY row, item, shift, island
),
per AS (
  SELECT row, count(DISTINCT item_id) AS n_items, min(item_id) AS first_item, max(length) AS longest
  FROM runs JOIN items USING (item) GROUP BY row
)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0)::BIGINT AS n_items, first_item,
  coalesce(longest, 0)::BIGINT AS longest
FROM docs LEFT JOIN per USING (row)
"""

# The well-formed code points of UTF-8 as pairs of hexadecimal digits with a blank after each, and the beginnings of such.
_CODE_POINT = ("[0-7]. |(C[2-9A-F]|D.) [89AB]. |(E0 [AB].|E[1-9A-CEF] [89AB].|ED [89].) [89AB]. "
               "|(F0 [9AB].|F[1-3] [89AB].|F4 8.) [89AB]. [89AB]. ")
_BEGINNING = "E0 [AB]. |E[1-9A-CEF] [89AB]. |ED [89]. |(F0 [9AB].|F[1-3] [89AB].|F4 8.) ([89AB]. )?|.. "

_REPEATED_BYTES = f"""
WITH raw AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS data FROM documents
),
strings AS (
  SELECT row, pos, md5(data[pos + 1:pos + 400]) AS name
  FROM (SELECT row, data, unnest(range(octet_length(data) - 399)) AS pos FROM raw WHERE octet_length(data) >= 400)
),
twice AS (SELECT row, pos FROM (SELECT row, pos, count(*) OVER (PARTITION BY name) AS n FROM strings) WHERE n > 1),
islands AS (
  SELECT row, pos, sum(starts) OVER (PARTITION BY row ORDER BY pos) AS island
  FROM (SELECT row, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY row ORDER BY pos) <= 400 THEN 0 ELSE 1 END AS starts FROM twice)
),
spans AS (SELECT row, min(pos) AS low, max(pos) + 400 AS high FROM islands GROUP BY row, island),
cut AS (
  SELECT row, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
    string_agg(hex(data[before + 1:low]), '' ORDER BY low) AS pieces
  FROM (SELECT *, coalesce(lag(high) OVER (PARTITION BY row ORDER BY low), 0) AS before FROM spans) JOIN raw USING (row)
  GROUP BY row
),
kept AS (
  SELECT doc_id, octet_length(data) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    CASE WHEN n_spans IS NULL THEN hex(data) ELSE pieces || hex(data[last + 1:octet_length(data)]) END AS kept
  FROM raw LEFT JOIN cut USING (row)
)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans,
  sha256(unhex(kept)) AS kept_sha256,
  decode(unhex(array_to_string(list_transform(regexp_extract_all(regexp_replace(kept, '(..)', '\\1 ', 'g'), '{_CODE_POINT}|{_BEGINNING}'),
    lambda c: CASE WHEN regexp_full_match(c, '{_CODE_POINT}') THEN replace(c, ' ', '') ELSE 'EFBFBD' END), ''))) AS kept_text
FROM kept
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ann_codes": _NEIGHBOURS, "op2_decontaminate": _DECONTAMINATE, "op3_suffix_dedup": _REPEATED_BYTES,
            "op5_line_dedup": _LINE_DEDUP, "op6_warc": _WARC, "op12_fill_middle": _FILL_MIDDLE, "op13_ngram_join": _NGRAM_JOIN}
