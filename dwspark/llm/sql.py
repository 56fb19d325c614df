"""DuckDB SQL of the queries that SQL can express."""

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, {_ASCII_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM lines),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (key) GROUP BY doc_id"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

_SHINGLES = f"""
words AS (
  SELECT {{id}}, list_filter(regexp_split_to_array({_ASCII_LOWER.format("coalesce(text, '')")},
                             '[ ' || chr(9) || '-' || chr(13) || ']+'), lambda x: x <> '') AS w
  FROM {{table}}),
{{name}} AS (
  SELECT DISTINCT {{id}}, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM words)"""

NEAR_DEDUP = f"""
WITH RECURSIVE {_SHINGLES.format(id="doc_id", table="documents", name="shingles")},
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
  WHERE 100 * same >= 75 * (sx.n + sy.n - same)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT x AS doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(y) AS component_id, x = min(y) AS kept
FROM reach LEFT JOIN sizes s ON s.doc_id = x GROUP BY x"""

CONTAINED_ITEMS = f"""
WITH {_SHINGLES.format(id="doc_id", table="documents", name="of_docs")},
{_SHINGLES.format(id="item_id", table="benchmark", name="of_items").replace("words AS", "item_words AS").replace("FROM words", "FROM item_words")},
sizes AS (SELECT item_id, count(*) AS n_item FROM of_items GROUP BY item_id),
pairs AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM of_docs JOIN of_items USING (shingle) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM pairs JOIN sizes USING (item_id) WHERE 100 * n_shared >= 75 * n_item"""

_TERMS = rf"regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
held AS (SELECT r, doc_id, t, len(t) AS n FROM docs WHERE len(t) > 0),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM held),
asked AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
found AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM held)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM found, total GROUP BY term),
scored AS (
  SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // nt)))) AS BIGINT) AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term) JOIN held USING (r), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""

REPEATED_SPANS = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ ' || chr(9) || '-' || chr(13) || ']+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS span
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts)),
firsts AS (SELECT span, min(doc_id) AS least FROM windows GROUP BY span),
hits AS (SELECT r, i, TRUE AS hit FROM windows JOIN firsts USING (span) WHERE least < doc_id),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
marked AS (
  SELECT r, i, word, coalesce(i - max(CASE WHEN hit THEN i END) OVER (PARTITION BY r ORDER BY i) < 50, FALSE) AS gone
  FROM words LEFT JOIN hits USING (r, i)),
kept AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS rest
  FROM marked GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)"""

# the checksum of a decimal number, bit by bit: each character, then eight marks that stand for a shift
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST({} AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda x, e: CASE WHEN e >= 0 THEN xor(x, e) ELSE xor(x >> 1, (x & 1) * 3988292384) END))"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY i) AS ts, {_CRC32.format('conv_id')} % 9 AS h FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.ts, [])[1:o.h], o.ts[o.h + 1:]) AS s
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
prefixes AS (SELECT conv_id, s, d, s[1:d] AS p FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(s) = d) AS ends
  FROM prefixes GROUP BY p, d),
edges AS (SELECT c.p AS p, u.p AS up, u.conv_id AS up_id FROM nodes c JOIN nodes u ON u.d = c.d - 1 AND u.p = c.p[1:c.d - 1]),
children AS (SELECT up AS p, count(*) AS k FROM edges GROUP BY up),
below AS (
  SELECT u.p AS p, sum(CASE WHEN k.k IS NULL THEN 1 ELSE 0 END) AS leaves,
         sum(CASE WHEN c.d = 0 THEN 0 ELSE (c.n - 1) * octet_length(encode(c.p[c.d].text)) END) AS saved
  FROM nodes c LEFT JOIN children k ON k.p = c.p JOIN nodes u ON u.d <= c.d AND u.p = c.p[1:u.d] GROUP BY u.p)
SELECT n.conv_id, n.d AS depth, e.up_id AS parent_conv_id, n.n AS n_convs, coalesce(k.k, 0) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.p = n.p LEFT JOIN edges e ON e.p = n.p LEFT JOIN children k ON k.p = n.p"""
