"""DuckDB statements that give the rows of the document queries by another way."""

# Every pair that shares a shingle is counted in full; no signature, no bucket.
NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 3), ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
edges AS (SELECT x AS u, y AS v FROM links UNION SELECT y, x FROM links),
reach AS (SELECT u, v FROM edges UNION SELECT r.u, e.v FROM reach r JOIN edges e ON e.u = r.v),
roots AS (SELECT u, min(v) AS v FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.v, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(r.v, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN roots r ON r.u = d.doc_id
"""

DECONTAMINATION = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
    FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
places AS (
    SELECT r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
    FROM (SELECT r, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i FROM docs, (SELECT DISTINCT k FROM windows))),
found AS (SELECT r, i, k, item_id FROM places JOIN windows USING (k, s)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
named AS (
    SELECT r, count(*) AS n, string_agg(t, ',' ORDER BY t) AS ids
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS t FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

# The crc32 of every text byte by byte, with a table made from its polynomial; shards and slots from plain running sums.
BYTE_SHARDS = r"""
WITH steps AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
sized AS (
    SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
               lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295::BIGINT) AS text_crc32
    FROM documents, steps),
placed AS (
    SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
           sum(size) OVER () AS total FROM sized),
dealt AS (SELECT *, least(23, ((2 * start + size) * 24) // (2 * total))::INT AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, NULL::INT AS grown_shard
FROM dealt
"""

EXACT_DEDUP = r"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

# Every document that holds a term of an item is scored in full.
RANKED_SEARCH = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT row_number() OVER () AS q, item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
wanted AS (SELECT q, item_id, t, count(*) AS k FROM items GROUP BY ALL),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM docs),
held AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) SEMI JOIN items USING (t) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY t, n),
lengths AS (SELECT r, doc_id, 75 + (25 * len(w) * n) // l AS m FROM docs, totals WHERE len(w) > 0),
scores AS (
    SELECT q, item_id, r, doc_id, sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM wanted JOIN weights USING (t) JOIN held USING (t) JOIN lengths USING (r) GROUP BY ALL),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""

FILL_IN_MIDDLE = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
numbers AS (
    SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(x, 9, 8))::BIGINT % (n + 1) AS c2,
           ('0x' || substr(x, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(x, 25, 8))::BIGINT % 100 AS h4 FROM drawn),
cut AS (
    SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
