"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP4 = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(v, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (
  SELECT h.*, (SELECT arg_max(rh || rp || ' ' || v, length(rh || rp) * 1000 + length(rh)) FROM r
               WHERE (h.host = rh OR ends_with(h.host, '.' || rh)) AND starts_with(h.path, rp)) AS hit
  FROM h)
SELECT page_id, host, path, split_part(hit, ' ', 1) AS rule,
       coalesce(split_part(hit, ' ', 2), 'allow') AS verdict
FROM m
"""

OP8 = """
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS ln
  FROM documents WHERE text IS NOT NULL),
l AS (SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS word FROM raw),
numbered AS (
  SELECT *, sum(CASE WHEN word THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ln) AS seq FROM l),
u AS (
  SELECT doc_id, seq, line, length(line) AS n,
         sum(length(line)) OVER (PARTITION BY doc_id ORDER BY seq) AS upto
  FROM numbered WHERE word),
ahead AS (
  SELECT a.doc_id, a.seq AS s, min(b.seq) AS e FROM u a JOIN u b
    ON a.doc_id = b.doc_id AND b.seq BETWEEN a.seq AND a.seq + 99 AND b.upto - a.upto + a.n >= 100
  GROUP BY ALL),
behind AS (
  SELECT b.doc_id, max(a.seq) AS s, b.seq AS e FROM u b JOIN u a
    ON a.doc_id = b.doc_id AND a.seq BETWEEN b.seq - 99 AND b.seq AND b.upto - a.upto + a.n >= 100
  GROUP BY b.doc_id, b.seq),
blocks AS (SELECT * FROM ahead UNION SELECT * FROM behind),
content AS (
  SELECT k.doc_id, k.s, k.e, list(u.line ORDER BY u.seq) AS lines
  FROM blocks k JOIN u ON u.doc_id = k.doc_id AND u.seq BETWEEN k.s AND k.e GROUP BY ALL),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY lines ORDER BY doc_id, s) AS nth FROM content),
dropped AS (
  SELECT DISTINCT m.doc_id, u.seq FROM marked m JOIN u
    ON u.doc_id = m.doc_id AND u.seq BETWEEN m.s AND m.e WHERE nth > 1),
gone AS (
  SELECT doc_id, seq, seq - lag(seq) OVER (PARTITION BY doc_id ORDER BY seq) AS gap FROM dropped),
gone_by_doc AS (
  SELECT doc_id, count(*) AS n_deleted, count(*) FILTER (gap IS NULL OR gap > 1) AS n_runs FROM gone GROUP BY doc_id),
rest AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.ln) AS kept
  FROM numbered n LEFT JOIN dropped d ON n.doc_id = d.doc_id AND n.seq = d.seq
  WHERE d.doc_id IS NULL GROUP BY n.doc_id),
lines_by_doc AS (SELECT doc_id, count(*) AS n_lines FROM u GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted, coalesce(n_runs, 0) AS n_runs,
       CASE WHEN d.text IS NULL THEN NULL ELSE length(coalesce(kept, '')) END AS kept_chars,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN rest USING (doc_id) LEFT JOIN gone_by_doc USING (doc_id) LEFT JOIN lines_by_doc USING (doc_id)
"""

OP9 = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
iw AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
ds AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS sh
  FROM dw WHERE len(w) > 0),
its AS (
  SELECT DISTINCT i, item_id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS sh
  FROM iw WHERE len(w) > 0),
size AS (SELECT i, count(*) AS n_item FROM its GROUP BY i)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM ds JOIN its USING (sh) JOIN size USING (i)
GROUP BY doc_id, i, item_id, n_item HAVING count(*) >= 0.75 * n_item
"""

OP11 = """
WITH low AS (
  SELECT rowid AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
d AS (SELECT r, doc_id, len(w) AS n, w FROM low WHERE len(w) > 0),
size AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM d),
terms AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM terms) GROUP BY ALL),
df AS (
  SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, size GROUP BY term),
scored AS (
  SELECT i, item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * nn) // l)))))::BIGINT AS score
  FROM terms JOIN tf USING (term) JOIN df USING (term), size GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP12 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS r FROM pages),
q AS (
  SELECT *, sha1(html) AS h, first_value(page_id) OVER same AS top, row_number() OVER same AS nth FROM p
  WINDOW same AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST, r DESC))
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               (((('0x' || substr(h, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::INTEGER, 1)
                        FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN top END AS refers_to, TRUE AS verified
FROM q
"""

ORACLE = {"op4_url_rules": OP4, "op8_line_runs": OP8, "op9_decontamination": OP9, "op11_ranked_search": OP11, "op12_warc": OP12}
