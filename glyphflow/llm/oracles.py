"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

OP3 = """WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages), f AS (SELECT d, min(page_id) AS m FROM d WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d.d AS payload_digest, CASE WHEN n >= 100 AND m <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 100 AND m <> page_id THEN m END AS refers_to
FROM d LEFT JOIN f ON d.d = f.d"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP4 = f"""WITH i AS (SELECT item_id::VARCHAR AS id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT id, len(w[a:a + 9]) AS k, array_to_string(w[a:a + 9], ' ') AS g FROM (SELECT id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS a FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents), lens AS (SELECT DISTINCT k FROM win),
dg AS (SELECT doc_id, a, k, array_to_string(w[a:a + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS a FROM d, lens WHERE len(w) >= k)),
hit AS (SELECT doc_id, a, dg.k, id FROM dg JOIN win ON dg.g = win.g AND dg.k = win.k),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + k)) AS p FROM hit) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS h FROM (SELECT DISTINCT doc_id, id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN s ON d.doc_id = s.doc_id"""

_SOLID = r"'[^\x20\x09-\x0D]+'"
OP10 = f"""WITH b AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_SOLID}) AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_SOLID})) AS ls FROM documents),
tri AS (SELECT doc_id, a, w[a] || chr(1) || w[a + 1] || chr(1) || w[a + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS a FROM b WHERE len(w) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([a, a + 1, a + 2]) AS p FROM tri WHERE (doc_id, g) IN (SELECT (doc_id, g) FROM tri GROUP BY doc_id, g HAVING count(*) > 1)) GROUP BY doc_id),
l AS (SELECT doc_id, source, t, regexp_replace(array_to_string(regexp_extract_all(lower(x), {_SOLID}), ' '), '[0-9]', '0', 'g') AS x, len(regexp_extract_all(x, {_SOLID})) AS k FROM (SELECT doc_id, source, t, unnest(ls) AS x FROM b)),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM l GROUP BY source), many AS (SELECT source, x, count(DISTINCT t) AS n, min(doc_id) AS first FROM l GROUP BY source, x),
often AS (SELECT m.source, x, first FROM many m JOIN hosts h ON m.source IS NOT DISTINCT FROM h.source WHERE m.n > 20 AND m.n > 0.001 * h.n),
gone AS (SELECT doc_id, sum(k)::BIGINT AS n FROM l JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.x = o.x AND doc_id <> first GROUP BY doc_id),
f AS (SELECT b.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_line_words_removed
 FROM b LEFT JOIN rep ON b.doc_id = rep.doc_id LEFT JOIN gone ON b.doc_id = gone.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - n_line_words_removed) >= 20 * n_words AS kept FROM f"""

ORACLES = {"op3_warc": OP3, "op4_decontaminate": OP4, "op10_quality_rules": OP10}
