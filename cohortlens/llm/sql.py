"""DuckDB SQL of the text queries that SQL can express (the same rows by a plainer path)."""

BLANK = r"[\x20\x09-\x0D]+"

LINES = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 1], chr(10))) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM k) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 2)) AS j FROM later),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY j) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_lines, (len(w) - coalesce(n, 0))::BIGINT AS n_deleted, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANK}'), lambda x: x <> '') AS w FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM k) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ITEM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {ITEM_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS h
       FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS h
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.h = bw.h AND dw.n = bw.n),
cover AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(s, ',' ORDER BY s) AS list FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BLANK}'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM shared JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
FROM d LEFT JOIN size USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x) USING (doc_id)
"""

PHRASES = rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, s, ph, f FROM (
  SELECT lang, s, ph, count(*) AS f FROM (
    SELECT lang, s, w[i:i + s - 1] AS ph FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS s)))
  GROUP BY ALL) WHERE f >= 10),
cut AS (SELECT c.lang, c.ph, c.f AS a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, s)) AS k FROM f WHERE s > 1) c
  JOIN f l ON l.lang = c.lang AND l.ph = c.ph[1:k] JOIN f r ON r.lang = c.lang AND r.ph = c.ph[k + 1:]),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) AS o FROM cut) WHERE o = 1),
inner_ AS (SELECT x.lang, x.ph FROM f x JOIN (SELECT lang, f, unnest([ph[1:2], ph[2:3]]) AS ph FROM f WHERE s = 3) y ON x.lang = y.lang AND x.ph = y.ph WHERE 100 * y.f >= 50 * x.f),
left_ AS (SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM best ANTI JOIN inner_ USING (lang, ph))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_) JOIN total USING (lang) WHERE rank <= 2000
"""

PAGES = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
x AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS last FROM p),
d AS (SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> s) & 31)::INT, 1), '' ORDER BY i, s DESC) AS payload_digest
      FROM (SELECT page_id, i, ('0x' || substr(h, 5 * i + 1, 5))::BIGINT AS v FROM x, (SELECT unnest(range(8)) AS i)), (SELECT unnest([0, 5, 10, 15]) AS s) GROUP BY page_id)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM x JOIN d USING (page_id)
"""

SQL: dict[str, str] = {
    "op4_lines": LINES, "op5_substrings": SUBSTRINGS, "op7_decontamination": DECONTAMINATION, "op9_jaccard": JACCARD, "op11_phrases": PHRASES, "op13_warc": PAGES,
}
