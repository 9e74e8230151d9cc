"""SQL twins of the queries that SQL can express."""

from . import licenses

_TOKENS = r"[^\x20\x09-\x0D]+"
_NORMAL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
  w AS (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 50)) AS s FROM d WHERE length(h) >= 100),
  g AS (SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS x FROM w),
  f AS (SELECT x, min(doc_id) AS first_id FROM g GROUP BY x HAVING count(*) > 1),
  hit AS (SELECT g.doc_id, g.s FROM g JOIN f ON g.x = f.x AND f.first_id < g.doc_id),
  step AS (SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50
      OR lag(s) OVER (PARTITION BY doc_id ORDER BY s) IS NULL THEN 1 ELSE 0 END AS new FROM hit),
  run AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM step),
  span AS (SELECT doc_id, r, min(s) AS a, max(s) + 50 AS b FROM run GROUP BY doc_id, r),
  spans AS (SELECT doc_id, count(*) AS n, sum(b - a) AS removed,
      list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  CASE WHEN n IS NULL THEN sha256(unhex(h)) ELSE sha256(unhex(
    list_reduce(list_transform(generate_series(0, n), lambda i:
      substr(h, CASE WHEN i = 0 THEN 1 ELSE 2 * b[i] + 1 END,
        2 * (CASE WHEN i = n THEN length(h) // 2 ELSE a[i + 1] END - CASE WHEN i = 0 THEN 0 ELSE b[i] END))),
      lambda p, q: p || q))) END AS kept_sha256
FROM d LEFT JOIN spans USING (doc_id)
"""

OP3 = f"""
WITH RECURSIVE t AS (SELECT doc_id, source, length(text) AS chars, CAST(coalesce(len(regexp_extract_all(text, '{_TOKENS}')), 0) AS BIGINT) AS size,
    (CAST(CAST('0x' || substr(md5('11:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5::DOUBLE) / pow(2, 52) AS u FROM documents),
  d AS (SELECT doc_id, source, size, -ln(u) / coalesce(greatest(0.25::DOUBLE, 1 - abs(CAST(chars AS DOUBLE) / (size + 1) - 6) / 8), 1) AS place FROM t),
  s AS (SELECT source, n, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source)),
  step AS (SELECT 0::DOUBLE AS level, 0 AS k UNION ALL
    SELECT raised, k + 1 FROM (SELECT level, k, (SELECT (1.5::DOUBLE * sum(n) - 2::DOUBLE * sum(CASE WHEN level * w >= 2::DOUBLE * n THEN n ELSE 0 END))
      / nullif(sum(CASE WHEN level * w >= 2::DOUBLE * n THEN 0 ELSE w END), 0) FROM s) AS raised FROM step) WHERE raised > level),
  goal AS (SELECT source, n, least(2::DOUBLE * n, (SELECT max(level) FROM step) * w) AS target FROM s),
  part AS (SELECT *, coalesce(floor(target / nullif(n, 0)), 0) AS epochs FROM goal),
  run AS (SELECT d.*, n, target, epochs, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN part ON d.source IS NOT DISTINCT FROM part.source)
SELECT doc_id, size, n AS source_size, target,
  CAST(size * (epochs + CASE WHEN before + CAST(size AS DOUBLE) / 2 <= target - epochs * n THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM run
"""

OP6 = f"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TOKENS}') AS w FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS x FROM t),
  e AS (SELECT doc_id, unnest(x) AS g FROM s),
  n AS (SELECT doc_id, CAST(len(x) AS BIGINT) AS n FROM s),
  rare AS (SELECT doc_id, g FROM (SELECT e.doc_id, e.g, n.n, row_number() OVER (PARTITION BY e.doc_id ORDER BY c, e.g) AS r
      FROM e JOIN (SELECT g, count(*) AS c FROM e GROUP BY g) USING (g) JOIN n USING (doc_id)) WHERE r <= n - ceil(0.85 * n) + 1),
  pair AS (SELECT DISTINCT a.doc_id AS u, b.doc_id AS v FROM rare a JOIN rare b ON a.g = b.g AND a.doc_id < b.doc_id),
  both_ AS (SELECT u, v, count(*) AS c FROM pair JOIN e a ON a.doc_id = u JOIN e b ON b.doc_id = v AND a.g = b.g GROUP BY u, v),
  link AS (SELECT u, v FROM both_ JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
  two AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
  reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, two.v FROM reach r JOIN two ON r.b = two.u)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept
FROM n JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

OP7 = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_TOKENS}') AS w FROM documents),
  g AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS x
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM t WHERE len(w) >= 20)),
  hit AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS r FROM g) WHERE r > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS i FROM hit),
  sets AS (SELECT doc_id, count(*) AS n, list(i) AS i FROM gone GROUP BY doc_id),
  word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM t),
  kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS k FROM word w ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN sets USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP9 = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS h FROM pages),
  bits AS (SELECT page_id, n, h, array_to_string(list_transform(generate_series(1, 40), lambda i:
      ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][
        strpos('0123456789abcdef', substr(h, i, 1))]), '') AS b FROM p),
  coded AS (SELECT page_id, n, array_to_string(list_transform(generate_series(0, 31), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(generate_series(1, 5), lambda j:
        CAST(substr(b, CAST(5 * i + j AS BIGINT), 1) AS INT) * CAST(pow(2, 5 - j) AS INT))) AS BIGINT), 1)), '') AS d FROM bits),
  firsts AS (SELECT page_id, n, d, min(page_id) OVER (PARTITION BY d) AS f FROM coded)
SELECT c.page_id, pages.url, n AS payload_bytes, d AS payload_digest,
  CASE WHEN c.page_id > f THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN c.page_id > f THEN f END AS refers_to
FROM firsts c JOIN pages ON pages.page_id = c.page_id
"""

OP10 = f"""
WITH b AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '{_NORMAL}') AS w FROM benchmark WHERE text IS NOT NULL),
  win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS x
    FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)),
  d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '{_NORMAL}'), []) AS w FROM documents),
  g AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS x
    FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
      FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
  hit AS (SELECT doc_id, s, win.k, item_id FROM g JOIN win ON g.k = win.k AND g.x = win.x),
  words AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS i FROM hit) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS l
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_TEMPLATES = ", ".join(
    "({}, '{}', {}, '{}')".format(i, t.label, t.phrase, " ".join(licenses.words_of(t.text))) for i, t in enumerate(licenses.TEMPLATES))

OP11 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_NORMAL}') AS w FROM documents),
  t AS (SELECT template, label, phrase, string_split(words, ' ') AS w, len(string_split(words, ' ')) AS len
    FROM (VALUES {_TEMPLATES}) AS v (template, label, phrase, words)),
  tg AS (SELECT template, label, phrase, len, s - 1 AS tpos, array_to_string(w[s:s + 2], ' ') AS g
    FROM (SELECT *, unnest(generate_series(1, len - 2)) AS s FROM t)),
  dg AS (SELECT doc_id, s - 1 AS pos, array_to_string(w[s:s + 2], ' ') AS g
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS s FROM d WHERE len(w) > 2)),
  hit AS (SELECT doc_id, template, label, phrase, len, pos, tpos, pos - tpos AS diagonal FROM dg JOIN tg USING (g)),
  vote AS (SELECT doc_id, template, label, phrase, len, diagonal, count(*) AS n, min(pos) AS a, max(pos) + 3 AS b
    FROM hit GROUP BY ALL),
  mark AS (SELECT *, CASE WHEN phrase OR coalesce(diagonal - lag(diagonal) OVER o > least(8, len // 4), true) THEN 1 ELSE 0 END AS new
    FROM vote WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
  part AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM mark),
  merged AS (SELECT doc_id, template, label, phrase, len, span, min(a) AS a, max(b) AS b, max(n) AS best FROM part GROUP BY ALL),
  together AS (SELECT p.doc_id, p.template, p.span, count(DISTINCT h.tpos) AS n
    FROM part p JOIN hit h USING (doc_id, template, diagonal) GROUP BY ALL),
  spans AS (SELECT m.doc_id, m.template, label, phrase, a,
      CAST(CASE WHEN b - a <= len + 8 + len // 4 THEN n ELSE best END AS DOUBLE) / (len - 2) AS coverage
    FROM merged m JOIN together USING (doc_id, template, span)),
  kept AS (SELECT *, template < 3 AS base FROM spans WHERE CASE WHEN phrase THEN coverage >= 1 ELSE coverage >= 0.8 END),
  found AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(a) FILTER (base) AS f, max(a) FILTER (base) AS l, max(coverage) AS score
    FROM kept GROUP BY doc_id),
  names AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels, string_agg(label, ',' ORDER BY label) FILTER (base) AS bases
    FROM (SELECT doc_id, label, bool_or(base) AS base FROM kept GROUP BY doc_id, label) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(f AS BIGINT) AS first_word,
  CAST(l AS BIGINT) AS last_word, coalesce(bases, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN found USING (doc_id) LEFT JOIN names USING (doc_id)
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
  l AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, len(regexp_extract_all(t, '[^\n]*\n|[^\n]+')) AS n,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS r FROM d),
  c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
      WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
  s AS (SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
    array_to_string(u[b + 1:n], '') AS x FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
    ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM s
"""

ORACLES = {
    "op1_suffix_array_dedup": OP1,
    "op3_source_mixing": OP3,
    "op6_minhash_near_dedup": OP6,
    "op7_superkmer_dedup": OP7,
    "op9_warc": OP9,
    "op10_benchmark_decontamination": OP10,
    "op11_license_scan": OP11,
    "op13_fill_in_middle": OP13,
}
