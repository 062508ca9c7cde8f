r"""DuckDB twins of the queries that SQL can express, written on their own from the contract.

op7 (fitted scores) and op10 (token ids) have none and are tested against brute force.
"""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
TOKENS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def lower(x: str) -> str:
    return LOWER.format(x)


OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, {PLAIN_WORDS.format('t')} AS w FROM d),
grams AS (SELECT rid, unnest(range(1, greatest(len(w) - 1, 1))) AS i, w FROM w),
keyed AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM grams),
covered AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM keyed WHERE n >= 2) GROUP BY rid),
split AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT rid, line, {PLAIN_WORDS.format('line')} AS w,
    regexp_replace({lower('line')}, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS low,
    len(regexp_extract_all(line, '[\\x20\\x09-\\x0D](?:\\||>|»|›|•|·)[\\x20\\x09-\\x0D]')) AS parts FROM split),
judged AS (SELECT rid, line, len(w) AS n, len(w) > 0 AND (
    (len(w) > 1 AND 100 * len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]|!!|[?][?]'))) > 50 * len(w))
    OR low IN ('home', 'menu', 'login', 'log in', 'sign in', 'sign up', 'register', 'search', 'next', 'previous', 'back to top',
      'skip to content', 'contact us', 'about us', 'share', 'print', 'read more', 'sitemap')
    OR (parts >= 2 AND 5 * parts >= len(w))
    OR (len(w) <= 40 AND regexp_matches(low, 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use cookies|uses cookies|accept cookies|enable javascript|javascript is disabled|lorem ipsum|subscribe to our newsletter|click here to|powered by '))
    OR (len(w) < 20 AND NOT regexp_matches(low, '(?:[.!?:;,]|…|。|！|？)["'')\\]}}]*$'))) AS bad FROM lines),
perline AS (SELECT rid, coalesce(sum(n) FILTER (bad), 0) AS lost, count(*) FILTER (bad) AS bad,
    count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dup FROM judged GROUP BY rid),
m AS (SELECT doc_id, len(w.w) AS n, len(list_aggregate(w.w, 'string_agg', '')) AS chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS symbols, dup, coalesce(c.n, 0) AS rep, bad, lost
  FROM w JOIN perline USING (rid) LEFT JOIN covered c USING (rid))
SELECT doc_id, n::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars, symbols::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines,
  rep::BIGINT AS n_repeat_words, n < 50 OR 100 * rep > 50 * n AS base_failed, bad::BIGINT AS n_bad_lines, lost::BIGINT AS n_lost_words,
  NOT (n < 50 OR 100 * rep > 50 * n) AND 100 * lost <= 50 * n AS kept FROM m
"""

OP2 = f"""
WITH b AS (SELECT item_id::VARCHAR AS item, {TOKENS.format(lower('text'))} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, len(w) AS lw, unnest([array_to_string(w[i:i + least(len(w), 13) - 1], ' ') FOR i IN range(1, greatest(len(w) - 12, 1) + 1)]) AS gram FROM b WHERE len(w) > 0),
sizes AS (SELECT item, least(lw, 13) AS k, gram FROM windows),
d AS (SELECT row_number() OVER () AS rid, doc_id, {TOKENS.format(lower("coalesce(text, '')"))} AS w FROM documents),
places AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM sizes) WHERE len(w) >= k)),
found AS (SELECT rid, i, places.k AS k, item FROM places JOIN sizes USING (gram, k)),
hit AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM found) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM found WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit h USING (rid) LEFT JOIN items t USING (rid)
"""

# Spans from the gaps and matches of one pattern: (rid, kind order, kind, start, end) of good matches.
SPAN_SQL = r"""
SELECT rid, {rank} AS rank, '{kind}' AS kind, start, start + len(m) AS stop FROM (
  SELECT rid, ms[i] AS m, gs[i] AS g, list_sum([len(x) FOR x IN parts[1:i]])::BIGINT + coalesce(list_sum([len(x) FOR x IN ms[1:i - 1]]), 0)::BIGINT AS start FROM (
    SELECT rid, ms, gs, parts, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT rid, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS gs, string_split_regex(t, '{pattern}') AS parts
      FROM d WHERE regexp_matches(t, '{pattern}'))))
WHERE len(g) >= {least}
"""
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]{32,}", 0, 32),
    ("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]+=*", 0, 27),
    ("github", "gh[opsu]_[A-Za-z0-9]+", 0, 40),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 32),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("urlauth", r"[a-z]+://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@", 0, 8),
)
OP5 = "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),\nspans AS (" + " UNION ALL ".join(
    SPAN_SQL.format(rank=i, kind=k, pattern=p, group=g, least=n) for i, (k, p, g, n) in enumerate(KINDS)) + r"""),
s AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans FROM d LEFT JOIN s USING (rid)
"""

OP6 = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
e AS (SELECT *, len('<turn ' || regexp_replace(role, '[\\>]', 'xx', 'g') || '>' || chr(10) || regexp_replace(t, '\\|</?turn', '\\\0', 'g') || '</turn>' || chr(10)) AS n FROM r)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
  coalesce(sum(len(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars FROM e GROUP BY conv_id
"""

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(doc_id, -9223372036854775808) AS doc, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (SELECT *, regexp_replace({lower('line')}, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS key FROM l),
rep AS (SELECT key, max(doc) AS top FROM k WHERE len(key) >= 20 GROUP BY key HAVING count(DISTINCT doc) >= 3),
out AS (SELECT k.rid, i, line, rep.key IS NOT NULL AND doc < top AS gone FROM k LEFT JOIN rep ON k.key = rep.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone) ::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM out JOIN d USING (rid) GROUP BY rid, doc_id
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {PLAIN_WORDS.format(lower("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS r FROM d UNION SELECT x.b, reach.r FROM reach JOIN both_ways x ON x.a = reach.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""

# Templates and phrases of the licence scan, written out as rows.
NOTICES = """(VALUES
  (0, 'agpl', 'under the terms of the gnu affero general public license'),
  (1, 'apache-2.0', 'licensed under the apache license version 2 0'),
  (2, 'bsd', 'redistribution and use in source and binary forms with or without modification are permitted'),
  (3, 'cc-by-nc', 'licensed under cc by nc 4 0'), (4, 'cc-by-nd', 'licensed under cc by nd 4 0'), (5, 'cc-by-sa', 'licensed under cc by sa 4 0'),
  (6, 'cc0', 'creative commons cc0 1 0 universal'),
  (7, 'gpl-2.0', 'licensed under the gnu general public license version 2'), (8, 'gpl-3.0', 'licensed under the gnu general public license version 3'),
  (9, 'isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted'),
  (10, 'lgpl', 'under the terms of the gnu lesser general public license'), (11, 'mit', 'released under the mit license'),
  (12, 'mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software'),
  (13, 'mpl-2.0', 'subject to the terms of the mozilla public license v 2 0'),
  (14, 'unlicense', 'this is free and unencumbered software released into the public domain')) n(t, label, text)"""
MANDATORY = """(VALUES (0, 'affero general public license'), (1, 'apache license'), (1, 'version 2 0'), (2, 'source and binary forms'),
  (2, 'with or without modification'), (3, 'cc by nc'), (4, 'cc by nd'), (5, 'cc by sa'), (6, 'cc0 1 0'), (7, 'gnu general public license version 2'),
  (8, 'gnu general public license version 3'), (9, 'with or without fee'), (10, 'lesser general public license'), (11, 'mit license'),
  (12, 'hereby granted free of charge'), (13, 'mozilla public license'), (14, 'unencumbered software')) m(t, phrase)"""
OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {TOKENS.format(lower("coalesce(text, '')"))} AS w FROM documents),
pos AS (SELECT rid, unnest(w) AS x, unnest(range(len(w))) AS i FROM d),
base AS (SELECT rid, i, label FROM pos JOIN d USING (rid) JOIN (VALUES ('cc', 'cc by', 2, 'cc-by'),
    ('general', 'general public license', 3, 'gpl'), ('all', 'all rights reserved', 3, 'reserved')) b(x, phrase, k, label) USING (x)
  WHERE array_to_string(w[i + 1:i + k], ' ') = phrase),
bases AS (SELECT rid, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM base GROUP BY rid),
tw AS (SELECT t, label, unnest(string_split(text, ' ')) AS x, unnest(range(len(string_split(text, ' ')))) AS p FROM {NOTICES}),
df AS (SELECT v.x, count(DISTINCT rid) AS n FROM (SELECT DISTINCT x FROM tw) v LEFT JOIN pos USING (x) GROUP BY v.x),
picked AS (SELECT t, x FROM (SELECT DISTINCT t, x, n FROM tw JOIN df USING (x)) QUALIFY row_number() OVER (PARTITION BY t ORDER BY n, x) <= 4),
posted AS (SELECT tw.* FROM tw JOIN picked USING (t, x)),
needs AS (SELECT t, any_value(label) AS label, count(*) AS places, CAST(ceil(count(*) / 2) AS BIGINT) AS least FROM posted GROUP BY t),
seen AS (SELECT DISTINCT rid, x FROM pos WHERE x IN (SELECT x FROM posted)),
votes AS (SELECT rid, t, i - p AS o, count(*) AS n FROM pos JOIN seen USING (rid, x) JOIN posted USING (x) GROUP BY 1, 2, 3),
phrases AS (SELECT m.t, phrase, len(string_split(phrase, ' ')) AS k, min(p) AS place
  FROM {MANDATORY} JOIN tw ON tw.t = m.t JOIN (SELECT t, string_split(text, ' ') AS ws FROM {NOTICES}) f ON f.t = m.t
  WHERE array_to_string(ws[p + 1:p + len(string_split(phrase, ' '))], ' ') = phrase GROUP BY 1, 2, 3),
fits AS (SELECT rid, v.t, o, n FROM votes v JOIN needs USING (t) JOIN d USING (rid) JOIN phrases f ON f.t = v.t WHERE n >= least
  GROUP BY rid, v.t, o, n HAVING bool_and(o + place >= 0 AND array_to_string(w[greatest(o + place, 0) + 1:greatest(o + place, 0) + k], ' ') = phrase)),
found AS (SELECT rid, list(DISTINCT label) AS labels, max(n / places) AS best FROM fits JOIN needs USING (t) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN bases b USING (rid) LEFT JOIN found f USING (rid)
"""

# Rules of up to three tokens are counted as token combinations; a rule with a part that does as well is redundant.
OP4 = r"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id, url,
    CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules AS (SELECT verdict, rh, rp, rh || rp AS rule FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) r(verdict, rh, rp)),
listed AS (SELECT rid, rule, verdict FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY len(rule) DESC) = 1),
parts AS (SELECT rid, 's:' || split_part(url, '://', 1) AS t FROM u WHERE contains(url, '://') AND split_part(url, '://', 1) <> ''
  UNION ALL SELECT rid, 'h:' || x FROM (SELECT rid, unnest(string_split(host, '.')) AS x FROM h) WHERE x <> ''
  UNION ALL SELECT rid, 'p:' || x FROM (SELECT rid, unnest(string_split(path, '/')) AS x FROM h) WHERE x <> ''
  UNION ALL SELECT rid, 'q:' || split_part(x, '=', 1) FROM (SELECT rid, unnest(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1, 's'), '&')) AS x FROM u) WHERE split_part(x, '=', 1) <> ''
  UNION ALL SELECT rid, 'f:' || regexp_extract(url, '^[^#]*#(.*)$', 1, 's') FROM u WHERE regexp_extract(url, '^[^#]*#(.*)$', 1, 's') <> ''),
tokens AS (SELECT DISTINCT rid, t FROM parts),
bags AS (SELECT h.rid, coalesce(list(t ORDER BY t) FILTER (t IS NOT NULL), []) AS bag FROM h LEFT JOIN tokens USING (rid) GROUP BY h.rid),
lab AS (SELECT rid, t, verdict FROM tokens JOIN listed USING (rid)),
size AS (SELECT count(*) AS n, ceil(0.01::DOUBLE * count(*)) AS least FROM listed),
common AS (SELECT lab.* FROM lab JOIN (SELECT t FROM lab, size GROUP BY t, least HAVING count(*) >= least) USING (t)),
combos AS (SELECT [t] AS c, verdict FROM common
  UNION ALL SELECT [a.t, b.t], a.verdict FROM common a JOIN common b ON a.rid = b.rid AND a.t < b.t
  UNION ALL SELECT [a.t, b.t, e.t], a.verdict FROM common a JOIN common b ON a.rid = b.rid AND a.t < b.t JOIN common e ON e.rid = a.rid AND b.t < e.t),
counted AS (SELECT c, verdict, count(*) AS m, sum(count(*)) OVER (PARTITION BY c) AS total FROM combos GROUP BY c, verdict),
strong AS (SELECT c, verdict, m, m::DOUBLE / total::DOUBLE AS conf FROM counted, size WHERE m >= least AND m::DOUBLE / total::DOUBLE >= 0.9),
kept AS (SELECT * FROM strong r WHERE NOT EXISTS (SELECT 1 FROM strong k WHERE k.verdict = r.verdict AND k.conf >= r.conf
  AND len(k.c) < len(r.c) AND list_has_all(r.c, k.c))),
best AS (SELECT rid, verdict FROM bags JOIN kept ON list_has_all(bag, c)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY conf DESC, m DESC, len(c), c, verdict) = 1)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(listed.verdict, best.verdict, 'allow') AS verdict
FROM h LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid)
"""

OP11 = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
f AS (SELECT rid, vec_id, i, floor(1024 * e[i]::DOUBLE)::BIGINT AS x FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM v)),
products AS (SELECT q.rid AS q, c.rid AS c, sum(q.x * c.x)::BIGINT AS score FROM f q JOIN f c ON q.i = c.i AND q.rid <> c.rid
  WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
ranked AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(score, 0) AS score,
  row_number() OVER (PARTITION BY q.rid ORDER BY coalesce(score, 0) DESC, c.vec_id NULLS LAST, c.rid) AS rank
  FROM v q JOIN v c ON q.rid <> c.rid LEFT JOIN products p ON p.q = q.rid AND p.c = c.rid WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, {lower("coalesce(text, '')")} AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, w[i:i + k - 1] AS ws
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, any_value(ws) AS ws, count(*) AS f FROM grams GROUP BY lang, k, g),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
inside AS (SELECT lang, part, max(f) AS longer FROM (SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM c WHERE k = 3) GROUP BY lang, part),
open AS (SELECT c.* FROM c LEFT JOIN inside i ON c.k = 2 AND i.lang = c.lang AND i.part = c.g WHERE longer IS NULL OR 100 * longer < 50 * f),
cuts AS (SELECT lang, g, f AS a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM open)),
scored AS (SELECT cuts.lang, cuts.g, a, j, l.f AS l, r.f AS r, ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.g = x AND l.k = j JOIN f r ON r.lang = cuts.lang AND r.g = y
  WHERE r.k = len(string_split(cuts.g, ' ')) - j QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.g ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM scored)
SELECT lang, rank::INTEGER AS rank, g AS phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {TOKENS.format(lower("coalesce(text, '')"))} AS w FROM documents),
size AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS words FROM d WHERE len(w) > 0),
q AS (SELECT row_number() OVER () AS qid, item_id, {TOKENS.format(lower("coalesce(text, '')"))} AS w FROM benchmark),
qt AS (SELECT DISTINCT qid, item_id, t FROM (SELECT qid, item_id, unnest(w) AS t FROM q)),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM qt) GROUP BY rid, t),
weight AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY t, docs),
scores AS (SELECT qid, item_id, doc_id, sum(weight.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(d.w) * docs) // words))))::BIGINT AS score
  FROM qt JOIN tf USING (t) JOIN weight USING (t) JOIN d USING (rid), size GROUP BY qid, item_id, rid, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES = {
    "op1_quality_rules": OP1,
    "op2_decontamination": OP2,
    "op3_license_scan": OP3,
    "op4_url_filter": OP4,
    "op5_secret_scan": OP5,
    "op6_chat_formatting": OP6,
    "op8_line_dedup": OP8,
    "op9_near_dedup": OP9,
    "op11_top_k_search": OP11,
    "op12_phrase_mining": OP12,
    "op13_lexical_search": OP13,
}
