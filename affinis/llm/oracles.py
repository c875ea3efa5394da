"""SQL of the registered queries, where SQL can express them."""

ORACLES: dict[str, str] = {}

ORACLES["op2_quality_rules"] = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
grams AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, 1)::BIGINT)) AS i FROM w)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range(5) r(k) GROUP BY rid),
lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
m AS (
  SELECT w.rid, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, 100 * n_symbols > 10 * n_words AS symbols,
         100 * n_dup_lines > 50 * n_lines AS dup FROM m),
h AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed OR symbols OR dup) AS k FROM f GROUP BY source),
p AS (
  SELECT avg(k / n) AS mu, var_pop(k / n) AS v FROM h),
s AS (SELECT mu, CASE WHEN v > 0 THEN least(greatest(mu * (1 - mu) / v - 1, 1), 1000000) ELSE 1000000 END AS c FROM p),
bad AS (SELECT source FROM h, s WHERE (k + mu * c) / (n + c) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR symbols OR EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM f.source)) AS kept
FROM f
"""

ORACLES["op8_line_windows"] = r"""
WITH l AS (
  SELECT doc_id, line, nr, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr FROM documents)),
s AS (SELECT doc_id, nr, solid, row_number() OVER (PARTITION BY doc_id ORDER BY nr) AS i FROM l WHERE solid <> ''),
w AS (
  SELECT doc_id, i, solid AS a, lead(solid) OVER o AS b, lead(solid, 2) OVER o AS c FROM s
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS r
                         FROM w WHERE c IS NOT NULL) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(3) r(k)),
span AS (SELECT doc_id, count(*) AS n FROM gone g WHERE NOT EXISTS
           (SELECT 1 FROM gone q WHERE q.doc_id = g.doc_id AND q.i = g.i - 1) GROUP BY doc_id),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.nr) FILTER (gone.i IS NULL) AS text, count(s.i) AS n_lines,
         count(gone.i) AS n_removed
  FROM l LEFT JOIN s ON s.doc_id = l.doc_id AND s.nr = l.nr LEFT JOIN gone ON gone.doc_id = s.doc_id AND gone.i = s.i
  GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN n_removed > 0 THEN coalesce(kept.text, '') ELSE d.text END AS text, n_lines, n_removed,
       coalesce(span.n, 0) AS n_spans
FROM documents d JOIN kept USING (doc_id) LEFT JOIN span USING (doc_id)
"""

ORACLES["op5_warc_bundles"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT payload_digest, max(page_id) AS winner FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < winner THEN winner END AS refers_to
FROM p LEFT JOIN w USING (payload_digest)
"""

ORACLES["op1_html_blocks"] = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_replace(coalesce(regexp_extract(html, '<article>(.*)</article>', 1, 's'), ''),
         '</?(p|h1|br)>', ' ', 'g'), '</?b>', '', 'g') AS t FROM pages),
d AS (
  SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(replace(replace(t, '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'),
         '&gt;', '>'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""


def _crc_table() -> list[int]:
    """What each byte value leaves after eight steps of the reflected CRC-32."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


ORACLES["op11_importance_resampling"] = r"""
WITH w AS (
  SELECT 0 AS side, row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws
  FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') FROM benchmark),
f AS (
  SELECT side, rid, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS g FROM w),
n AS (SELECT side, rid, g, count(*) AS n FROM f GROUP BY ALL),
c AS (
  SELECT g, xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT],
           list_transform(range(0, strlen(g)), lambda i: ('0x' || substr(hex(g), (2 * i + 1)::BIGINT, 2))::UBIGINT)),
           lambda c, b: xor(c >> 8, ({TABLE}::UBIGINT[])[(xor(c, b) & 255)::BIGINT + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM n)),
b AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM n JOIN c USING (g) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM b),
d AS (
  SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM n JOIN c USING (g) JOIN gain USING (bucket)
  WHERE side = 0 GROUP BY rid),
x AS (
  SELECT w.rid, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features > 0 THEN floor(total::DOUBLE / n_features)::BIGINT ELSE 0 END AS weight,
         ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM w LEFT JOIN d USING (rid) WHERE side = 0),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM x),
r AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank, count(*) OVER () AS n FROM y WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM y LEFT JOIN r USING (rid)
"""
ORACLES["op11_importance_resampling"] = (
    ORACLES["op11_importance_resampling"]
    .replace("{UPPER}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    .replace("{LOWER}", "abcdefghijklmnopqrstuvwxyz")
    .replace("{WORD}", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    .replace("{TABLE}", str(_crc_table()))
)

_NEAREST = """
a{0} AS (
  SELECT rid, part, v, min(list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - w[i]) * (v[i] - w[i])))::BIGINT * 64 + e) AS best
  FROM p JOIN b{0} USING (part) GROUP BY rid, part, v)"""
_REPLACED = """
m{1} AS (
  SELECT part, e, i, floor(sum(x) / count(*))::BIGINT AS x
  FROM (SELECT part, best % 64 AS e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{0}) GROUP BY part, e, i),
b{1} AS (
  SELECT part, e, coalesce(n.w, b{0}.w) AS w
  FROM b{0} LEFT JOIN (SELECT part, e, list(x ORDER BY i) AS w FROM m{1} GROUP BY part, e) n USING (part, e))"""

ORACLES["op12_vector_codes"] = (
    """
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT rid, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS v FROM k, range(16) r(part)),
b0 AS (SELECT part, rid - 1 AS e, v AS w FROM p WHERE rid <= 64),"""
    + ",".join(_NEAREST.format(k) + "," + _REPLACED.format(k, k + 1) for k in range(2))
    + ","
    + _NEAREST.format(2)
    + """,
c AS (
  SELECT rid, string_agg(printf('%02x', (best % 64)::INT), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY rid),
q AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN c USING (rid), q
"""
)

_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
ORACLES["op13_secret_owners"] = (
    "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS owner, coalesce(text, '') AS t FROM documents),\nh AS ("
    + "\n  UNION ALL ".join(
        f"SELECT rid, owner, {kind} AS kind, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS p FROM d"
        for kind, pattern in enumerate([_ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]+", "[A-Za-z0-9+/_-]{20,}"])
    )
    + """),
s AS (
  SELECT rid, owner, kind, m[i] AS hit,
         list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM h)),
v AS (
  SELECT rid, owner, kind, a::BIGINT AS a, (a + length(hit))::BIGINT AS b,
         CASE WHEN kind = 0 THEN regexp_extract(hit, 'ASSIGN', 2) ELSE hit END AS value FROM s),
r AS (
  SELECT *, len(list_distinct(string_split(value, ''))) >= 8 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AS random
  FROM v WHERE length(value) >= CASE kind WHEN 0 THEN 12 WHEN 1 THEN 18 WHEN 2 THEN 16 ELSE 20 END),
c AS (
  SELECT * FROM r WHERE kind < 3 OR random AND NOT EXISTS (
    SELECT 1 FROM r q WHERE q.rid = r.rid AND q.kind < 3 AND q.a <= r.a AND q.b >= r.b)),
o AS (
  SELECT value, CASE WHEN count(DISTINCT owner) >= 3 THEN 'copied' WHEN count(DISTINCT owner) = 1 AND bool_or(random) THEN 'live'
                     ELSE 'open' END AS verdict FROM c GROUP BY value),
k AS (
  SELECT rid, kind, a, verdict, ['assign', 'access', 'hex', 'live'][kind + 1] || ':' || a || ':' || b AS span
  FROM c JOIN o USING (value) WHERE kind < 3 OR verdict = 'live')
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY a, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY a, kind), '') AS spans,
       count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'copied') AS n_copied,
       count(*) FILTER (verdict = 'open') AS n_open
FROM d LEFT JOIN k USING (rid) GROUP BY rid, doc_id
""".replace("ASSIGN", _ASSIGN)
)
