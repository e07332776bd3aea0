"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations


def _spans(kind: str, number: int, pattern: str, keep: str) -> str:
    """Kept matches of one pattern with positions: the texts between matches and the matches give the lengths."""
    quoted = pattern.replace("'", "''")
    return f"""
SELECT doc_id, {number} AS kind_no, '{kind}' AS kind, start_at, start_at + length(m) AS end_at FROM (
  SELECT doc_id, m, i, sum(length(gap)) OVER w + coalesce(sum(length(m)) OVER w - length(m), 0) AS start_at FROM (
    SELECT doc_id, unnest(regexp_extract_all(txt, '{quoted}')) AS m,
      unnest(list_slice(string_split_regex(txt, '{quoted}'), 1, len(regexp_extract_all(txt, '{quoted}')))) AS gap,
      unnest(range(len(regexp_extract_all(txt, '{quoted}')))) AS i
    FROM docs WHERE regexp_matches(txt, '{quoted}'))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i))
WHERE {keep}"""


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
SECRETS = [
    ("assign", ASSIGN, r"""length(regexp_replace(m, '^[^:=]*[:=]\x20*["'']?', '')) >= 12"""),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 18"),
    ("hex", "[0-9a-f]+", "length(m) >= 16"),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "length(m) >= 40"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", "length(m) >= 20"),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "true"),
    ("pem", r"-----BEGIN [A-Z\x20]*PRIVATE KEY-----", "true"),
]


def secret_scan() -> str:
    parts = " UNION ALL ".join(_spans(k, n, p, keep) for n, (k, p, keep) in enumerate(SECRETS))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS txt FROM documents),
found AS ({parts}),
grouped AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start_at || ':' || end_at, ',' ORDER BY start_at, kind_no) FILTER (kind_no < 3) AS base,
    string_agg(kind || ':' || start_at || ':' || end_at, ',' ORDER BY start_at, kind_no) AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN grouped g ON d.doc_id = g.doc_id"""


MIXING = r"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix|' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1 AS weight FROM docs GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, source COLLATE "C" NULLS LAST) AS n FROM sources),
levels AS (SELECT a.n, a.source_size, a.weight, ((SELECT sum(source_size) FROM sources) - coalesce(sum(b.source_size * 3) FILTER (b.n < a.n), 0))
    / sum(b.weight) FILTER (b.n >= a.n) AS lvl FROM ranked a, ranked b GROUP BY ALL),
final AS (SELECT arg_min(lvl, n) AS lvl FROM levels WHERE 3 * source_size / weight > lvl),
targets AS (SELECT source, source_size, weight,
    CASE WHEN 3 * source_size / weight <= coalesce(lvl, 0) OR lvl IS NULL THEN (3 * source_size)::DOUBLE ELSE lvl * weight END AS target
    FROM sources, (SELECT (SELECT lvl FROM final) AS lvl)),
passes AS (SELECT doc_id, source, size, k, p FROM docs, range(3) t(p) WHERE size > 0),
finished AS (SELECT e.*, (sum(e.size) OVER (PARTITION BY e.source ORDER BY p, k, e.size, e.doc_id ROWS UNBOUNDED PRECEDING))::DOUBLE / weight AS finish
    FROM passes e JOIN targets t ON e.source IS NOT DISTINCT FROM t.source),
served AS (SELECT *, sum(size) OVER (ORDER BY finish, k, size, p ROWS UNBOUNDED PRECEDING) AS used FROM finished),
took AS (SELECT doc_id, source, k, size, sum(size)::BIGINT AS taken FROM served WHERE used <= (SELECT sum(size) FROM docs) GROUP BY ALL)
SELECT d.doc_id, d.size, d.source, t.source_size, t.target, coalesce(o.taken, 0)::BIGINT AS taken
FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN took o ON o.doc_id = d.doc_id"""


# Five hexadecimal digits are four base-32 digits.
WARC = """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT h, min(page_id) AS first_id FROM hashed GROUP BY h)
SELECT page_id, payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)
    FOR i IN range(32)], 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM hashed JOIN firsts USING (h)"""


NEAR_VECTORS = """
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS u, vec_id AS c FROM vectors UNION SELECT l.w, r.c FROM reach r JOIN links l ON r.u = l.u),
components AS (SELECT u, min(c) AS c FROM reach GROUP BY u),
degrees AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
FROM embeddings e LEFT JOIN components p ON p.u = e.vec_id LEFT JOIN degrees d ON d.u = e.vec_id"""


JACCARD = r"""
WITH RECURSIVE split AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (SELECT doc_id, unnest(list_distinct([array_to_string(list_slice(w, i, i + 4), ' ') FOR i IN range(1, greatest(1, len(w) - 4) + 1)])) AS g
    FROM split WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM shared s JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE s.n >= 0.8::DOUBLE * (a.n + b.n - s.n)),
reach AS (SELECT doc_id AS u, doc_id AS c FROM documents UNION SELECT l.v, r.c FROM reach r JOIN links l ON r.u = l.u),
components AS (SELECT u, min(c) AS c FROM reach GROUP BY u),
degrees AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT d.doc_id, c AS class_id, coalesce(n, 0)::BIGINT AS n_links, d.doc_id = c AS kept
FROM documents d JOIN components p ON p.u = d.doc_id LEFT JOIN degrees g ON g.u = d.doc_id"""


# crc32 of up to 20 digits, a bit at a time: 0xEDB88320 is 3988292384.
TRIE = r"""
WITH RECURSIVE crc(c, rest, v) AS (
  SELECT DISTINCT conv_id, conv_id::VARCHAR, 4294967295::BIGINT FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c, substr(rest, 2), list_reduce(list_prepend(xor(v, ascii(rest)::BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) FROM crc WHERE rest <> ''),
shared AS (SELECT c, xor(v, 4294967295) % 4 AS h FROM crc WHERE rest = ''),
turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(struct_pack(id := md5(length(role) || ':' || role || txt), words := len(regexp_extract_all(txt, '[^\x20\x09-\x0D]+')))
    ORDER BY turn NULLS FIRST, role, substr(sha256(length(role) || ':' || role || txt), 1, 32)) AS t FROM turns GROUP BY c),
whole AS (SELECT o.c, list_concat(coalesce(list_slice(b.t, 1, h), []), list_slice(o.t, h + 1, len(o.t))) AS t
    FROM own o JOIN shared s ON s.c = o.c LEFT JOIN own b ON b.c = o.c - o.c % 20),
members AS (SELECT c, len(t) AS n, d, list_transform(list_slice(t, 1, d), lambda x: x.id) AS p,
    CASE WHEN d > 0 THEN t[d].words ELSE 0 END AS words FROM (SELECT c, t, unnest(range(len(t) + 1)) AS d FROM whole)),
nodes AS (SELECT p, any_value(d) AS d, min(c) AS first, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends FROM members GROUP BY p),
kids AS (SELECT list_slice(p, 1, d - 1) AS above, count(*) AS k FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN kids ON above = p),
sums AS (SELECT list_slice(p, 1, u) AS top, sum((k = 0)::BIGINT) AS leaves, sum((n_convs - 1) * words) AS saved
    FROM (SELECT *, unnest(range(d + 1)) AS u FROM full_nodes) GROUP BY ALL)
SELECT n.first AS conv_id, n.d::BIGINT AS depth, m.first AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.k::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM full_nodes n JOIN sums ON top = n.p LEFT JOIN nodes m ON n.d > 0 AND m.p = list_slice(n.p, 1, n.d - 1)"""


PHRASES = r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS txt FROM documents),
pieces AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(txt, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM docs),
runs AS (SELECT lang, size, unnest([array_to_string(list_slice(w, i, i + size - 1), ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
    FROM pieces, range(1, 5) t(size) WHERE len(w) >= size),
totals AS (SELECT lang, count(*) AS n FROM runs WHERE size = 1 GROUP BY lang),
f AS (SELECT lang, size, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM runs GROUP BY ALL HAVING count(*) >= 30),
inside AS (SELECT lang, phrase, max(longer) AS longer FROM (
    SELECT lang, a AS longer, unnest(flatten([[array_to_string(list_slice(w, i, i + m - 1), ' ') FOR i IN range(1, size - m + 2)] FOR m IN range(2, size)])) AS phrase
    FROM f WHERE size > 2) GROUP BY ALL),
kept AS (SELECT f.* FROM f LEFT JOIN inside i ON i.lang = f.lang AND i.phrase = f.phrase
    WHERE size > 1 AND (longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)),
cuts AS (SELECT lang, phrase, a, w, unnest(range(1, size)) AS k, size FROM kept),
scored AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (2000000 * c.a::HUGEINT // (x.a::HUGEINT + y.a::HUGEINT))::BIGINT AS score FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, k + 1, c.size), ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM weakest) JOIN totals USING (lang)
WHERE rank <= 2000"""


ORACLES = {
    "op12_conversation_trie": TRIE,
    "op13_phrase_collocations": PHRASES,
    "op4_ngram_jaccard": JACCARD,
    "op2_vector_near_duplicates": NEAR_VECTORS,
    "op6_warc_archive": WARC,
    "op9_source_mixing": MIXING,
    "op8_secret_scan": secret_scan(),
}
