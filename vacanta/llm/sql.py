"""Checking SQL (DuckDB) for the operators whose results SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _key(value: str) -> str:
    return f"('0x' || substr(md5({value}), 1, 15))::BIGINT"


# Shards by a full sort: bytes before a row's key decide its shard. The checksum runs over
# the bytes with the 256 remainders of its polynomial, which the first two steps make.
OP2 = f"""
WITH RECURSIVE step(i, c, n) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), n + 1 FROM step WHERE n < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM step WHERE n = 8),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
summed AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM docs, tab),
keyed AS (
  SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size, {_key('text')} AS k1, {_key('CAST(doc_id AS VARCHAR)')} AS k2
  FROM docs),
sharded AS (
  SELECT *, k1 >> 48 AS c1, CAST(coalesce(sum(size) OVER (ORDER BY k1, k2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      * 16 // sum(size) OVER () AS INT) AS shard,
    count(*) OVER (PARTITION BY k1 >> 48) > greatest(1000, count(*) OVER () / 1024) AS heavy
  FROM keyed)
SELECT s.doc_id, s.size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY c1, CASE WHEN heavy THEN k2 >> 48 ELSE 0 END, k1, k2) - 1 AS slot,
  CAST(NULL AS INT) AS grown_shard
FROM sharded s JOIN summed USING (doc_id)"""

# All pairs of texts that share a shingle, and the classes that the similar ones connect.
OP4 = r"""
WITH RECURSIVE docs AS (SELECT doc_id, md5(coalesce(text, '')) AS k, coalesce(text, '') AS text FROM documents),
texts AS (SELECT k, regexp_extract_all(any_value(text), '\S+') AS w FROM docs GROUP BY k),
shingles AS (
  SELECT DISTINCT k, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS g
  FROM (SELECT k, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT k, count(*) AS n FROM shingles GROUP BY k),
shared AS (
  SELECT x.k AS a, y.k AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.k < y.k GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON a = p.k JOIN sizes q ON b = q.k WHERE 10 * c >= 8 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (SELECT k, k FROM texts UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a),
classes AS (SELECT a AS k, min(b) AS class FROM reached GROUP BY a),
degrees AS (SELECT a AS k, count(*) AS n_links FROM both_ways GROUP BY a),
placed AS (SELECT doc_id, k, class FROM docs JOIN classes USING (k))
SELECT doc_id, min(doc_id) OVER (PARTITION BY class) AS class_id, count(*) OVER (PARTITION BY class) AS class_size,
  count(*) OVER (PARTITION BY k) AS n_copies, coalesce(n_links, 0) AS n_links
FROM placed LEFT JOIN degrees USING (k)"""

# Every window of every document, compared with every window of every item.
OP7 = f"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS w FROM benchmark),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS w FROM documents),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN windows USING (n, g)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""


# Kind, pattern, and the group whose length is bounded from below.
SECRETS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@", 0, 0),
)


def _found(n: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of a kind; a match starts after the texts between and the matches before it."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, {n} AS n, '{kind}' AS kind,
    list_sum(list_transform(gaps[1:j], lambda x: len(x))) + coalesce(list_sum(list_transform(whole[1 : j - 1], lambda x: len(x))), 0) AS start,
    len(whole[j]) AS length
  FROM (SELECT doc_id, gaps, whole, part, unnest(range(1, len(whole) + 1)) AS j FROM (
    SELECT doc_id, string_split_regex(text, {quoted}) AS gaps, regexp_extract_all(text, {quoted}) AS whole,
      regexp_extract_all(text, {quoted}, {group}) AS part FROM docs))
  WHERE len(part[j]) >= {least}"""


OP8 = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({' UNION ALL '.join(_found(n, *rule) for n, rule in enumerate(SECRETS))}),
shown AS (SELECT *, concat(kind, ':', CAST(start AS BIGINT), ':', CAST(start + length AS BIGINT)) AS span FROM found),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, n) FILTER (n < 3) AS base,
    string_agg(span, ',' ORDER BY start, n) AS spans
  FROM shown GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (doc_id)"""

# Checksums as in OP2. Replaced letters: words equal but for one place; added ones: words
# equal to another one without a letter.
OP11 = f"""
WITH RECURSIVE step(i, c, n) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), n + 1 FROM step WHERE n < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM step WHERE n = 8),
runs AS (
  SELECT concat(doc_id, ':', run) AS key, run FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{UPPER.lower()}') AS run FROM documents)
  WHERE length(run) >= 7),
hashed AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(regexp_extract_all(hex(encode(key)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM runs, tab),
words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
      ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY 1 HAVING count(*) >= 2),
places AS (
  SELECT word, n, left(word, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT word, n, a || b AS less FROM places),
near AS (
  SELECT x.word, y.word AS other, y.n FROM places x JOIN places y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.less = w.word
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.less = w.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS form_n, arg_min(other, (-n, other)) AS form FROM near GROUP BY 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
    CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
paths(word, last) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT p.word, f.form FROM paths p JOIN formed f ON p.last = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT p.word, p.last AS root FROM paths p JOIN formed f ON p.last = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""

# All pairs of anchors and rows.
OP12 = """
WITH numbered AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM numbered a JOIN numbered b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, r) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.id, n.r) AS INT) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5"""
