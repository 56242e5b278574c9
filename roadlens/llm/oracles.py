"""SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

from .licenses import CONTAINMENT, PHRASES, TEMPLATES, _templates

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALPHANUMERIC = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f'coalesce({text}, {chr(39) * 2})')}, {pattern})"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words('text', _ALPHANUMERIC)} AS w FROM documents),
b AS (SELECT item_id, {_words('text', _ALPHANUMERIC)} AS w FROM benchmark),
grams AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT k FROM grams),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
hits AS (
    SELECT DISTINCT p.doc_id, p.i, p.k, g.item_id
    FROM places p JOIN grams g ON p.k = g.k AND array_to_string(p.w[p.i : p.i + p.k - 1], ' ') = g.g
),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_words('text', r"'[^\x20\x09-\x0D]+'")} AS w FROM documents),
s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g,
        len(w) < 5 AS short FROM d
),
e AS (SELECT doc_id, short, unnest(g) AS x FROM s),
pairs AS (
    SELECT a.doc_id AS p, b.doc_id AS q, count(*) AS n
    FROM e a JOIN e b ON a.x = b.x AND a.short = b.short AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT p, q FROM pairs JOIN s a ON a.doc_id = p JOIN s b ON b.doc_id = q
    WHERE 100 * n >= 75 * (len(a.g) + len(b.g) - n)
),
ways AS (SELECT p, q FROM links UNION ALL SELECT q, p FROM links),
reach AS (SELECT DISTINCT p AS doc_id, p AS r FROM ways UNION SELECT reach.doc_id, q FROM reach JOIN ways ON p = r)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, coalesce(c, s.doc_id) AS component_id,
    coalesce(c, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) m ON m.doc_id = s.doc_id
"""


def _licenses() -> str:
    phrases = ", ".join(f"({p.split()}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(
        f"('{label}', {words}, {least}, {reach})" for _, label, words, least, reach in _templates(TEMPLATES, CONTAINMENT)
    )
    return rf"""
WITH d AS (SELECT doc_id, text, {_words('text', _ALPHANUMERIC)} AS w FROM documents),
p(phrase, label) AS (VALUES {phrases}),
t(label, words, least, reach) AS (VALUES {templates}),
found AS (
    SELECT doc_id, label, unnest(list_filter(range(0, len(w) - len(phrase) + 1),
        lambda i: w[i + 1 : i + len(phrase)] = phrase)) AS place
    FROM d, p WHERE len(w) >= len(phrase) AND list_has_all(w, phrase)
),
base AS (
    SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM found GROUP BY doc_id
),
met AS (
    SELECT doc_id, label, n / len(words) AS c
    FROM (
        SELECT doc_id, label, words, least, list_max(list_transform(
            list_filter(range(1, len(w) + 1), lambda i: list_contains(words, w[i])),
            lambda i: len(list_intersect(w[i : i + reach - 1], words)))) AS n
        FROM d, t WHERE len(list_intersect(w, words)) >= least
    ) WHERE n >= least
),
more AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT doc_id, label FROM found UNION ALL SELECT doc_id, label FROM met) GROUP BY doc_id
),
best AS (SELECT doc_id, max(c) AS c FROM met GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
    coalesce(base.labels, '') AS base_labels, coalesce(more.labels, '') AS labels,
    CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id) LEFT JOIN best USING (doc_id)
"""


URL_RULES = r"""
WITH u AS (
    SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
h AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
),
r(rule_host, rule_path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
    SELECT page_id, max(lpad(CAST(length(rule_host || rule_path) AS VARCHAR), 5, '0') || ' ' || verdict || ' ' || rule_host || rule_path) AS b
    FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, string_split(b, ' ')[3] AS rule,
    coalesce(string_split(b, ' ')[2], CASE WHEN list_has_any(string_split(host, '.'), ['spam-farm', 'ads-track'])
        THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN best USING (page_id)
"""

_CRC_STEP = "CASE WHEN {c} % 2 = 1 THEN xor({c} // 2, 3988292384) ELSE {c} // 2 END"

RESAMPLING = f"""
WITH RECURSIVE steps(b, n, c) AS (
    SELECT b, 0, b FROM (SELECT unnest(range(256)) AS b)
    UNION ALL SELECT b, n + 1, {_CRC_STEP.format(c='c')} FROM steps WHERE n < 8
),
crc AS (SELECT list(c ORDER BY b) AS of_byte FROM steps WHERE n = 8),
d AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [NULL] ELSE w END) AS word, len(w) AS n_features
    FROM (SELECT doc_id, {_words('text', _ALPHANUMERIC)} AS w FROM documents)),
b AS (SELECT unnest({_words('text', _ALPHANUMERIC)}) AS word FROM benchmark),
bytes AS (
    SELECT word, list_transform(range(1, length(h), 2), lambda i: CAST('0x' || h[i : i + 1] AS BIGINT)) AS own
    FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM d WHERE word IS NOT NULL UNION SELECT word FROM b))
),
buckets AS (
    SELECT word, xor(list_reduce(list_concat([4294967295], own), lambda c, x: xor(c // 256, of_byte[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, crc
),
s AS (SELECT bucket, count(*) AS s FROM d JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN buckets USING (word) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM s), 0) + 10000 AS all_s, coalesce((SELECT sum(t) FROM t), 0) + 10000 AS all_t),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * all_s / (CAST(s + 1 AS DOUBLE) * all_t))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket), totals
),
weights AS (
    SELECT doc_id, any_value(n_features) AS n_features, CAST(coalesce(sum(gain), 0) AS BIGINT) AS weight
    FROM d LEFT JOIN buckets USING (word) LEFT JOIN gains USING (bucket) GROUP BY doc_id
),
scores AS (
    SELECT doc_id, n_features, weight, weight + CAST(floor(-1000.0 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
    FROM (SELECT *, CAST(CAST('0x' || sha256('2024:' || doc_id)[:8] AS BIGINT) AS DOUBLE) AS h FROM weights)
),
ranks AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN ranks USING (doc_id)
"""


def _assignment(n: int) -> str:
    """Vectors with their nearest centroid of round ``n``."""
    return f"""
a{n} AS (
    SELECT i, any_value(v) AS v, min(struct_pack(distance := distance, cluster := cluster)) AS best
    FROM (
        SELECT i, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
        FROM kept, c{n}
    ) GROUP BY i
)"""


def _centroids(n: int) -> str:
    """Floors of the means of round ``n``; an empty centroid stays."""
    return f"""
m{n} AS (
    SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY place) AS c
    FROM (
        SELECT best.cluster AS cluster, place, CAST(sum(v[place]) AS BIGINT) AS total, count(*) AS n
        FROM a{n}, (SELECT unnest(range(1, 65)) AS place) GROUP BY ALL
    ) GROUP BY cluster
),
c{n + 1} AS (SELECT cluster, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (cluster))"""


HEAP_KMEANS = f"""
WITH kept AS (
    SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS cluster, v AS c
    FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16
),{','.join(_assignment(n) + ',' + _centroids(n) for n in range(3))},{_assignment(3)}
SELECT vec_id, best.cluster AS cluster, CAST(best.distance AS BIGINT) AS distance,
    CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN kept USING (i) JOIN c3 ON c3.cluster = best.cluster
"""

ORACLE_SQL = {
    "op1_decontamination": DECONTAMINATION,
    "op3_near_duplicates": NEAR_DUPLICATES,
    "op6_licenses": _licenses(),
    "op10_url_rules": URL_RULES,
    "op11_resampling": RESAMPLING,
    "op13_heap_kmeans": HEAP_KMEANS,
}
