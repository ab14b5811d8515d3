"""The SQL that the queries must agree with, where SQL can express an operator."""

from __future__ import annotations

from . import centroid_clustering, fill_in_middle, mixing, quality_rules, warc_packages

_SPACE = r"\x20\x09-\x0D"
_WORDS = f"regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+')"


def _count(chars: str) -> str:
    return f"length(regexp_extract_all(t, '[{chars.replace(chr(39), chr(39) * 2)}]'))"


MIX = f"""
WITH d AS (
    SELECT doc_id, source, len({_WORDS}) AS size,
           CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS UBIGINT) AS BIGINT) AS place
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST(({list(mixing.WEIGHTS)})[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1 AS INT)] AS DOUBLE) AS w
    FROM d GROUP BY source),
f AS (
    SELECT *, {mixing.MAX_EPOCHS}::DOUBLE * source_size AS cap,
           ({mixing.BUDGET}::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum({mixing.MAX_EPOCHS}::DOUBLE * source_size) OVER (ORDER BY source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(w) OVER (ORDER BY source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM s),
t AS (
    SELECT source, source_size, least(cap, w * (SELECT arg_min(level, source_size / w) FROM f WHERE level <= cap / w)) AS target FROM f),
e AS (
    SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS epochs FROM t),
o AS (
    SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, e.source_size, e.target, e.epochs, round(e.target - e.epochs * e.source_size) AS rest,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY place % {mixing.BUCKETS}, place, CAST(doc_id AS VARCHAR)
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, epochs, CAST(greatest(0, least(size, rest - used)) AS BIGINT) AS extra,
       CAST(epochs * size + greatest(0, least(size, rest - used)) AS BIGINT) AS taken
FROM o"""


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(str(r) for r in rules)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH r(host, path, verdict) AS (VALUES {values}),
a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
u AS (SELECT page_id, translate(raw, '{upper}', '{upper.lower()}') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
m AS (SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
      FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
      GROUP BY page_id)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM u LEFT JOIN m USING (page_id)"""


REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM n WHERE n >= 100)),
b AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS new FROM b),
c AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z
      FROM (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM c),
p AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front
      FROM k JOIN n USING (doc_id) GROUP BY doc_id)
SELECT n.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM n LEFT JOIN p USING (doc_id)"""

_LISTS = ", ".join(f"('{lang}', {words})" for lang, words in [
    *quality_rules.COMMON_WORDS.items(),
    (quality_rules.ALL, sorted({w for ws in quality_rules.COMMON_WORDS.values() for w in ws})),
])
_CLASSES = ", ".join(_count(c) for c in quality_rules.CLASSES.values())


def _divergence(counts: str, name: str) -> str:
    """Of the table ``counts`` (doc_id, ref, k, n), by document."""
    return f"""
{name}_ref AS (SELECT ref, k, sum(n) / sum(sum(n)) OVER (PARTITION BY ref) AS q FROM {counts} GROUP BY ref, k),
{name}_own AS (SELECT doc_id, ref, k, n / nullif(sum(n) OVER (PARTITION BY doc_id), 0) AS p, sum(n) OVER (PARTITION BY doc_id) AS total FROM {counts}),
{name}_far AS (
    SELECT doc_id, any_value(total) AS total,
           sqrt(greatest(0, sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2))) AS far
    FROM {name}_own JOIN {name}_ref USING (ref, k) GROUP BY doc_id)"""


QUALITY = f"""
WITH l(ref, list) AS (VALUES {_LISTS}),
d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS words, CASE WHEN lang IN ({", ".join(map(repr, quality_rules.COMMON_WORDS))}) THEN lang ELSE '{quality_rules.ALL}' END AS ref
      FROM documents),
u AS (SELECT doc_id, unnest(range(len(words))) AS i, words FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i + 1:i + {quality_rules.WINDOW}], ' ')) > 1 AND i + {quality_rules.WINDOW} <= len(words) AS twice FROM u),
r AS (SELECT doc_id, count(*) FILTER (WHERE inside) AS n_repeat_words
      FROM (SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {quality_rules.WINDOW - 1} PRECEDING AND CURRENT ROW) AS inside FROM g) GROUP BY doc_id),
b AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, {_count(quality_rules.SYMBOLS)} AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS lines FROM d) LEFT JOIN r USING (doc_id)),
x AS (SELECT doc_id, ref, [{_CLASSES}] AS c, length(t) AS n FROM d),
classes AS (SELECT doc_id, ref, unnest(range(len(c) + 1)) AS k, unnest(list_append(c, n - list_sum(c))) AS n FROM x),
listed AS (SELECT doc_id, ref, words, unnest(list) AS w FROM d JOIN l USING (ref)),
counts AS (SELECT doc_id, ref, w AS k, len(list_filter(words, lambda v: v = w)) AS n FROM listed),
tokens AS (SELECT * FROM counts UNION ALL
           SELECT d.doc_id, d.ref, NULL, len(words) - s FROM d JOIN (SELECT doc_id, sum(n) AS s FROM counts GROUP BY doc_id) USING (doc_id)),
words AS (SELECT doc_id, ref, coalesce(k, '') AS k, n FROM tokens),
{_divergence("classes", "class")},
{_divergence("words", "word")},
j AS (SELECT b.*, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED} * n_words AS base_failed,
             CASE WHEN c.total >= {quality_rules.GUARD_CHARS} THEN c.far END AS class_far, CASE WHEN w.total >= {quality_rules.GUARD_WORDS} THEN w.far END AS word_far
      FROM b JOIN class_far c USING (doc_id) JOIN word_far w USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       round(class_far, 6) AS class_distance, round(word_far, 6) AS word_distance,
       NOT base_failed AND NOT coalesce(class_far > {quality_rules.MAX_CLASS_DISTANCE}, false) AND NOT coalesce(word_far > {quality_rules.MAX_WORD_DISTANCE}, false) AS kept
FROM j"""


def _clusters() -> str:
    c = centroid_clustering
    least = lambda k: f"""
a{k} AS MATERIALIZED (
    SELECT r, min({{'s': s, 'c': c}}) AS m
    FROM (SELECT p.r, k.c, sum((p.x - k.x) * (p.x - k.x)) AS s FROM p JOIN c{k} k USING (d) GROUP BY p.r, k.c) GROUP BY r)"""  # noqa: E731
    steps = []
    for k in range(c.ROUNDS):
        steps += [
            least(k),
            f"""
c{k + 1} AS MATERIALIZED (
    SELECT c, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x
    FROM (SELECT m.c AS c, d, sum(x) AS s, count(*) AS n FROM a{k} JOIN p USING (r) GROUP BY m.c, d)
    UNION ALL SELECT c, d, x FROM c{k} WHERE c NOT IN (SELECT m.c FROM a{k}))""",
        ]
    return f"""
WITH e AS (
    SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor({c.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {c.DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {c.DIMENSIONS}),
p AS MATERIALIZED (SELECT r, unnest(range({c.DIMENSIONS})) AS d, unnest(v) AS x FROM e),
f AS (
    SELECT row_number() OVER (ORDER BY sha256('{c.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v FROM e),
c0 AS MATERIALIZED (SELECT c, unnest(range({c.DIMENSIONS})) AS d, unnest(v) AS x FROM f WHERE c < {c.CENTROIDS}),{",".join(steps)},{least(c.ROUNDS)},
t AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS digest FROM c{c.ROUNDS} GROUP BY c)
SELECT e.vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.s AS BIGINT) AS distance,
       CAST(sum(m.s) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.s) OVER () AS BIGINT) AS inertia, t.digest AS centroid_sha256
FROM a{c.ROUNDS} JOIN e USING (r) JOIN t ON t.c = m.c"""


CLUSTERS = _clusters()


def _middles() -> str:
    f = fill_in_middle
    h = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"
    return f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('{f.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u
    FROM documents),
c AS (
    SELECT *, len(u) AS n, least({h(0)} % (len(u) + 1), {h(1)} % (len(u) + 1)) AS a, greatest({h(0)} % (len(u) + 1), {h(1)} % (len(u) + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '{f.PREFIX}') OR contains(t, '{f.SUFFIX}') OR contains(t, '{f.MIDDLE}') OR {h(2)} % 100 >= {f.TRANSFORMED} THEN 'plain'
                WHEN {h(3)} % 100 < {f.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM d),
p AS (
    SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
           coalesce(array_to_string(u[b + 1:], ''), '') AS suf
    FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{f.SUFFIX}' || suf || '{f.PREFIX}' || pre || '{f.MIDDLE}' || mid
                        ELSE '{f.PREFIX}' || pre || '{f.SUFFIX}' || suf || '{f.MIDDLE}' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


MIDDLES = _middles()


REVISITS = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS least FROM p WHERE n >= {warc_packages.LEAST_REVISIT} GROUP BY d),
r AS (SELECT p.*, CASE WHEN f.least IS NOT NULL AND p.page_id IS DISTINCT FROM f.least THEN f.least END AS refers_to FROM p LEFT JOIN f USING (d))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r"""
