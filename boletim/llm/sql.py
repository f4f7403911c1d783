"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

from __future__ import annotations

from boletim.llm.centroids import CENTROIDS, DIMENSION, ROUNDS, SCALE
from boletim.llm.mixing import MOST, SHARE, WEIGHTS
from boletim.llm.spelling import DAMAGED, LEAST_COUNT, LEAST_LETTERS, LOWER, RUN, TIMES, UPPER

_WEIGHT = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))

OP10 = f"""WITH sized AS (
    SELECT doc_id, source, coalesce(text, '') AS body,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, {MOST} * source_size AS most,
        CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} {_WEIGHT}
        END AS weight FROM per),
steps AS (
    SELECT *, CAST({SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (
            ORDER BY most / weight, source IS NULL, source
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / sum(weight) OVER (ORDER BY most / weight, source IS NULL, source
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
settled AS (
    SELECT arg_min(level, (most / weight, level)) AS level FROM steps WHERE level <= most / weight),
targets AS (
    SELECT source, source_size,
        coalesce(least(most, settled.level * weight), most)::DOUBLE AS target
    FROM steps LEFT JOIN settled ON true),
rated AS (
    SELECT *, CASE WHEN source_size = 0 THEN 1.0 ELSE target / source_size END AS rate
    FROM targets)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN
        ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || body), 1, 13))::BIGINT
        / 4503599627370496::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source"""


def _round(k: int) -> str:
    """Every vector to its nearest centroid of round ``k``, and the floors of the means."""
    return f"""near{k} AS MATERIALIZED (
    SELECT kept.id, arg_min(c, (list_sum(list_transform(list_zip(v, m), lambda z:
        (z[1] - z[2]) * (z[1] - z[2]))), c)) AS c FROM kept, centroids{k} GROUP BY kept.id),
moved{k} AS (
    SELECT c, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
        SELECT c, unnest(v) AS x, unnest(range({DIMENSION})) AS i FROM near{k} JOIN kept USING (id))
    GROUP BY c, i),
centroids{k + 1} AS MATERIALIZED (
    SELECT c, coalesce(any_value(f.m), any_value(o.m)) AS m FROM centroids{k} o LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m
        FROM moved{k} GROUP BY c) f USING (c) GROUP BY c)"""


OP12 = f"""WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id,
        list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = {DIMENSION}
        AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (
        SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept
        ORDER BY h, v LIMIT {CENTROIDS})),
{", ".join(_round(k) for k in range(ROUNDS + 1))},
assigned AS (
    SELECT vec_id, c, list_sum(list_transform(list_zip(v, m), lambda z:
        (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance, m
    FROM kept JOIN near{ROUNDS} USING (id) JOIN centroids{ROUNDS} USING (c))
SELECT vec_id, c::INTEGER AS cluster, distance,
    (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(m, ',')) AS centroid_sha256 FROM assigned"""

# The table of the checksum is made by its rule: eight steps of shifting out the lowest bit.
OP13 = f"""WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, b:
        CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS steps),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, w, count(*) AS k FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{RUN}')) AS w FROM documents)
    WHERE length(w) >= {LEAST_LETTERS} GROUP BY ALL),
hashed AS (
    SELECT w, k, xor(4294967295, list_reduce(flatten(list_transform(string_split(id || ':' || w, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
            ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)),
        lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1]), 4294967295::BIGINT)) AS h
    FROM runs, crc),
words AS MATERIALIZED (
    SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT k, CASE WHEN h % {DAMAGED} = 0
            THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word
        FROM hashed)
    WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
cut AS MATERIALIZED (
    SELECT DISTINCT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (
        SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM words)
    UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM words)),
best AS (
    SELECT near.word, count(*) AS n_near, arg_min(other, (-n, encode(other))) AS form, max(n) AS most
    FROM near JOIN words ON words.word = other GROUP BY near.word),
formed AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN most >= {TIMES} * n THEN form END AS form,
        CASE WHEN most >= {TIMES} * n THEN most END AS form_n
    FROM words LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS root FROM formed
    UNION ALL
    SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.root
    WHERE f.form IS NOT NULL),
roots AS (
    SELECT chain.word, root FROM chain JOIN formed f ON f.word = root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)"""

SQL = {
    "op10_source_mix": OP10,
    "op12_centroid_search": OP12,
    "op13_spelling_variants": OP13,
}
