"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

#: op9. Words of the contract in either case, spelled out as RE2 would fold other letters too.
SECRETS = r"""
WITH patterns(kind, rank, pattern, grp, least) AS (VALUES
    ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    ('access', 1, 'AKIA[A-Z0-9]+', 0, 20),
    ('hex', 2, '[0-9a-f]+', 0, 24)),
texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
    SELECT row_id, kind, rank, least,
        CASE kind WHEN 'assign' THEN regexp_extract_all(text, (SELECT pattern FROM patterns WHERE kind = 'assign'))
                  WHEN 'access' THEN regexp_extract_all(text, (SELECT pattern FROM patterns WHERE kind = 'access'))
                  ELSE regexp_extract_all(text, (SELECT pattern FROM patterns WHERE kind = 'hex')) END AS matches,
        CASE kind WHEN 'assign' THEN regexp_extract_all(text, (SELECT pattern FROM patterns WHERE kind = 'assign'), 2)
                  WHEN 'access' THEN regexp_extract_all(text, (SELECT pattern FROM patterns WHERE kind = 'access'))
                  ELSE regexp_extract_all(text, (SELECT pattern FROM patterns WHERE kind = 'hex')) END AS vals,
        CASE kind WHEN 'assign' THEN string_split_regex(text, (SELECT pattern FROM patterns WHERE kind = 'assign'))
                  WHEN 'access' THEN string_split_regex(text, (SELECT pattern FROM patterns WHERE kind = 'access'))
                  ELSE string_split_regex(text, (SELECT pattern FROM patterns WHERE kind = 'hex')) END AS gaps
    FROM texts, patterns),
matches AS (
    SELECT row_id, kind, rank, least, unnest(matches) AS match, unnest(vals) AS val,
        unnest(gaps[1:len(matches)]) AS gap, unnest(range(len(matches))) AS n
    FROM parts),
spans AS (
    SELECT row_id, kind, rank, val, least,
        sum(length(gap) + length(match)) OVER (PARTITION BY row_id, kind ORDER BY n) AS stop,
        length(match) AS size
    FROM matches),
kept AS (SELECT row_id, kind, rank, stop - size AS start, stop FROM spans WHERE length(val) >= least),
joined AS (
    SELECT row_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
        count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        string_agg(kind || ':' || cast(start AS bigint) || ':' || cast(stop AS bigint), ',' ORDER BY start, rank) AS spans
    FROM kept GROUP BY row_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN joined j USING (row_id)
"""

#: op8. Vectors that take part, scaled; every query against every other row.
TOP_K = """
WITH usable AS (
    SELECT vec_id, [floor(256 * cast(x AS double)) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, cast(list_dot_product(q.v, c.v) AS bigint) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, cast(rank AS integer) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: op13. crc32 byte by byte over each distinct word, by the table that its polynomial gives.
RESAMPLING = r"""
WITH RECURSIVE crc_steps(n, c, step) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT n, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, step + 1 FROM crc_steps WHERE step < 8),
crc_table AS (SELECT n, c FROM crc_steps WHERE step = 8),
own AS (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents),
found AS (
    SELECT row_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM own),
wanted AS (
    SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
hashing(word, digits, place, crc) AS (
    SELECT word, hex(encode(word)), 0, 4294967295::bigint FROM (SELECT word FROM found UNION SELECT word FROM wanted)
    UNION ALL
    SELECT word, digits, place + 1, xor(t.c, crc // 256)
    FROM hashing JOIN crc_table t ON t.n = xor(crc % 256, ('0x' || digits[2 * place + 1 : 2 * place + 2])::bigint)
    WHERE 2 * place < length(digits)),
words AS (SELECT word, xor(crc, 4294967295) % 10000 AS bucket FROM hashing WHERE 2 * place = length(digits)),
corpus AS (SELECT bucket, count(*) AS n FROM found JOIN words USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM wanted JOIN words USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, cast(floor(1000 * ln((coalesce(t.n, 0) + 1) * (SELECT coalesce(sum(n), 0) + 10000 FROM corpus)
        / ((c.n + 1)::double * (SELECT coalesce(sum(n), 0) + 10000 FROM target)))) AS bigint) AS gain
    FROM corpus c LEFT JOIN target t USING (bucket)),
summed AS (
    SELECT row_id, count(*) AS n_features, cast(sum(gain) AS bigint) AS total
    FROM found JOIN words USING (word) JOIN gains USING (bucket) GROUP BY row_id),
weighed AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features,
        coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
        ('0x' || sha256('2024:' || coalesce(cast(doc_id AS varchar), ''))[1:8])::bigint AS h
    FROM own LEFT JOIN summed USING (row_id)),
scored AS (
    SELECT doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) AS bigint) AS score
    FROM weighed),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
        count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""


def statements() -> dict[str, str]:
    return {
        "op8_norm_pruned_top_k": TOP_K,
        "op9_trigram_secret_scan": SECRETS,
        "op13_line_resampling": RESAMPLING,
    }
