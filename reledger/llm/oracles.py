"""SQL that gives the same rows as a registered query, where SQL can express it."""

from __future__ import annotations

#: Five-word shingles of a table's texts, A-Z lower-cased; a shorter text is one shingle.
_SHINGLES = """
    SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (
        SELECT {key}, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
        FROM (
            SELECT {key}, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') AS w
            FROM {table}
        )
        WHERE len(w) > 0
    )
"""

_CONTAINED = f"""
WITH held AS ({_SHINGLES.format(key="doc_id", table="documents")}),
wanted AS ({_SHINGLES.format(key="item_id", table="benchmark")}),
sized AS (SELECT item_id, shingle, count(*) OVER (PARTITION BY item_id) AS n_item FROM wanted)
SELECT doc_id, item_id, max(n_item) AS n_item, count(*) AS n_common,
       CAST(count(*) AS DOUBLE) / max(n_item) AS containment
FROM held JOIN sized USING (shingle)
GROUP BY doc_id, item_id
HAVING count(*) * 100 >= max(n_item) * 80
"""

_MIX = """
WITH keyed AS (
    SELECT doc_id, source,
           md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(md5(text), '-')) AS key,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
    FROM documents
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM keyed GROUP BY source
),
stepped AS (
    SELECT *, (SELECT sum(source_size) * 1.5 FROM sources)
              - coalesce(sum(2 * source_size) OVER before, 0) AS rest,
           sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM sources
    WINDOW before AS (ORDER BY 2.0 * source_size / weight, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
leveled AS (
    SELECT max(CAST(rest AS DOUBLE) / CAST(open_weight AS DOUBLE)) AS level FROM stepped
    WHERE CAST(rest AS DOUBLE) / CAST(open_weight AS DOUBLE) <= 2.0 * source_size / weight
),
targets AS (
    SELECT source, source_size,
           least(CAST(2 * source_size AS DOUBLE), CAST(weight AS DOUBLE) * level) AS target
    FROM sources, leveled
),
placed AS (
    SELECT doc_id, size, source_size, target,
           CAST(floor(target / source_size) AS BIGINT) AS whole,
           sum(size) OVER (PARTITION BY keyed.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS until
    FROM keyed JOIN targets ON keyed.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size,
            CAST(round(target) AS BIGINT) - whole * source_size - until)) AS BIGINT) AS taken
FROM placed
"""

_PHRASES = """
WITH pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    )
),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, w[i:i + k - 1] AS g, count(*) AS f
    FROM (
        SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM split, (SELECT unnest([1, 2, 3]) AS k)
        WHERE len(w) >= k
    )
    GROUP BY ALL
),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
candidates AS (SELECT lang, g, f AS a FROM grams WHERE len(g) > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.g, c.a, k, p.f AS l, q.f AS r,
           CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(generate_series(1, len(g) - 1)) AS k FROM candidates) AS c
    JOIN grams AS p ON p.lang = c.lang AND p.g = c.g[1:k]
    JOIN grams AS q ON q.lang = c.lang AND q.g = c.g[k + 1:len(c.g)]
),
lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
),
covered AS (
    SELECT lang, p AS g, max(a) AS longer
    FROM (SELECT lang, a, unnest([g[1:2], g[2:3]]) AS p FROM candidates WHERE len(g) = 3)
    GROUP BY ALL
),
ranked AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
    FROM lowest LEFT JOIN covered USING (lang, g)
    WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {"op8_decontamination": _CONTAINED, "op9_mixing": _MIX, "op13_phrases": _PHRASES}
