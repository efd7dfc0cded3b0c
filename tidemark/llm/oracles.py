"""SQL that states the result of a query, where SQL can over whole tables."""

MIXING = """
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
        -ln((CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), '12')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
            / 4503599627370496::DOUBLE)
        / GREATEST(COALESCE(length(regexp_replace(text, '[\\x21-\\x40\\x5B-\\x60\\x7B-\\x7E]', '', 'g'))::DOUBLE
            / NULLIF(length(text), 0), 0), 0.05::DOUBLE) AS key
    FROM documents),
s AS (
    SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
        CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
        ROW_NUMBER() OVER (ORDER BY source NULLS LAST) AS number
    FROM d GROUP BY source),
f AS (
    SELECT *, 2 * source_size AS cap, 2 * source_size / weight::DOUBLE AS ratio,
        COALESCE(SUM(2 * source_size) OVER earlier, 0) AS caps, COALESCE(SUM(weight) OVER earlier, 0) AS weights,
        SUM(source_size) OVER () * 1.5::DOUBLE AS budget, SUM(weight) OVER () AS all_weights
    FROM s WINDOW earlier AS (ORDER BY 2 * source_size / weight::DOUBLE, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (budget - caps::DOUBLE) / (all_weights - weights)::DOUBLE AS level FROM f),
least AS (SELECT arg_min(level, (ratio, number)) AS level FROM l WHERE ratio > level),
t AS (
    SELECT source, source_size,
        COALESCE(LEAST(cap::DOUBLE, (SELECT level FROM least) * weight), cap::DOUBLE) AS target
    FROM f),
e AS (
    SELECT *, LEAST(COALESCE(floor(target / NULLIF(source_size, 0)), 0), 2)::BIGINT AS epochs FROM t),
r AS (
    SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
        floor(e.target - e.epochs * e.source_size)::BIGINT AS rest,
        COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
    CAST(epochs * size + GREATEST(0, LEAST(size, rest - before)) AS BIGINT) AS taken
FROM r
"""

BLOCKS = """
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id,
               regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, i, list_slice(w, i, i + 12) AS g FROM d, UNNEST(range(1, len(w) - 11)) AS t(i)),
least AS (SELECT g, MIN(doc_id) AS m FROM win GROUP BY g),
hit AS (SELECT r, i FROM win JOIN least USING (g) WHERE m < doc_id),
gone AS (SELECT DISTINCT r, i + k AS i FROM hit, range(13) AS s(k)),
word AS (SELECT r, i, w[i] AS x FROM d, UNNEST(range(1, len(w) + 1)) AS t(i)),
kept AS (SELECT r, COUNT(gone.i) AS n, string_agg(x, ' ' ORDER BY word.i) FILTER (WHERE gone.i IS NULL) AS text
         FROM word LEFT JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n, 0) AS BIGINT) AS n_removed,
    sha256(COALESCE(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

WINNOWING = """
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, regexp_extract_all(
               translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
          translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, LEAST(len(w), 10) AS n, list_slice(w, i, i + LEAST(len(w), 10) - 1) AS g
       FROM b, UNNEST(range(1, len(w) - LEAST(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
n AS (SELECT DISTINCT n FROM iw),
win AS (SELECT r, i, n, list_slice(w, i, i + n - 1) AS g FROM d CROSS JOIN n, UNNEST(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT r, i, win.n, item FROM win JOIN iw ON win.g = iw.g),
word AS (SELECT r, COUNT(DISTINCT i + k) AS n FROM (SELECT DISTINCT r, i, n FROM hit), UNNEST(range(n)) AS s(k) GROUP BY r),
item AS (SELECT r, COUNT(*) AS n, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(word.n, 0) AS BIGINT) AS n_hit,
    CAST(COALESCE(item.n, 0) AS BIGINT) AS n_items, sha256(COALESCE(items, '')) AS items_sha256,
    COALESCE(word.n, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)
"""

# Marks of the template: 12 and 10 characters and a line feed each around a message, 8 between merged turns.
CHAT = """
WITH t AS (
    SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT *, ROW_NUMBER() OVER w AS i, COALESCE(LAG(role) OVER w <> role, TRUE) AS opens
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS size,
          length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C')) AS role_size FROM o)
SELECT conv_id, COUNT(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(COALESCE(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(SUM(size + CASE WHEN opens THEN 24 + role_size ELSE 8 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLES: dict[str, str] = {
    "op3_blocks": BLOCKS,
    "op4_chat": CHAT,
    "op5_winnowing": WINNOWING,
    "op12_mixing": MIXING,
}
