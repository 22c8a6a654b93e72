"""DuckDB SQL of the subpackage's queries, as far as SQL can express them."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32's table of 256 registers, by its rule.
CRC_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS tab)"""


def crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of ``text``; ``tab`` is in scope."""
    octets = f"list_transform(range(1, strlen({text}) + 1), lambda i: ('0x' || substr(hex({text}), 2 * i - 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])))"


WORDS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

IMPORTANCE = f"""
WITH texts AS MATERIALIZED (
    SELECT 0 AS side, row_number() OVER () AS no, doc_id, {WORDS} AS w FROM documents
    UNION ALL SELECT 1, row_number() OVER (), NULL, {WORDS} FROM benchmark),
features AS MATERIALIZED (
    SELECT side, no, f, count(*) AS n FROM (
        SELECT side, no, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM texts)
    GROUP BY side, no, f),
coded AS MATERIALIZED (SELECT f, {crc32('f')} % 10000 AS bucket FROM (SELECT DISTINCT f FROM features), {CRC_TABLE}),
counts AS (SELECT bucket, sum(n) FILTER (WHERE side = 0) AS s, sum(n) FILTER (WHERE side = 1) AS t FROM features JOIN coded USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(n) FILTER (WHERE side = 0), 0)::DOUBLE AS all_s, coalesce(sum(n) FILTER (WHERE side = 1), 0)::DOUBLE AS all_t FROM features),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (all_s + 10000) / ((coalesce(s, 0) + 1.0::DOUBLE) * (all_t + 10000)))) AS gain
    FROM counts, totals),
weights AS (SELECT no, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
    FROM features JOIN coded USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY no),
scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM texts LEFT JOIN weights USING (no) WHERE side = 0),
able AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many FROM scored WHERE n_words >= 20)
SELECT doc_id::BIGINT AS doc_id, n_features, weight, score, CASE WHEN place <= 25 * many // 100 THEN place END::BIGINT AS rank FROM able
UNION ALL SELECT doc_id::BIGINT, n_features, weight, score, NULL::BIGINT FROM scored WHERE n_words < 20
"""

#: DuckDB's levenshtein counts bytes; à to ÿ stand as the 64 characters from blank to underscore meanwhile, which no word holds.
SPELLING = f"""
WITH RECURSIVE runs AS MATERIALIZED (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY doc_id, run),
coded AS MATERIALIZED (
    SELECT run, n, {crc32('name')} AS h FROM (SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS name FROM runs), {CRC_TABLE}),
words AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM coded)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
plain AS MATERIALIZED (
    SELECT word, n, length(word) AS size, translate(word, (SELECT string_agg(chr(c::INT), '' ORDER BY c) FROM range(192, 256) t(c)),
        (SELECT string_agg(chr(c::INT), '' ORDER BY c) FROM range(32, 96) t(c))) AS p FROM words),
pairs AS MATERIALIZED (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM plain a JOIN plain b ON b.size BETWEEN a.size - 1 AND a.size + 1 AND a.word <> b.word
    WHERE levenshtein(a.p, b.p) = 1),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
table1 AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
        CASE WHEN near_n >= 5 * n THEN near_n END::BIGINT AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS root FROM table1
    UNION ALL SELECT chain.word, table1.form FROM chain JOIN table1 ON table1.word = chain.root WHERE table1.form IS NOT NULL),
ends AS (SELECT chain.word, chain.root FROM chain JOIN table1 ON table1.word = chain.root WHERE table1.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM table1 JOIN ends USING (word)
"""

CONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS no, doc_id, {WORDS} AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS MATERIALIZED (
    SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
spans AS (SELECT DISTINCT m FROM windows),
grams AS (
    SELECT no, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
    FROM (SELECT no, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, spans WHERE len(w) >= m)),
hits AS MATERIALIZED (SELECT no, grams.m AS m, i, item_id FROM grams JOIN windows ON windows.m = grams.m AND windows.g = grams.g),
covered AS (SELECT no, count(DISTINCT place) AS n_hit FROM (SELECT no, unnest(range(i, i + m)) AS place FROM hits) GROUP BY no),
named AS (SELECT no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT no, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY no)
SELECT doc_id::BIGINT AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (no) LEFT JOIN named USING (no)
"""

EDITED = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
    first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS following FROM documents)
SELECT doc_id::BIGINT AS doc_id, length(text)::BIGINT AS n_chars,
    sha256(substr(text, 1, length(text) - length(text) // 2) || substr(following, 1, length(text) // 2)) AS edited_sha256 FROM t
"""

#: A source stops at twice its words: in rising order of (twice the words) / weight, the first j are full where the level of the rest stays below the next.
MIX_TARGETS = r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
    FROM sized GROUP BY source),
filled AS (SELECT *, sum(2 * source_size) OVER w - 2 * source_size AS before, sum(weight) OVER () - sum(weight) OVER w + weight AS open_weight,
    1.5 * sum(source_size) OVER () AS goal FROM sources WINDOW w AS (ORDER BY 2.0 * source_size / weight, source ROWS UNBOUNDED PRECEDING)),
level AS (SELECT max((goal - before) / open_weight) FILTER (WHERE weight * (goal - before) / open_weight <= 2 * source_size) AS level FROM filled)
SELECT doc_id::BIGINT AS doc_id, size, source_size, round(least(2.0 * source_size, weight * coalesce(level, 1e300)), 3)::DOUBLE AS target
FROM sized JOIN filled ON sized.source IS NOT DISTINCT FROM filled.source, level
"""

SHARD_SLOTS = """
SELECT s::INT AS shard, n::BIGINT AS rows, 0::BIGINT AS first_slot, (n - 1)::BIGINT AS last_slot, n::BIGINT AS slots
FROM (SELECT s, (SELECT count(*) FROM documents) // 40 + CASE WHEN s < (SELECT count(*) FROM documents) % 40 THEN 1 ELSE 0 END AS n FROM range(40) t(s))
WHERE n > 0
"""
