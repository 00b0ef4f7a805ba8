"""DuckDB texts of the queries that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def mixing(documents: str, draw: str = "doc_id") -> str:
    """CTEs up to ``mix`` (doc_id, text, lang, source, n_chars, size, source_size, target, copies) over the relation ``documents``."""
    return rf"""
sized AS (SELECT *, len({_WORDS})::BIGINT AS size,
    ('0x' || substr(md5('42:' || coalesce({draw}::VARCHAR, 'null')), 1, 15))::BIGINT AS draw FROM {documents}),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, ([5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS weight,
    2.0::DOUBLE * source_size AS cap FROM per_source),
rest AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::BIGINT) - coalesce(sum(cap) OVER below, 0) AS room, sum(weight) OVER above AS heft
    FROM weighed WINDOW
    below AS (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    above AS (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
levels AS (SELECT source, source_size, coalesce(weight * first_value(CASE WHEN room * weight / heft < cap THEN room / heft END IGNORE NULLS)
    OVER (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), cap) AS target FROM rest),
rules AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM levels),
running AS (SELECT source, draw, sum(sum(size)) OVER (PARTITION BY source ORDER BY draw) - sum(size) / 2.0::DOUBLE AS middle
    FROM sized GROUP BY source, draw),
cuts AS (SELECT r.source, min(draw) AS cut FROM running r JOIN rules t ON r.source IS NOT DISTINCT FROM t.source
    WHERE middle > target - whole * source_size GROUP BY r.source),
mix AS (SELECT s.*, t.source_size, t.target, (whole + CASE WHEN target > whole * source_size AND (cut IS NULL OR draw < cut) THEN 1 ELSE 0 END)
    ::BIGINT AS copies FROM sized s JOIN rules t ON s.source IS NOT DISTINCT FROM t.source
    LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source)"""


OP7 = f"WITH {mixing('documents')} SELECT doc_id, size, source_size, target, size * copies AS taken FROM mix"

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
a AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS key FROM d, unnest(range(1, len(w) - 3)) AS r(i)),
again AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, key) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM again, unnest([0, 1, 2, 3, 4]) AS t(k) GROUP BY rid),
stats AS (SELECT a.rid, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM a LEFT JOIN rep ON a.rid = rep.rid),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM stats),
steps AS (SELECT rid, lang, source, base_failed, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) AS measure,
    unnest([CASE WHEN word_chars > 0 THEN least(1000 * n_symbols // word_chars, 1000) END,
            CASE WHEN n_lines > 0 THEN least(1000 * n_dup_lines // n_lines, 1000) END,
            CASE WHEN n_words > 0 THEN least(1000 * n_repeat_words // n_words, 1000) END,
            CASE WHEN n_words > 0 THEN least(10 * word_chars // n_words, 1000) END]) AS step FROM base),
seen AS (SELECT * FROM steps WHERE NOT base_failed AND step IS NOT NULL),
levels AS (
    SELECT 1 AS level, lang, source, measure, step, count(*) AS n FROM seen GROUP BY ALL
    UNION ALL SELECT 2, lang, NULL, measure, step, count(*) FROM seen GROUP BY ALL
    UNION ALL SELECT 3, NULL, NULL, measure, step, count(*) FROM seen GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY step) AS c,
    sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM levels),
quant AS (SELECT level, lang, source, measure, any_value(total) AS n_docs, min(step) FILTER (c >= 0.1::DOUBLE * total) AS q10,
    min(step) FILTER (c >= 0.5::DOUBLE * total) AS q50, min(step) FILTER (c >= 0.9::DOUBLE * total) AS q90
    FROM cum GROUP BY level, lang, source, measure),
fence AS (SELECT level, lang, source, measure, n_docs,
    CASE WHEN measure = 'word_length' THEN q50 - greatest(4 * (q50 - q10), 15) END AS low,
    q50 + greatest(4 * (q90 - q50), CASE measure WHEN 'symbols' THEN 60 WHEN 'dup_lines' THEN 300 WHEN 'repeats' THEN 200 ELSE 20 END) AS high
    FROM quant),
pick AS (SELECT f1.lang, f1.source, f1.measure,
    CASE WHEN f1.n_docs >= 50 THEN f1.low WHEN f2.n_docs >= 50 THEN f2.low ELSE f3.low END AS low,
    CASE WHEN f1.n_docs >= 50 THEN least(f1.high, f2.high, f3.high) WHEN f2.n_docs >= 50 THEN least(f2.high, f3.high) ELSE f3.high END AS high
    FROM fence f1 JOIN fence f2 ON f1.level = 1 AND f2.level = 2 AND f1.lang IS NOT DISTINCT FROM f2.lang AND f1.measure = f2.measure
    JOIN fence f3 ON f3.level = 3 AND f3.measure = f1.measure),
outside AS (SELECT DISTINCT s.rid FROM steps s JOIN pick p ON s.lang IS NOT DISTINCT FROM p.lang AND s.source IS NOT DISTINCT FROM p.source
    AND s.measure = p.measure WHERE s.step < p.low OR s.step > p.high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND outside.rid IS NULL AS kept
FROM base LEFT JOIN outside ON base.rid = outside.rid"""

_UNITS = "regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]')"

OP11 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_UNITS} AS u, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
r AS (SELECT *, len(u)::BIGINT AS n, list_transform(range(4), lambda k: ('0x' || substr(h, (8 * k + 1)::INT, 8))::BIGINT) AS x FROM d),
c AS (SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 90 THEN 'plain'
    WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""

# crc32 is computed from its polynomial: a table of 256 values, then one step per byte of every distinct feature
OP13 = r"""
WITH steps AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS t),
texts AS (SELECT row_number() OVER () AS rid, doc_id, text, true AS own FROM documents
    UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark),
words AS (SELECT rid, doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
f AS MATERIALIZED (SELECT rid, own, feature, count(*) AS n FROM (SELECT rid, own, unnest(list_concat(w, list_transform(range(1, len(w)),
    lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words) GROUP BY ALL),
kinds AS (SELECT DISTINCT feature, hex(encode(feature)) AS x FROM f),
coded AS MATERIALIZED (SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2),
    lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT)), lambda c, b: xor(c >> 8, steps.t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
    FROM kinds, steps),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS t
    FROM f JOIN coded USING (feature) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM sums),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS g FROM sums, totals),
mean AS (SELECT rid, sum(n)::BIGINT AS n_features, floor(sum(n * g)::DOUBLE / sum(n))::BIGINT AS weight
    FROM f JOIN coded USING (feature) JOIN gain USING (bucket) WHERE own GROUP BY rid),
noisy AS (SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) +
    floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM words LEFT JOIN mean USING (rid) WHERE own),
drawn AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST, n_features) AS rank FROM noisy WHERE n_words >= 20
    QUALIFY rank <= 25 * count(*) OVER () // 100)
SELECT doc_id, n_features, weight, score, rank FROM noisy LEFT JOIN drawn USING (rid)"""
