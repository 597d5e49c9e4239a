"""SQL for the numbered operators that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LEVELS = """
g{i} AS (SELECT {path}, sum(capacity) AS capacity FROM leaves GROUP BY {path}),
s{i} AS (SELECT g.*, {given} AS given, {weight} AS weight,
                capacity / {weight} AS ratio FROM g{i} g {join}),
l{i} AS (SELECT *, (given - coalesce(sum(capacity) OVER (PARTITION BY {parent} ORDER BY ratio, {path}
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (PARTITION BY {parent} ORDER BY ratio DESC, {descending}
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level FROM s{i}),
b{i} AS (SELECT {path}, CASE WHEN ratio <= level THEN capacity ELSE CAST(floor(least(
                  weight * max(CASE WHEN ratio > level THEN level END) OVER (PARTITION BY {parent}),
                  capacity)) AS BIGINT) END AS budget FROM l{i}),"""


def _level(i: int, weight: str) -> str:
    names = ["domain", "lang", "source"]
    above, path = names[:i], names[: i + 1]
    return _LEVELS.format(
        i=i, path=", ".join(path), descending=", ".join(f"{c} DESC" for c in path),
        parent=", ".join(above) or "1", weight=weight,
        given=f"p.budget" if i else "(SELECT CAST(floor(sum(n_tokens) * 0.8::DOUBLE) AS BIGINT) FROM leaves)",
        join=f"JOIN b{i - 1} p USING ({', '.join(above)})" if i else "")


ORACLES["op1_mixing"] = rf"""
WITH docs AS (
  SELECT doc_id, coalesce('domain' || (TRY_CAST(nullif(regexp_extract(source, '[0-9]+'), '') AS BIGINT) % 4), '(none)') AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         len({_WORDS}) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
                  CAST(2 * sum(n_tokens) AS BIGINT) AS capacity FROM docs GROUP BY ALL),
{_level(0, "CASE domain WHEN 'domain0' THEN 4.0::DOUBLE WHEN 'domain1' THEN 3.0 WHEN 'domain2' THEN 2.0 ELSE 1.0 END")}
{_level(1, "CASE lang WHEN 'en' THEN 5.0::DOUBLE WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END")}
{_level(2, "1.0::DOUBLE")}
plan AS (SELECT domain, lang, source,
                CASE WHEN n_tokens > 0 THEN budget // n_tokens ELSE 0 END AS epochs,
                CASE WHEN n_tokens > 0 THEN budget % n_tokens ELSE 0 END AS rest
         FROM leaves JOIN b2 USING (domain, lang, source)),
read AS (SELECT docs.*, epochs, rest, sum(n_tokens) OVER (
                  PARTITION BY domain, lang, source
                  ORDER BY md5('mix:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
         FROM docs JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, copies FROM (
  SELECT *, CAST(epochs + CASE WHEN running - n_tokens < rest THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM read) WHERE copies > 0
"""

ORACLES["op2_host_rules"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, * FROM documents),
words AS (SELECT r, unnest({_WORDS}) AS w, generate_subscripts({_WORDS}, 1) AS i FROM docs),
word_stats AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY r),
runs AS (SELECT r, i, row(w, w2, w3, w4, w5) AS run FROM (
  SELECT *, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4,
         lead(w, 4) OVER o AS w5 FROM words WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE w5 IS NOT NULL),
again AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words
            FROM again, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM docs),
line_stats AS (SELECT r, sum(n - 1) AS n_dup_lines FROM (
  SELECT r, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line) GROUP BY r),
stats AS (
  SELECT doc_id, source, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
         CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM docs LEFT JOIN word_stats USING (r) LEFT JOIN repeats USING (r) LEFT JOIN line_stats USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM stats),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS failed
          FROM judged WHERE source IS NOT NULL GROUP BY source),
prior AS (SELECT m, greatest(m * (1 - m) / greatest(coalesce(v, 0), 1e-6) - 1, 1) AS strength
          FROM (SELECT avg(failed / n) AS m, var_samp(failed / n) AS v FROM hosts)),
rates AS (SELECT source, (failed + m * strength) / (n + strength) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(rate <= 0.5, true) AS kept
FROM judged LEFT JOIN rates USING (source)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op6_decontamination"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, w, least(5, len(w)) AS size FROM (
        SELECT DISTINCT item_id, text, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w
        FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
item_runs AS (SELECT DISTINCT item, item_id, size, w[i : i + size - 1] AS run
              FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM b)),
doc_runs AS (SELECT DISTINCT r, doc_id, size, w[i : i + size - 1] AS run
             FROM (SELECT d.*, size, unnest(range(1, len(w) - size + 2)) AS i
                   FROM d, (SELECT DISTINCT size FROM b) WHERE len(w) >= size)),
sizes AS (SELECT item, item_id, count(*) AS n_shingles FROM item_runs GROUP BY ALL),
shared AS (SELECT r, doc_id, item, count(*) AS n_shared FROM doc_runs JOIN item_runs USING (size, run) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared FROM shared JOIN sizes USING (item)
WHERE n_shared >= ceil(0.8 * n_shingles - 1e-9)
"""

ORACLES["op11_importance"] = rf"""
WITH RECURSIVE steps AS (
  SELECT CAST(i AS BIGINT) AS i, 0 AS round, CAST(i AS BIGINT) AS c FROM range(256) r(i) UNION ALL
  SELECT i, round + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE round < 8),
crc AS (SELECT list(c ORDER BY i) AS steps FROM steps WHERE round = 8),
texts AS (
  SELECT doc_id, text, true AS own FROM documents UNION ALL SELECT NULL, text, false FROM benchmark),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, own,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
words AS (SELECT r, own, unnest(words) AS word FROM docs),
spelled AS (SELECT word, hex(encode(word)) AS spelled FROM (SELECT DISTINCT word FROM words)),
buckets AS (
  SELECT word, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(spelled), 2),
             lambda i: CAST('0x' || substr(spelled, i, 2) AS BIGINT))),
           lambda c, b: xor(steps[xor(c & 255, b) + 1], c >> 8))) % 10000 AS bucket
  FROM spelled, crc),
features AS (SELECT r, own, bucket FROM words JOIN buckets USING (word)),
sums AS (SELECT count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM features),
gains AS (
  SELECT bucket, floor(1000 * ln(((count(*) FILTER (NOT own) + 1)::DOUBLE * (any_value(s) + 10000))
                       / ((count(*) FILTER (own) + 1)::DOUBLE * (any_value(t) + 10000)))) AS gain
  FROM features, sums GROUP BY bucket),
weights AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM features JOIN gains USING (bucket)
            WHERE own GROUP BY r),
hashed AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h
  FROM docs LEFT JOIN weights USING (r) WHERE own),
scored AS (
  SELECT doc_id, n_features, weight,
         CAST(weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM hashed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * fit // 100 THEN place END AS rank FROM placed
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < 20
"""

_ROUND = """
n{i} AS (SELECT v, c, d FROM (
  SELECT v, c, d, row_number() OVER (PARTITION BY v ORDER BY d, c) AS place FROM (
    SELECT p.v, c.c, sum((p.x - c.x) * (p.x - c.x)) AS d FROM components p JOIN c{i} c USING (pos) GROUP BY ALL))
  WHERE place = 1),
m{i} AS (SELECT c, pos, sum(x) AS s, count(*) AS n FROM components JOIN n{i} USING (v) GROUP BY ALL),
c{j} AS (SELECT c, pos, coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), x) AS x
         FROM c{i} LEFT JOIN m{i} USING (c, pos)),"""

ORACLES["op13_centroids"] = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS v, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
components AS MATERIALIZED (SELECT v, unnest(range(64)) AS pos, unnest(vector) AS x FROM kept),
c0 AS (
  SELECT c, unnest(range(64)) AS pos, unnest(vector) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS c, vector
    FROM kept QUALIFY c < 8)),
{"".join(_ROUND.format(i=i, j=i + 1) for i in range(10)).replace(" AS (", " AS MATERIALIZED (")}
{_ROUND.format(i=10, j=11).split("m10")[0]}
digests AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c10 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM n10 JOIN kept USING (v) JOIN digests USING (c)
"""
