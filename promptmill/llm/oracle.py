"""DuckDB SQL for the queries that SQL can express; written out apart from the operators."""

from __future__ import annotations

URL_FILTERS = """
WITH rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (
  SELECT page_id, url,
         translate(split_part(split_part(split_part(r, '/', 1), '?', 1), '#', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         split_part(split_part(r, '?', 1), '#', 1) AS plain
  FROM rest),
pages_of AS (
  SELECT page_id, url, host, CASE WHEN strpos(plain, '/') > 0 THEN substr(plain, strpos(plain, '/')) ELSE '' END AS path
  FROM parts),
outcomes AS (
  SELECT host, count(*) AS n, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM pages_of JOIN labels
    ON labels.doc_id = try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS BIGINT)
  WHERE toxic IS NOT NULL OR quality IS NOT NULL
  GROUP BY host),
hosts AS (
  SELECT host, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad,
         array_to_string(string_split(host, '.')[-2:], '.') AS two, string_split(host, '.') AS labels
  FROM (SELECT DISTINCT host FROM pages_of) FULL JOIN outcomes USING (host)),
named AS (
  SELECT host, n, bad,
         CASE WHEN two IN ('ac.uk', 'co.jp', 'co.uk', 'com.au', 'com.br', 'gov.uk', 'org.uk')
              THEN array_to_string(labels[-3:], '.') ELSE two END AS domain,
         CASE WHEN two IN ('ac.uk', 'co.jp', 'co.uk', 'com.au', 'com.br', 'gov.uk', 'org.uk')
              THEN two ELSE labels[-1] END AS suffix
  FROM hosts),
suffix_counts AS (
  SELECT suffix, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad,
         (SELECT (sum(bad) + 1.0) / (sum(n) + 2.0) FROM named) AS prior
  FROM named GROUP BY suffix),
suffixes AS (
  SELECT suffix, (k * prior + bad) / (k + n) AS mean FROM suffix_counts, (SELECT {strength} AS k FROM suffix_counts WHERE n > 0)),
domain_counts AS (
  SELECT domain, any_value(mean) AS prior, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad
  FROM named JOIN suffixes USING (suffix) GROUP BY suffix, domain),
domains AS (
  SELECT domain, (k * prior + bad) / (k + n) AS mean FROM domain_counts, (SELECT {strength} AS k FROM domain_counts WHERE n > 0)),
host_counts AS (
  SELECT host, n::DOUBLE AS n, bad::DOUBLE AS bad, mean AS prior FROM named JOIN domains USING (domain)),
posteriors AS (
  SELECT host, k * prior + bad AS a, k * (1 - prior) + n - bad AS b
  FROM host_counts, (SELECT {strength} AS k FROM host_counts WHERE n > 0)),
bounds AS (
  SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower FROM posteriors),
ruled AS (
  SELECT page_id, host, path, lower,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM pages_of LEFT JOIN bounds USING (host))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN lower > 0.25 AND (SELECT sum(n) FROM named) > 0 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""".replace(
    "{strength}",
    """greatest(2.0, least(1000.0, coalesce(CASE
        WHEN sum(pow(bad - n * prior, 2)) > sum(n * prior * (1 - prior)) AND sum(n * (n - 1) * prior * (1 - prior)) > 0
        THEN (1 - (sum(pow(bad - n * prior, 2)) - sum(n * prior * (1 - prior))) / sum(n * (n - 1) * prior * (1 - prior)))
             / ((sum(pow(bad - n * prior, 2)) - sum(n * prior * (1 - prior))) / sum(n * (n - 1) * prior * (1 - prior)))
        END, 1000.0)))""",
)


def mixing_sql(rounds: int = 8, power: float = 0.85, keep: float = 0.75) -> str:
    """Raking with the rounds written out one after the other."""
    shares = "".join(
        f""",
target_{by} AS (
  SELECT {by}, pow(t, {power}) / sum(pow(t, {power})) OVER () AS target
  FROM (SELECT {by}, sum(tokens)::DOUBLE AS t FROM cells GROUP BY {by}) WHERE t > 0)"""
        for by in ("source", "language", "topic")
    )
    last, steps = "start", ""
    for number in range(rounds):
        for by in ("source", "language", "topic"):
            name = f"w_{number}_{by}"
            steps += f""",
{name} AS (
  SELECT source, language, topic, tokens,
         CASE WHEN sum(weight) OVER (PARTITION BY {by}) > 0
              THEN weight * coalesce(target, 0) / sum(weight) OVER (PARTITION BY {by}) ELSE 0 END AS weight
  FROM {last} LEFT JOIN target_{by} USING ({by}))"""
            last = name
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS language,
         CASE WHEN (length(t) - length(translate(t, '{{}};=<>|', ''))) * 50 > greatest(length(t), 1) THEN 'code'
              WHEN (length(t) - length(translate(t, '0123456789', ''))) * 25 > greatest(length(t), 1) THEN 'figures'
              WHEN (length(t) - length(translate(t, chr(10), ''))) * 60 > greatest(length(t), 1) THEN 'lists'
              ELSE 'prose' END AS topic,
         CAST(ceil(strlen(t) / 4.0) AS BIGINT) AS tokens
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents)),
cells AS (SELECT source, language, topic, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
start AS (SELECT *, tokens / (SELECT sum(tokens)::DOUBLE FROM cells) AS weight FROM cells){shares}{steps},
ranked AS (
  SELECT tokens, weight, row_number() OVER o AS k,
         sum(tokens) OVER o AS whole, sum(weight) OVER () - sum(weight) OVER o AS rest,
         lead(weight) OVER o AS next_weight, lead(tokens) OVER o AS next_tokens
  FROM {last} WHERE tokens > 0 AND weight > 0
  WINDOW o AS (ORDER BY weight / tokens DESC, source, language, topic ROWS UNBOUNDED PRECEDING)),
heads AS (
  SELECT k, whole, rest, next_weight, next_tokens FROM ranked
  UNION ALL
  SELECT 0, 0, (SELECT sum(weight) FROM ranked), weight, tokens FROM ranked WHERE k = 1),
scales AS (
  SELECT k, ({keep} * (SELECT sum(tokens) FROM ranked) - whole) / rest AS s, next_weight, next_tokens
  FROM heads WHERE next_tokens IS NOT NULL),
scale AS (SELECT arg_min(s, k) AS s FROM scales WHERE s * next_weight < next_tokens),
rates AS (
  SELECT source, language, topic,
         CASE WHEN tokens > 0 THEN least(1.0, weight / tokens * (SELECT s FROM scale)) ELSE 1.0 END AS p
  FROM {last})
SELECT doc_id, source, language, topic, tokens, round(p, 6) AS probability,
       CAST('0x' || substr(md5('8:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) / 4294967296.0 < p AS sampled
FROM docs JOIN rates USING (source, language, topic)
"""


def clusters_sql(centroids: int = 16, rounds: int = 3) -> str:
    """Rounds written out one after the other; a centroid is a list of its 64 components."""
    steps = ["""whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64)"""]
    steps.append(f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id::VARCHAR))) - 1 AS c, v
  FROM whole ORDER BY sha256(concat('1:', vec_id::VARCHAR)) LIMIT {centroids})""")
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
  SELECT vec_id, w.v, c, list_sum(list_transform(list_zip(w.v, k.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
  FROM whole w CROSS JOIN c{i} k QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
  SELECT c, j, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m
  FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY c, j),
m{i} AS (SELECT c, list(m::BIGINT ORDER BY j) AS v FROM s{i} GROUP BY c),
c{i + 1} AS (SELECT k.c, coalesce(m.v, k.v) AS v FROM c{i} k LEFT JOIN m{i} m ON m.c = k.c)""")
    last = rounds
    return f"""WITH {", ".join(steps)}
SELECT vec_id, a.c::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} k ON k.c = a.c"""


ORACLE: dict[str, str] = {
    "op6_url_filters": URL_FILTERS,
    "op8_mixing_weights": mixing_sql(),
    "op12_centroid_clusters": clusters_sql(),
}
