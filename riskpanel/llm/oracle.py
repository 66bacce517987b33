"""Equivalent DuckDB SQL of the queries that SQL can express, written in another shape than the operators.

Not here: the classifier and the network (trained), byte-pair encoding, and checksums (DuckDB has no CRC-32). These are
held against plain versions, the library and held-out labels in tests/llm.
"""

from __future__ import annotations

from riskpanel.llm.collocations import PhraseConfig
from riskpanel.llm.lloyd import LloydConfig
from riskpanel.llm.mixing import MixConfig
from riskpanel.llm.quality_rules import MEASURES, RuleConfig
from riskpanel.llm.unit_dedup import UnitConfig
from riskpanel.llm.url_reputation import ReputationConfig

SPACE = r"[\x20\x09-\x0D]"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = f"list_filter(string_split_regex(coalesce({{0}}, ''), '{SPACE}+'), lambda w: w <> '')"


def url_reputation(config: ReputationConfig = ReputationConfig()) -> str:
    fits = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in config.rules)

    def strength(table: str) -> str:
        return f"""
    SELECT CASE WHEN room IS NULL OR room = 0 OR found <= chance THEN {config.most}
                ELSE least({config.most}, greatest({config.least}, room / (found - chance) - 1)) END AS size
    FROM (SELECT sum(seen * pow(bad / seen - prior, 2)) AS found, sum(prior * (1 - prior)) AS chance,
                 sum((seen - 1) * prior * (1 - prior)) AS room FROM {table} WHERE seen > 0)"""

    return rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT row_number() OVER () AS row, page_id, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
outcome AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, count(*) FILTER (quality = 0) AS bad, count(quality) AS seen,
         string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS labels
  FROM split LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
named AS (SELECT *, array_to_string(labels[-2:], '.') AS domain, labels[-1] AS suffix FROM hosts),
overall AS (SELECT (sum(bad) + 1) / (sum(seen) + 2) AS prior, sum(seen) + 2 AS support FROM hosts),
suffixes AS (SELECT suffix, sum(bad) AS bad, sum(seen) AS seen, any_value(prior) AS prior,
                    any_value(support) AS support FROM named, overall GROUP BY suffix),
s_size AS ({strength('suffixes')}),
s_mean AS (
  SELECT suffix, (bad + least(size, support) * prior) / (seen + least(size, support)) AS mean, seen + least(size, support) AS support
  FROM suffixes, s_size),
domains AS (
  SELECT domain, suffix, sum(bad) AS bad, sum(seen) AS seen, any_value(mean) AS prior,
         any_value(support) AS support FROM named JOIN s_mean USING (suffix) GROUP BY domain, suffix),
d_size AS ({strength('domains')}),
d_mean AS (
  SELECT domain, suffix, (bad + least(size, support) * prior) / (seen + least(size, support)) AS mean,
         seen + least(size, support) AS support FROM domains, d_size),
priors AS (SELECT host, bad, seen, mean AS prior, support FROM named JOIN d_mean USING (domain, suffix)),
h_size AS ({strength('priors')}),
posterior AS (
  SELECT host, seen, bad + least(size, support) * prior AS a, seen - bad + least(size, support) * (1 - prior) AS b FROM priors, h_size),
bounds AS (SELECT host, seen, a / (a + b) - {config.deviations} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM posterior),
rules AS (SELECT * FROM (VALUES {fits}) AS r(verdict, rule_host, rule_path)),
best AS (
  SELECT row, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bound > {config.limit} THEN 'block' ELSE 'allow' END) AS verdict, seen
FROM split LEFT JOIN best USING (row) JOIN bounds USING (host)"""


def line_dedup(config: UnitConfig = UnitConfig()) -> str:
    def equal(name: str, most: str, mine: str, other_d: str, other: str) -> str:
        """How many words are equal beside each run and beside the place kept, up to the first that differ."""
        return f"""
{name} AS (
  SELECT r.d, r.run, coalesce(min(t) - 1, any_value(most)) AS {name}
  FROM (SELECT *, {most} AS most FROM runs) AS r
  LEFT JOIN (
    SELECT q.d, q.run, q.t FROM (SELECT *, unnest(range(1, {most} + 1)) AS t FROM runs) AS q
    JOIN placed AS x ON x.d = q.d AND x.i = {mine} JOIN placed AS y ON y.d = q.{other_d} AND y.i = {other} WHERE x.l <> y.l) AS m
  ON m.d = r.d AND m.run = r.run GROUP BY r.d, r.run)"""

    return rf"""
WITH texts AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS d, doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         regexp_extract_all(text, '{SPACE}+') AS gaps, CASE WHEN regexp_matches(text, '^{SPACE}') THEN 1 ELSE 0 END AS lead
  FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
numbered AS (
  SELECT d, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i, unnest(list_resize(gaps[lead + 1:], len(w), '')) AS gap,
         len(w) AS size, CASE WHEN lead = 1 THEN length(gaps[1]) ELSE 0 END AS indent FROM texts),
placed AS (
  SELECT d, i, {LOWER.format('w')} AS l, length(w) AS n, size, i = size OR contains(gap, chr(10)) OR regexp_matches(w, '[.!?,;:]$') AS ends,
         indent + coalesce(sum(length(w) + length(gap)) OVER (PARTITION BY d ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM numbered),
bounds AS (
  SELECT d, i, coalesce(lag(ends) OVER (PARTITION BY d ORDER BY i), true) AS begins,
         min(CASE WHEN ends THEN i END) OVER (PARTITION BY d ORDER BY i ROWS BETWEEN {config.seed_words - 1} FOLLOWING AND UNBOUNDED FOLLOWING) AS j
  FROM placed),
seeds AS (
  SELECT b.d, b.i, any_value(j) AS j, string_agg(l, ' ' ORDER BY p.i) AS seed
  FROM (SELECT *, unnest(range(i, j + 1)) AS at FROM bounds WHERE begins AND j IS NOT NULL) AS b JOIN placed AS p ON p.d = b.d AND p.i = b.at
  GROUP BY b.d, b.i),
kept AS (SELECT seed, arg_min(d, (d, i)) AS kept_d, arg_min(i, (d, i)) AS kept_i, arg_min(j, (d, i)) AS kept_j FROM seeds GROUP BY seed HAVING count(*) > 1),
repeated AS (SELECT * FROM seeds JOIN kept USING (seed) WHERE (d, i) <> (kept_d, kept_i)),
linked AS (
  SELECT *, CASE WHEN i <= max(j) OVER (PARTITION BY d ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM repeated),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY d ORDER BY i) AS run FROM linked),
joined AS (
  SELECT d, run, min(i) AS i, max(j) AS j, arg_min(kept_d, i) AS kept_d, arg_min(kept_i, i) AS kept_i, arg_max(kept_d, (j, i)) AS last_d,
         arg_max(kept_j, (j, i)) AS last_j FROM grouped GROUP BY d, run),
sizes AS (SELECT d, any_value(size) AS size FROM placed GROUP BY d),
runs AS (
  SELECT joined.*, least(i, kept_i) - 1 AS room_a, least(x.size - j, z.size - last_j) AS room_b
  FROM joined JOIN sizes AS x ON x.d = joined.d JOIN sizes AS z ON z.d = last_d),{equal("a", "room_a", "q.i - t", "kept_d", "q.kept_i - t")},{
        equal("b", "room_b", "q.j + t", "last_d", "q.last_j + t")},
passages AS (
  SELECT d, i - a AS i, j + b AS j, kept_d, kept_i - a AS kept_i FROM runs JOIN a USING (d, run) JOIN b USING (d, run)
  WHERE j + b - (i - a) + 1 >= {config.least_words})
SELECT t.doc_id, CAST(x.start AS INTEGER) AS start, CAST(y.start + y.n AS INTEGER) AS "end", CAST(p.j - p.i + 1 AS INTEGER) AS words,
       k.doc_id AS kept_doc_id, CAST(z.start AS INTEGER) AS kept_start
FROM passages AS p JOIN texts AS t ON t.d = p.d JOIN texts AS k ON k.d = p.kept_d
JOIN placed AS x ON x.d = p.d AND x.i = p.i JOIN placed AS y ON y.d = p.d AND y.i = p.j JOIN placed AS z ON z.d = p.kept_d AND z.i = p.kept_i"""


def block_top_k(k: int = 20, every: int = 20) -> str:
    return f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_dot_product(q.w, v.w) AS BIGINT) AS score
  FROM whole AS q JOIN whole AS v ON q.vec_id % {every} = 0 AND q.vec_id <> v.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {k}"""


def ngram_join() -> str:
    return f"""
WITH RECURSIVE texts AS (SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, gram FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(w[i:i + 4], ' '))) AS gram
    FROM texts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams AS a JOIN grams AS b ON a.gram = b.gram AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
undirected AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM undirected UNION SELECT reach.doc_id, e.b FROM reach JOIN undirected AS e ON reach.other = e.a),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""


def source_mixing(config: MixConfig = MixConfig()) -> str:
    weights = ", ".join(map(str, config.weights))
    return f"""
WITH RECURSIVE sized AS (SELECT doc_id, source, coalesce(text, '') AS text, len({WORDS.format('text')}) AS size FROM documents),
totals AS (SELECT source, sum(size) AS source_size, count(*) AS docs FROM sized GROUP BY source),
weighted AS (
  SELECT *, [{weights}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(config.weights)} + 1] AS weight,
         {config.cap}::DOUBLE * source_size AS room, {min(config.share, config.cap)}::DOUBLE * sum(source_size) OVER () AS wanted FROM totals),
levels AS (
  SELECT *, (wanted - coalesce(sum(room) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
targets AS (SELECT *, least(room, max(level) OVER () * weight) AS target FROM levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate, source_size::DOUBLE / docs AS mean_size FROM targets),
parts AS (SELECT *, floor(rate) AS whole, rate - floor(rate) AS part, floor(target - floor(rate) * source_size) AS quota FROM rates),
drawn AS (
  SELECT sized.*, (CAST('0x' || substr(md5('{config.seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(text)), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
         source_size, target, whole, part, quota, mean_size
  FROM sized JOIN parts ON sized.source IS NOT DISTINCT FROM parts.source),
equal AS (
  SELECT doc_id, text, source, any_value(size) AS one, sum(size) AS size, any_value(u) AS u, any_value(part) AS part, any_value(mean_size) AS mean_size,
         any_value(quota) AS quota FROM drawn WHERE size > 0 AND part > 0 GROUP BY doc_id, text, source),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY u / (1 - u) / (part / (1 - part) * sqrt(one / mean_size)), doc_id NULLS LAST, size) AS pos FROM equal),
fill AS (
  SELECT source, CAST(0 AS BIGINT) AS pos, CAST(max(quota) AS BIGINT) AS open, 0 AS extra FROM ranked GROUP BY source
  UNION ALL
  SELECT r.source, r.pos, CASE WHEN r.size <= f.open THEN f.open - r.size ELSE f.open END, CASE WHEN r.size <= f.open THEN 1 ELSE 0 END
  FROM fill AS f JOIN ranked AS r ON f.source IS NOT DISTINCT FROM r.source AND r.pos = f.pos + 1),
extra AS (
  SELECT doc_id, text, ranked.source, extra FROM ranked JOIN fill ON ranked.source IS NOT DISTINCT FROM fill.source AND ranked.pos = fill.pos)
SELECT d.doc_id, d.size, CAST(d.source_size AS BIGINT) AS source_size, d.target, CAST(d.size * (d.whole + coalesce(e.extra, 0)) AS BIGINT) AS taken
FROM drawn AS d LEFT JOIN extra AS e ON d.doc_id IS NOT DISTINCT FROM e.doc_id AND d.source IS NOT DISTINCT FROM e.source AND d.text = e.text"""


def quality_rules(config: RuleConfig = RuleConfig()) -> str:
    languages = ", ".join(f"'{x}'" for x in config.languages)
    steps = ", ".join(
        f"('{rule}', {step}, {cutoff})" for rule, cutoffs in config.cutoffs.items() for step, cutoff in enumerate(cutoffs)
    )
    share = " ".join(f"WHEN '{rule}' THEN 1000 * {a} > cutoff * {b}" for rule, (a, b) in MEASURES.items())
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text, {WORDS.format('text')} AS w FROM documents),
windows AS (SELECT row, unnest(range(1, len(w) - 1)) AS i, w FROM texts WHERE len(w) > 2),
found AS (SELECT row, list(i) AS places FROM windows GROUP BY row, w[i:i + 2] HAVING count(*) > 1),
covered AS (
  SELECT row, count(DISTINCT i + d) AS n FROM (SELECT row, unnest(places) AS i FROM found), (SELECT unnest([0, 1, 2]) AS d) GROUP BY row),
counted AS (
  SELECT row, doc_id, CASE WHEN lang IN ({languages}) THEN lang ELSE 'other' END AS stratum, CAST(len(w) AS BIGINT) AS n_words,
         length(array_to_string(w, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts),
stats AS (
  SELECT c.* EXCLUDE (lines), CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, n_words < 50 OR 100 * coalesce(n, 0) > 50 * n_words AS base_failed
  FROM counted AS c LEFT JOIN covered USING (row)),
good AS (
  SELECT * FROM stats WHERE NOT base_failed AND doc_id IN (
    SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)),
steps AS (SELECT * FROM (VALUES {steps}) AS s(rule, step, cutoff)),
tested AS (
  SELECT stratum, rule, step, cutoff, count(*) AS n, count(*) FILTER (CASE rule {share} END) AS k FROM good, steps GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN k > {config.rate} * n THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({config.rate}) + (n - i) * ln(1 - {config.rate})))) END AS tail FROM tested),
open AS (SELECT *, bool_and(tail <= {config.level}) OVER (PARTITION BY stratum, rule ORDER BY step) AS passes FROM tails),
chosen AS (SELECT stratum, rule, arg_max(cutoff, step) AS cutoff FROM open WHERE passes GROUP BY stratum, rule),
rejected AS (SELECT DISTINCT row FROM stats JOIN chosen USING (stratum) WHERE CASE rule {share} END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, stratum, base_failed,
       NOT base_failed AND row NOT IN (SELECT row FROM rejected) AS kept FROM stats"""


def centroid_clusters(config: LloydConfig = LloydConfig()) -> str:
    """Rounds one after another; every vector meets every centroid."""

    def nearest(r: int) -> str:
        return f"""
found{r} AS (
  SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT row, cluster, list_sum(list_transform(list_zip(v.w, c.w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM kept AS v, c{r} AS c) GROUP BY row)"""

    def moved(r: int) -> str:
        return f"""
sums{r} AS (
  SELECT cluster, i, sum(w[i]) AS s, count(*) AS n FROM kept JOIN found{r} USING (row), range(1, {config.width + 1}) AS t(i) GROUP BY cluster, i),
means{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS w FROM sums{r} GROUP BY cluster),
c{r + 1} AS (SELECT c.cluster, coalesce(m.w, c.w) AS w FROM c{r} AS c LEFT JOIN means{r} AS m USING (cluster))"""

    rounds = ",".join(nearest(r) + "," + moved(r) for r in range(config.rounds))
    last = config.rounds
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor({config.scale} * CAST(x AS DOUBLE)) AS HUGEINT)) AS w
  FROM embeddings
  WHERE len(embedding) = {config.width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {config.width}),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{config.salt}:' || vec_id) NULLS LAST, w) - 1 AS cluster, w FROM kept
  QUALIFY cluster < {config.clusters}),{rounds},{nearest(last)},
inertias AS (SELECT cluster, sum(distance) AS cluster_inertia FROM found{last} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(distance) FROM found{last}) AS BIGINT) AS inertia, sha256(array_to_string(centre, ',')) AS centroid_sha256
FROM found{last} JOIN kept USING (row) JOIN inertias USING (cluster) JOIN (SELECT cluster, w AS centre FROM c{last}) USING (cluster)"""


def collocations(config: PhraseConfig = PhraseConfig()) -> str:
    cuts = ", ".join(f"{k}" for k in range(1, config.longest))
    return rf"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, {LOWER.format("coalesce(text, '')")} AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
spelled AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM spelled, range(1, {config.longest + 1}) AS t(m))),
f AS (SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM grams GROUP BY lang, phrase),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= {config.least}),
cuts AS (
  SELECT c.lang, c.phrase, k, a, x.f AS l, y.f AS r, CAST(n AS HUGEINT) AS n, 1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS score
  FROM candidates AS c JOIN (SELECT unnest([{cuts}]) AS k) ON k < m JOIN totals USING (lang)
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT c.lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, m, a, s, unnest(range(1, m - s + 2)) AS i FROM candidates, range(2, {config.longest}) AS t(s) WHERE s < m) AS c GROUP BY ALL),
kept AS (
  SELECT * FROM lowest AS l WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts AS p WHERE p.lang = l.lang AND p.phrase = l.phrase AND 100 * p.longer >= 100 * l.a))
SELECT lang, CAST(row_number() OVER best AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) QUALIFY rank <= {config.top}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_reputation": url_reputation(),
        "op3_line_dedup": line_dedup(),
        "op4_block_top_k": block_top_k(),
        "op5_ngram_join": ngram_join(),
        "op6_source_mixing": source_mixing(),
        "op10_quality_rules": quality_rules(),
        "op12_collocations": collocations(),
        "op13_sharded_lloyd": centroid_clusters(),
    }
