"""DuckDB SQL of the queries that SQL can express.

Files (op3), tokenizers (op3, op8, op9, op13), leftmost matching with a token
vocabulary (op2) and a learned grammar (op6) are beyond it; their tests compare
them with brute force.
"""

from __future__ import annotations

from fleetpulse.llm import centroid_drift, quality
from fleetpulse.llm.catalog import DAY, FIRST_FETCH
from fleetpulse.llm.url_lists import OPEN_END

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_window),
doc_window AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, i, size, item_id FROM doc_window JOIN item_window USING (size, words)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
FROM k
"""

URL_LISTS = f"""
WITH page AS (
  SELECT page_id, url, {FIRST_FETCH} + (page_id * 7919 % 365) * {DAY} + page_id % {DAY} AS fetched_at,
    nullif(rtrim(regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''),
      ':[0-9]*$', ''), '.'), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS step
  FROM pages),
entry AS (
  SELECT 'hosts' AS list_name, host AS entry, 3 AS every, page_id FROM page UNION ALL
  SELECT 'domains', array_to_string(list_slice(string_split(host, '.'), -3, -1), '.'), 7, page_id FROM page UNION ALL
  SELECT 'paths', CASE WHEN step <> '' THEN host || '/' || step END, 2, page_id FROM page),
firsts AS (
  SELECT list_name, entry, min(page_id) AS f FROM entry WHERE entry IS NOT NULL
  GROUP BY list_name, entry, every HAVING min(page_id) % every = 0),
change AS (
  SELECT list_name, entry, {FIRST_FETCH} + (f * 31 % 200) * {DAY} AS since, 1 AS active FROM firsts UNION ALL
  SELECT list_name, entry, {FIRST_FETCH} + (f * 31 % 200 + f % 90 + 1) * {DAY}, 0 FROM firsts UNION ALL
  SELECT list_name, entry, {FIRST_FETCH} + (f * 31 % 200 + f % 90 + 40) * {DAY}, CASE WHEN f % 2 = 0 THEN 1 ELSE 0 END FROM firsts),
state AS (SELECT list_name, entry, since, min(active) AS active FROM change GROUP BY ALL),
turn AS (
  SELECT * FROM (SELECT *, lag(active, 1, 0) OVER (PARTITION BY list_name, entry ORDER BY since) AS before FROM state)
  WHERE active <> before),
span AS (
  SELECT list_name, entry, since AS valid_from, lead(since, 1, {OPEN_END}) OVER (PARTITION BY list_name, entry ORDER BY since) AS valid_to, active
  FROM turn),
ask AS (
  SELECT page_id, fetched_at, unnest(list_distinct(list_concat(
      list_transform(range(1, len(l) + 1), lambda i: array_to_string(l[i:], '.')),
      list_transform(range(1, len(s) + 1), lambda n: host || '/' || array_to_string(s[1:n], '/'))))) AS entry
  FROM (SELECT *, string_split(host, '.') AS l, list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM page
        WHERE host IS NOT NULL)),
hit AS (
  SELECT page_id, list_name, entry, valid_from, valid_to, count(*) OVER (PARTITION BY page_id) AS n_matches,
    row_number() OVER (PARTITION BY page_id ORDER BY length(entry) DESC, entry, list_name) AS k
  FROM ask JOIN span USING (entry) WHERE active = 1 AND valid_from <= fetched_at AND fetched_at < valid_to)
SELECT page_id, url, fetched_at, entry IS NOT NULL AS blocked, list_name, entry, valid_from, valid_to, coalesce(n_matches, 0) AS n_matches
FROM page LEFT JOIN (SELECT * FROM hit WHERE k = 1) USING (page_id)
"""

JACCARD = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
item AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM item GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM item a JOIN item b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""

_LINKS = JACCARD.partition("edge AS")[0].replace("WITH RECURSIVE", "WITH", 1)
LINK_COUNTS = f"""
SELECT doc_id, n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM ({JACCARD}) LEFT JOIN (
  {_LINKS}edge AS (SELECT a AS doc_id FROM link UNION ALL SELECT b FROM link)
  SELECT doc_id, count(*) AS n_links FROM edge GROUP BY doc_id) USING (doc_id)
"""

MINMAX = f"""
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept
FROM ({JACCARD.replace("w[i : i + 4]", "w[i : i + 3]").replace("greatest(len(w) - 4, 1)", "greatest(len(w) - 3, 1)")})
"""


def _centroids() -> str:
    """Every round as its own step; centroids are rows of whole numbers."""
    d, scale = centroid_drift.DIMENSIONS, centroid_drift.SCALE
    nearest = """
      SELECT n, vec_id, x, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
        SELECT n, vec_id, x, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
        FROM v, {centroids}) GROUP BY ALL"""
    nearest = nearest.replace("GROUP BY ALL", "GROUP BY n, vec_id, x")
    steps = [f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {d} AND len(list_filter(embedding, lambda e: isfinite(e))) = {d}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x AS c
  FROM (SELECT sha256('{centroid_drift.SEED}:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {centroid_drift.CLUSTERS}))"""]
    for k in range(centroid_drift.ROUNDS):
        steps.append(f"""a{k} AS MATERIALIZED ({nearest.format(centroids=f"c{k}")}),
c{k + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, c{k}.c) AS c FROM c{k} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
      SELECT cluster, i, sum(e) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(x) AS e, unnest(range(1, {d + 1})) AS i FROM a{k}) GROUP BY cluster, i) GROUP BY cluster) m USING (cluster))""")
    last = centroid_drift.ROUNDS
    steps.append(f"""a AS MATERIALIZED ({nearest.format(centroids=f"c{last}")})
SELECT vec_id, CAST(cluster AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a JOIN c{last} USING (cluster)""")
    return ",\n".join(steps)


def _quality() -> str:
    steps = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{r.name}' AS rule, {r.floor} AS floor, "
        f"{r.over} * {r.scale} // greatest({r.by}, 1) AS step FROM facts"
        for r in quality.RULES
    )
    cut = f"greatest(length(bin(step)) - {quality.SKETCH_BITS}, 0)"
    bin_ = f"(step >> {cut}) << {cut}"
    limit = f"""
      SELECT lang, source, rule, max(size) AS size, max(q3 + {quality.SPREAD} * greatest(q3 - q1, floor)) AS most FROM (
        SELECT lang, source, rule, floor, max(size) AS size, min(step) FILTER (4 * below >= size) AS q1,
          min(step) FILTER (4 * below >= 3 * size) AS q3
        FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY step) AS below,
                sum(n) OVER (PARTITION BY lang, source, rule) AS size
              FROM (SELECT {{keys}}, rule, floor, {bin_} AS step, count(*) AS n FROM rate WHERE doc_id IN (SELECT doc_id FROM facts WHERE NOT base_failed)
                    GROUP BY ALL))
        GROUP BY ALL) GROUP BY ALL"""
    prior = quality.PRIOR_ROWS
    return f"""
WITH part AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda v: regexp_matches(v, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM part WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
again AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
base AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '{quality.SYMBOLS}')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words
  FROM part LEFT JOIN again USING (doc_id)),
facts AS (
  SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM base),
rate AS ({steps}),
own AS ({limit.format(keys="lang, source")}),
tongue AS ({limit.format(keys="lang, 0 AS source")}),
whole AS ({limit.format(keys="0 AS lang, 0 AS source")}),
above AS (
  SELECT DISTINCT r.doc_id FROM rate r
  JOIN own o ON r.rule = o.rule AND r.lang IS NOT DISTINCT FROM o.lang AND r.source IS NOT DISTINCT FROM o.source
  JOIN tongue t ON r.rule = t.rule AND r.lang IS NOT DISTINCT FROM t.lang JOIN whole a ON r.rule = a.rule
  WHERE r.step > (o.size * o.most + {prior} * ((t.size * t.most + {prior} * a.most) // (t.size + {prior}))) // (o.size + {prior}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM above) AS kept
FROM facts
"""


ORACLE = {
    "op1_decontamination": DECONTAMINATION,
    "op4_warc": WARC,
    "op5_url_lists": URL_LISTS,
    "op7_jaccard_join": JACCARD,
    "op7_link_counts": LINK_COUNTS,
    "op10_quality": _quality(),
    "op11_minmax_dedup": MINMAX,
    "op12_centroid_drift": _centroids(),
}
