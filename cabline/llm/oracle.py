"""DuckDB SQL for the numbered queries that SQL can express on whole tables."""

from __future__ import annotations

from cabline.llm import url_reputation as url
from cabline.llm.queries import PAGE_NUMBER, URL_RULES

_LOWER = ("translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def _decontamination() -> str:
    words = (f"regexp_extract_all({_LOWER.format('text')}, "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item, w, least(13, len(w)) AS size FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, size, w[i:i + size - 1] AS words
            FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized) s),
docs AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {words} END AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, p, w[p:p + size - 1] AS words
           FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
                 FROM docs, sizes) x),
hits AS (SELECT doc_id, p, places.size, item FROM places
         JOIN windows ON places.size = windows.size AND places.words = windows.words),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + size)) AS word FROM hits) c GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
           FROM (SELECT DISTINCT doc_id, item FROM hits) o GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(digest, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN owners USING (doc_id)"""


def _near_duplicates() -> str:
    words = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+')"
    return f"""WITH RECURSIVE docs AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {words} END AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
             FROM (SELECT doc_id, w, unnest(range(1, greatest(0, len(w) - least(5, len(w)) + 1)
                                                  + least(1, len(w)))) AS i FROM docs) x),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a
           JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common c JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
          WHERE 100 * c.n >= 85 * (a.n + b.n - c.n)),
reached(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.id, l.y FROM reached r JOIN links l ON l.x = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, r.component_id = d.doc_id AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT id AS doc_id, min(other) AS component_id FROM reached GROUP BY id) r USING (doc_id)"""


def _url_reputation(max_bad: float = 0.3, z: float = 1.645) -> str:
    host = _LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")
    long = ", ".join(f"'{s}'" for s in url.LONG_SUFFIXES)

    def last(n: int) -> str:
        return f"array_to_string(list_slice(string_split(host, '.'), -{n}, -1), '.')"

    def fits(rule_host: str, path: str) -> str:
        return (f"(host = '{rule_host}' OR ends_with(host, '.{rule_host}')) "
                f"AND starts_with(path, '{path}')")

    rules = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in rules)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in rules)
    low, high = url.WEIGHT_RANGE

    def weight(units: str) -> str:
        spread = "sum((k - n * p) * (k - n * p) / (p * (1 - p)))"
        pairs = "sum(n * (n - 1))"
        return (f"(SELECT least({high}, greatest({low}, coalesce(CASE WHEN {pairs} > 0 THEN CASE WHEN "
                f"({spread} - sum(n)) / {pairs} > 0 THEN 1 / greatest(({spread} - sum(n)) / {pairs}, "
                f"1e-9) - 1 ELSE {high} END END, {low}))) AS w FROM {units})")

    return f"""WITH p AS (
  SELECT page_id, coalesce({host}, '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
named AS (SELECT *, CASE WHEN {last(2)} IN ({long}) THEN {last(3)} ELSE {last(2)} END AS domain,
                 CASE WHEN {last(2)} IN ({long}) THEN {last(2)} ELSE {last(1)} END AS suffix FROM p),
shown AS (SELECT page_id, CAST(nullif(regexp_extract(url, '{PAGE_NUMBER}', 1), '') AS BIGINT) AS doc_id
          FROM pages),
bad AS (SELECT page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
        FROM shown JOIN labels USING (doc_id) GROUP BY page_id),
hosts0 AS (SELECT host, domain, suffix, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS k
           FROM named JOIN bad USING (page_id) GROUP BY ALL),
domains0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts0 GROUP BY ALL),
suffixes0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains0 GROUP BY ALL),
whole AS (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS p FROM suffixes0),
suffixes1 AS (SELECT suffix, n, k, p FROM suffixes0, whole),
suffixes AS (SELECT suffix, (k + w * p) / (n + w) AS p_suffix FROM suffixes1, {weight('suffixes1')}),
domains1 AS (SELECT domain, n, k, p_suffix AS p FROM domains0 JOIN suffixes USING (suffix)),
domains AS (SELECT domain, (k + w * p) / (n + w) AS p_domain FROM domains1, {weight('domains1')}),
hosts1 AS (SELECT host, n, k, p_domain AS p FROM hosts0 JOIN domains USING (domain)),
seen AS (SELECT DISTINCT host, domain, suffix FROM named),
every AS (SELECT seen.host, coalesce(n, 0) AS n, coalesce(k, 0) AS k,
                 coalesce(p_domain, p_suffix, whole.p) AS p, w
          FROM seen LEFT JOIN hosts1 ON seen.host = hosts1.host
          LEFT JOIN domains ON seen.domain = domains.domain
          LEFT JOIN suffixes ON seen.suffix = suffixes.suffix, whole, {weight('hosts1')}),
ab AS (SELECT host, k + w * p AS a, n - k + w * (1 - p) AS b FROM every),
bounds AS (SELECT host, a / (a + b) - {z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound
           FROM ab)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} ELSE CASE WHEN bound > {max_bad} THEN 'block' ELSE 'allow' END END AS verdict
FROM p JOIN bounds USING (host)"""


def _filter_audit() -> str:
    words = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    return rf"""WITH t AS (
  SELECT doc_id, coalesce(CAST(lang AS VARCHAR), '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {words} AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
failed AS (SELECT doc_id, part, concat(
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN first < doc_id THEN 'E' ELSE '' END) AS fails FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
kinds AS (SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
          FROM failed LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c,
             letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, step, substr(o, step, 1) AS f, substr(o, 1, step - 1) AS before
          FROM orders, (SELECT unnest(range(1, 6)) AS step) s),
judged AS (SELECT k.*, o, step, f, contains(fails, f) AS mine,
             before <> '' AND fails <> ''
               AND len(list_intersect(string_split(before, ''), string_split(fails, ''))) > 0 AS gone
           FROM kinds k, steps),
counted AS (SELECT part, o, step, f,
    sum(CASE WHEN NOT gone AND NOT mine THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND mine THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND mine THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND mine THEN n * good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND mine THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, o AS filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""


ORACLE_SQL = {"op7_decontamination": _decontamination(), "op8_near_duplicates": _near_duplicates(),
              "op10_url_reputation": _url_reputation(), "op13_filter_audit": _filter_audit()}
