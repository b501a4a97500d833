"""Queries of the operators made of DataFrame functions only, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import licenses, pii, url_filters
from riskframe.llm.registry import query, table

#: The rules in force.
RULES = (
    url_filters.Rule("block", "net", "/"),
    url_filters.Rule("allow", "example.net", "/en/"),
    url_filters.Rule("block", "example.com", "/de/"),
    url_filters.Rule("allow", "org", "/fr/"),
)
#: First labels of reported hosts, after the prefixes that canonical addresses lack.
REPORTED = ("casino-win", "cheap-pills", "free-bets", "spam-farm")

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_HOST_SQL = _LOWER.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")
_REPORTED_SQL = rf"(^|\.)({'|'.join(REPORTED)})\."
_OP10_SQL = f"""
WITH bad AS (SELECT url, html, {_HOST_SQL} AS host FROM pages WHERE regexp_matches({_HOST_SQL}, '{_REPORTED_SQL}')),
links AS (
  SELECT CASE WHEN starts_with(l, '//') THEN 'http:' || l WHEN starts_with(l, '/') THEN 'http://' || host || l
    WHEN contains(l, '://') THEN l END AS url
  FROM (SELECT host, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS l FROM bad)),
urls AS (SELECT page_id, url, TRUE AS judged FROM pages UNION ALL SELECT NULL, url, FALSE FROM links UNION ALL SELECT NULL, url, FALSE FROM bad),
parsed AS (
  SELECT page_id, judged, {_HOST_SQL} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '://[^?#]*\\?([^#]*)', 1), '') AS q
  FROM urls),
addressed AS (
  SELECT *, list_filter(string_split(q, '&'), lambda x: NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|$)')) AS kept FROM parsed),
canonical AS (
  SELECT page_id, judged, host, path, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN ltrim(array_to_string(kept, '&'), '&') <> '' THEN '?' || ltrim(array_to_string(kept, '&'), '&') ELSE '' END END AS address
  FROM addressed),
listed AS (SELECT DISTINCT address FROM canonical WHERE NOT judged AND address IS NOT NULL),
rules(rule, verdict, rhost, rpath) AS (VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
  ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM canonical JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) WHERE judged GROUP BY page_id)
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, CASE WHEN l.address IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT * FROM canonical WHERE judged) c LEFT JOIN fits f USING (page_id) LEFT JOIN listed l ON c.address = l.address
"""


@query("op10_url_filters", _OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: addresses of reported hosts, whatever prefix they have, and all that their pages link to."""
    pages = table(spark, sf_dir, "pages")
    reported = pages.where(url_filters.host(F.col("url")).rlike(rf"(^|\.)({'|'.join(REPORTED)})\."))
    named = reported.select("url").unionByName(url_filters.linked(reported))
    return url_filters.judge(pages, url_filters.listed_urls(named, "url"), RULES)


def _pii_sql() -> str:
    """Pieces between matches and the matches give the places, kind by kind."""
    iban_value = "list_aggregate(list_transform(string_split({0}, ''), lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN (ord(c) - 55)::VARCHAR ELSE c END), 'string_agg', '')"
    moved = iban_value.format("(substr(m, 5) || substr(m, 1, 4))")
    mod = f"list_reduce(list_prepend(0, list_transform(string_split({moved}, ''), lambda d: d::INT)), lambda a, d: (a * 10 + d) % 97) = 1"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda d, i: CASE WHEN i % 2 = 0 THEN d::INT * 2 - CASE WHEN d::INT > 4 THEN 9 ELSE 0 END ELSE d::INT END)) % 10 = 0"
    )
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
        ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR (length(ltrim(p, '0')) = 3 AND ltrim(p, '0') > '255'))) = 0"),
        ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({digits}) BETWEEN 13 AND 19 AND ({luhn})"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 9 AND 15"),
        ("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", f"(s = 0 OR NOT regexp_matches(substr(t, s::BIGINT, 1), '[A-Za-z0-9]')) AND NOT regexp_matches(substr(t, (s + length(m) + 1)::BIGINT, 1), '[A-Za-z0-9]') AND ({mod})"),
        ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "(s = 0 OR NOT regexp_matches(substr(t, s::BIGINT, 1), '[0-9-]')) AND NOT regexp_matches(substr(t, (s + length(m) + 1)::BIGINT, 1), '[0-9-]') AND regexp_matches(substr(t, (greatest(s - 40, 0) + 1)::BIGINT, least(s, 40)::BIGINT), '(?i)(^|[^A-Za-z])(ssn|social security)')"),
    ]
    parts = []
    for order, (kind, pattern, holds) in enumerate(kinds):
        parts.append(
            f"""SELECT rid, {order} AS o, '{kind}' AS kind, s AS s, s + length(m) AS e FROM (
  SELECT rid, t, m, list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT rid, t, found, pieces, unnest(found) AS m, unnest(range(1, len(found) + 1)) AS i
    FROM (SELECT rid, t, regexp_extract_all(t, '{pattern}') AS found, string_split_regex(t, '{pattern}') AS pieces FROM d))) WHERE {holds}"""
        )
    union = "\nUNION ALL ".join(parts)
    counts = ", ".join(f"count(o) FILTER (kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))
    joined = "coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY o, s){0}, '')"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({union})
SELECT any_value(doc_id) AS doc_id, {counts}, sha256({joined.format(" FILTER (o < 4)")}) AS base_sha256, {joined.format("")} AS spans
FROM d LEFT JOIN found USING (rid) GROUP BY rid"""


@query("op6_pii", _pii_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    notices = ", ".join(f"('{label}', '{notice}')" for label, notice in licenses.NOTICES.items())
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in licenses.PHRASES.items())
    fold = _LOWER.format("coalesce(text, '')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {fold} AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
phrases(phrase, label) AS (VALUES {phrases}),
places AS (
  SELECT rid, label, i FROM (SELECT rid, ws, unnest(range(0, len(ws))) AS i FROM w WHERE list_contains(ws, 'license')), phrases
  WHERE ws[i + 1:i + len(string_split(phrase, ' '))] = string_split(phrase, ' ')),
base AS (SELECT rid, count(*) AS n, min(i) AS f, max(i) AS l, list(DISTINCT label) AS labels FROM places GROUP BY rid),
notices(label, notice) AS (VALUES {notices}),
sets AS (SELECT label, list_distinct(regexp_extract_all(lower(notice), '{_WORD}')) AS ts FROM notices),
sized AS (SELECT label, unnest(ts) AS word, len(ts) AS n, floor(len(regexp_extract_all(lower(notice), '{_WORD}')) / {licenses.THRESHOLD}::DOUBLE + 1e-9) AS length
  FROM notices JOIN sets USING (label)),
tokens AS (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
mine AS (SELECT rid, label, n, length, word, i FROM tokens JOIN sized USING (word)),
enough AS (SELECT rid, label FROM mine GROUP BY rid, label HAVING count(DISTINCT word) >= ceil({licenses.THRESHOLD} * any_value(n) - 1e-9)),
here AS (SELECT * FROM mine SEMI JOIN enough USING (rid, label)),
runs AS (
  SELECT a.rid, a.label, a.i, a.n, count(DISTINCT b.word) AS k
  FROM here a JOIN here b ON a.rid = b.rid AND a.label = b.label AND b.i >= a.i AND b.i < a.i + a.length GROUP BY ALL),
hits AS (SELECT rid, label, max(k / n::DOUBLE) AS score FROM runs WHERE k >= ceil({licenses.THRESHOLD} * n - 1e-9) GROUP BY rid, label),
best AS (SELECT rid, list(DISTINCT label) AS labels, max(score) AS score FROM hits GROUP BY rid)
SELECT d.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(b.n, 0) AS n_base, b.f AS first_word, b.l AS last_word,
  array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(x.labels, [])))), ',') AS labels,
  coalesce(x.score, 0.0)::DOUBLE AS score
FROM d JOIN w USING (rid) LEFT JOIN base b USING (rid) LEFT JOIN best x USING (rid)"""


@query("op5_license_scan", _license_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))
