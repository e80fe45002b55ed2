"""Queries over ``pages``: the WARC writer and the URL filter."""

from __future__ import annotations

from formmart.llm.common import read_table
from formmart.llm.registry import register
from formmart.llm.url_filter import Rule, filter_urls
from formmart.llm.warc import read_records, write_archives

URL_RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
             Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]

_OP9_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
                  CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN k.keeper IS DISTINCT FROM p.page_id AND k.keeper IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.keeper IS DISTINCT FROM p.page_id THEN k.keeper END AS refers_to
FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest AND p.payload_bytes >= 1000
"""

_OP10_SQL = r"""
WITH rules(host, path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
urls AS (SELECT row_number() OVER () AS n, * FROM split),
fits AS (SELECT u.n, r.host || r.path AS rule, r.action,
                row_number() OVER (PARTITION BY u.n ORDER BY length(r.host) DESC, length(r.path) DESC) AS k
         FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM urls u LEFT JOIN fits f ON u.n = f.n AND f.k = 1
"""


@register("op9_warc", _OP9_SQL)
def op9_warc(spark, sf_dir):
    """Archives of all pages are written, then every record is read back through the index."""
    index = write_archives(read_table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return read_records(index, with_payload=False).selectExpr(
        "record_id AS page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op10_url_filter", _OP10_SQL)
def op10_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).drop("url")
