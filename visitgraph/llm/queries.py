"""The corpus operators' queries by name, and their SQL where SQL can say the same."""

from __future__ import annotations

from visitgraph.llm.fingerprints import op5_fingerprints
from visitgraph.llm.media import op8_media
from visitgraph.llm.minhash import op9_minhash
from visitgraph.llm.mixing import op6_mixing
from visitgraph.llm.packing import op7_packing
from visitgraph.llm.phrases import OP12, op12_phrases
from visitgraph.llm.pieces import op13_pieces
from visitgraph.llm.pii import op1_pii
from visitgraph.llm.quality import op3_quality
from visitgraph.llm.repair import op11_repair
from visitgraph.llm.secrets import op4_secrets
from visitgraph.llm.toxicity import op10_toxicity
from visitgraph.llm.urls import op2_urls

QUERIES = {
    "op1_pii": op1_pii,
    "op2_urls": op2_urls,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_fingerprints": op5_fingerprints,
    "op6_mixing": op6_mixing,
    "op7_packing": op7_packing,
    "op8_media": op8_media,
    "op9_minhash": op9_minhash,
    "op10_toxicity": op10_toxicity,
    "op11_repair": op11_repair,
    "op12_phrases": op12_phrases,
    "op13_pieces": op13_pieces,
}

#: Link edges by tags and their attributes, reachability by recursion; rules and precedence as CASE.
OP2 = r"""
WITH RECURSIVE p AS (
 SELECT page_id, coalesce(html, '') AS html,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest FROM pages),
q AS (SELECT page_id, html, host, path, CASE WHEN host <> '' THEN host || CASE WHEN rest = '' THEN '/' ELSE rest END END AS node FROM p),
tag AS (SELECT node, host, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS m FROM q WHERE node IS NOT NULL),
attrs AS (SELECT node, host, path, m,
 trim(replace(regexp_extract(m, '(?is)[\s"''/]rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 1) || regexp_extract(m, '(?is)[\s"''/]rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 2) || regexp_extract(m, '(?is)[\s"''/]rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 3), '&amp;', '&')) AS rel,
 trim(replace(regexp_extract(m, '(?is)[\s"''/]href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 1) || regexp_extract(m, '(?is)[\s"''/]href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 2) || regexp_extract(m, '(?is)[\s"''/]href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 3), '&amp;', '&')) AS href,
 trim(replace(regexp_extract(m, '(?is)[\s"''/]http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 1) || regexp_extract(m, '(?is)[\s"''/]http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 2) || regexp_extract(m, '(?is)[\s"''/]http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 3), '&amp;', '&')) AS equiv,
 trim(replace(regexp_extract(m, '(?is)[\s"''/]content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 1) || regexp_extract(m, '(?is)[\s"''/]content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 2) || regexp_extract(m, '(?is)[\s"''/]content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 3), '&amp;', '&')) AS content FROM tag),
t AS (SELECT node, host, path,
 CASE WHEN regexp_matches(m, '(?is)^<link\b') AND regexp_matches(lower(rel), '(?s)(^|\s)canonical(\s|$)') THEN href
  WHEN regexp_matches(m, '(?is)^<meta\b') AND lower(equiv) = 'refresh' THEN regexp_replace(regexp_extract(content, '(?is)\burl\s*=\s*(.+)$', 1), '^["''\s]+|["''\s]+$', '', 'g') ELSE '' END AS t FROM attrs),
way AS (SELECT node, host, t, string_split(CASE WHEN starts_with(t, '/') THEN '' WHEN starts_with(t, '?') OR starts_with(t, '#') THEN path
  ELSE coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') END || regexp_extract(t, '(?s)^([^?#]*)', 1), '/') AS w FROM t WHERE t <> ''),
folded AS (SELECT node, host, t, array_to_string(list_reduce(list_transform(w, lambda x: [x]),
  lambda acc, x: CASE WHEN x[1] = '..' THEN acc[1:greatest(len(acc) - 1, 1)] WHEN x[1] = '.' THEN acc ELSE list_concat(acc, x) END), '/') AS f FROM way),
u AS (SELECT node AS a, CASE WHEN regexp_matches(t, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN 'x:' || t
  WHEN NOT regexp_matches(t, '(?s)^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'x://' || host || f || regexp_extract(t, '(?s)^[^?#]*(\?[^#]*)', 1) END AS t FROM folded),
v AS (SELECT a, translate(regexp_extract(t, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h, regexp_extract(t, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS r FROM u),
e AS (SELECT DISTINCT a, h || CASE WHEN r = '' THEN '/' ELSE r END AS b FROM v WHERE h <> ''),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a, b FROM s UNION SELECT r.a, s.b FROM reach r JOIN s ON r.b = s.a),
n AS (SELECT DISTINCT b AS node, regexp_extract(b, '(?s)^([^/?]*)', 1) AS host, regexp_extract(b, '(?s)^[^/?]*([^?]*)', 1) AS path FROM reach),
j AS (
 SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
 FROM (SELECT node, host, path, NULL AS page_id FROM n UNION ALL SELECT node, host, path, page_id FROM q)),
k AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS own FROM j),
said AS (
 SELECT r.a AS node, CASE WHEN bool_or(k.own = 'allow') THEN 'allow' WHEN bool_or(k.own = 'block') THEN 'block' END AS said
 FROM reach r JOIN (SELECT * FROM k WHERE page_id IS NULL) k ON k.node = r.b GROUP BY r.a)
SELECT k.page_id, k.host, k.path, k.rule, coalesce(k.own, said.said, 'allow') AS verdict FROM k LEFT JOIN said ON said.node = k.node WHERE k.page_id IS NOT NULL
"""

ORACLES = {"op2_urls": OP2, "op12_phrases": OP12}
