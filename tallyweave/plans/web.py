"""Queries over captured pages: URL forms, link discovery, matching and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions import classify as C
from tallyweave.functions import html as H
from tallyweave.functions import ids
from tallyweave.functions import urls as U
from tallyweave.operators import catalog as K
from tallyweave.operators import links as L
from tallyweave.plans.registry import query
from tallyweave.plans.views import CP_SQL, captured_pages, table
from tallyweave.session import write_once


@query("canonical_urls", r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''),
         '\?utm_source=feed$', ''), '\?$', '') AS normalized,
       regexp_replace(url, '#.*$', '') AS canonical, regexp_replace(url, '#.*$', '') AS safe,
       NOT regexp_matches(url, '[?&](ref|utm_source)=') AS publishable
FROM pages
""")
def canonical_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = U.safe_urls(U.normalize_urls(pages, "url", "normalized"), "url", "safe")
    return out.select("page_id", "normalized", U.canonical_url(F.col("url")).alias("canonical"),
                      "safe", U.publishable(F.col("url")).alias("publishable"))


@query("text_urls", r"""
WITH t AS (SELECT page_id, 'See ' || url || ', then (' || url || '). https://votes.p' || page_id
    || '.example.gov/r.csv; ' || coalesce(html, '') AS text FROM pages),
m AS (SELECT page_id, regexp_extract_all(text, 'https?://[^\s"''<>)]+') AS us FROM t),
e AS (SELECT page_id, unnest(us) AS u, generate_subscripts(us, 1) AS k FROM m),
d AS (SELECT page_id, regexp_replace(u, '[.,;:]+$', '') AS lead_url, min(k) AS k FROM e GROUP BY ALL)
SELECT page_id, 'page-' || page_id || ':' || row_number() OVER (PARTITION BY page_id ORDER BY k)
    AS source_record_id, lead_url,
  CASE WHEN regexp_matches(lead_url, '(?i)^https?://([^/?#]*\.)?gov([:/?#]|$)')
    THEN 'likely_official' ELSE 'unknown' END AS official_status
FROM d
""")
def text_urls(spark, sf_dir):
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("page-"), F.col("page_id")).alias("page"),
        F.concat(F.lit("See "), url, F.lit(", then ("), url, F.lit("). https://votes.p"),
                 F.col("page_id"), F.lit(".example.gov/r.csv; "),
                 F.coalesce("html", F.lit(""))).alias("text"))
    return L.text_urls(pages, "text", "page").select(
        "page_id", "source_record_id", "lead_url", "official_status")


@query("relative_urls", r"""
WITH a AS (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS root,
             unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href FROM pages)
SELECT page_id, href, root || href AS normalized, count(*) AS n FROM a GROUP BY ALL
""")
def relative_urls(spark, sf_dir):
    rows = L.anchors(table(spark, sf_dir, "pages"))
    out = U.normalize_urls(rows, "href", "normalized", "url")
    return out.groupBy("page_id", "href", "normalized").agg(F.count(F.lit(1)).alias("n"))


@query("url_context", r"""
WITH u AS (SELECT o_orderkey, 'https://e.example.org/' || CASE WHEN o_orderstatus = 'P'
    THEN 'archive/' ELSE '' END || CAST(year(o_orderdate) AS VARCHAR) || '/r'
    || CAST(o_orderkey % 30 + 1990 AS VARCHAR) || CASE o_orderstatus WHEN 'F' THEN '.PDF'
    WHEN 'O' THEN '.xlsx' ELSE '.bin' END AS url, year(o_orderdate) AS y, o_orderstatus,
    o_orderkey % 30 + 1990 AS y2 FROM orders),
v AS (SELECT *, list_sort(list_distinct(list_filter([y, y2], lambda x: x >= 2000))) AS ys FROM u)
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR (len(ys) > 0 AND list_max(ys) < 2001)
    THEN 'historical' WHEN ys = [2001] THEN 'current_year_candidate'
    WHEN len(ys) > 0 THEN 'mixed_or_other_years' ELSE 'unknown' END AS election_context,
  array_to_string(ys, ' | ') AS election_year_clues,
  CASE o_orderstatus WHEN 'F' THEN 'pdf' WHEN 'O' THEN 'spreadsheet' ELSE 'unknown' END
    AS source_format
FROM v
""")
def url_context(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    url = F.concat(
        F.lit("https://e.example.org/"),
        F.when(F.col("o_orderstatus") == "P", "archive/").otherwise(""),
        F.year("o_orderdate").cast("string"), F.lit("/r"),
        (F.col("o_orderkey") % 30 + 1990).cast("string"),
        F.when(F.col("o_orderstatus") == "F", ".PDF").when(F.col("o_orderstatus") == "O", ".xlsx")
        .otherwise(".bin"))
    out = U.source_context(o.withColumn("url", url), "url", election_year=2001)
    return out.select("o_orderkey", "election_context", "election_year_clues", "source_format")


@query("redact_emails", r"""
SELECT doc_id, sha256(regexp_replace(trim(regexp_replace(text,
  '[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+',
  ' ', 'g'), ' '), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[email omitted]', 'g')) AS label_hash
FROM documents
""")
def redact_emails(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.sha2(U.clean_label(F.col("text")), 256).alias("label_hash"))


_PAGE_RULES = [
    L.Rule("blog-host", "blog", "result_platform", "host", r"^blog\.", 60),
    L.Rule("mobile-host", "mobile", "authority_discovery", "host", r"^m\.", 0),
    L.Rule("th-path", "path", "report_family", "path", r"^/th", 30),
    L.Rule("label-word", "word", "report_family", "text", r"\bthe\b", 90),
]


_FOUND_SQL = r"""
p AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '\?utm_source=feed$', ''), '\?$', '') AS url,
        regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^(https?://[^/]+)', 1) AS root, html FROM pages),
a AS (SELECT page_id, host, root || h AS u, h AS path, lb
      FROM (SELECT page_id, host, root, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS h,
                   unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS lb FROM p)
  UNION ALL SELECT page_id, host, url, substr(url, length(root) + 1),
      regexp_replace(html, '(?is)<!--.*?-->|<(?:script|style|template)\b[^>]*>.*?</(?:script|style|template)\s*>|<[^>]*>', ' ', 'g') FROM p),
f AS (SELECT page_id, u, CASE WHEN host LIKE 'blog.%' THEN 60 END AS w1,
        CASE WHEN host LIKE 'm.%' THEN 0 END AS w2,
        CASE WHEN regexp_matches(path, '(?i)^/th') THEN 30 END AS w3,
        CASE WHEN regexp_matches(lb, '(?i)\bthe\b') THEN 90 END AS w4,
        CASE WHEN regexp_matches(lb, '(?i)\bof\b') THEN 10 END AS w5,
        regexp_matches(u || ' ' || lb, '(?i)an') AS kw FROM a)
"""


@query("discover_links", f"""
WITH {_FOUND_SQL}
SELECT page_id, u AS candidate_url,
  max(least(100, greatest(coalesce(w1, 0), coalesce(w2, 0), coalesce(w3, 0), coalesce(w4, 0))
      + CASE WHEN kw THEN 20 ELSE 0 END)) AS score,
  concat_ws('|', CASE WHEN count(w1) > 0 THEN 'blog-host' END, CASE WHEN count(w4) > 0 THEN 'label-word' END,
     CASE WHEN count(w2) > 0 THEN 'mobile-host' END, CASE WHEN count(w3) > 0 THEN 'th-path' END) AS signatures
FROM f WHERE w1 IS NOT NULL OR w2 IS NOT NULL OR w3 IS NOT NULL OR w4 IS NOT NULL OR kw
GROUP BY ALL
""")
def discover_links(spark, sf_dir):
    out = L.discover(table(spark, sf_dir, "pages"), rules=_PAGE_RULES, keyword="(?i)an")
    return out.select("page_id", "candidate_url", "score",
                      F.array_join("signatures", "|").alias("signatures"))


#: The rules of an earlier discovery: one was lighter, one is gone since, one had not come yet.
_EARLIER_RULES = [
    L.Rule("blog-host", "blog", "result_platform", "host", r"^blog\.", 50), _PAGE_RULES[1],
    _PAGE_RULES[3], L.Rule("of-word", "word", "report_family", "text", r"\bof\b", 10)]


@query("replay_discovery", f"""
WITH {_FOUND_SQL},
n AS (SELECT page_id, u, max(least(100, greatest(coalesce(w1, 0), coalesce(w2, 0), coalesce(w3, 0), coalesce(w4, 0)) + CASE WHEN kw THEN 20 ELSE 0 END)) AS score,
    count(w3) > 0 AS th FROM f WHERE w1 IS NOT NULL OR w2 IS NOT NULL OR w3 IS NOT NULL OR w4 IS NOT NULL OR kw GROUP BY ALL),
o AS (SELECT page_id, u, max(least(100, greatest(coalesce(w1 - 10, 0), coalesce(w2, 0), coalesce(w5, 0), coalesce(w4, 0)) + CASE WHEN kw THEN 20 ELSE 0 END)) AS score,
    count(w5) > 0 AS word FROM f WHERE w1 IS NOT NULL OR w2 IS NOT NULL OR w5 IS NOT NULL OR w4 IS NOT NULL OR kw GROUP BY ALL)
SELECT page_id, u AS candidate_url, CASE WHEN o.score IS NULL THEN 'added' WHEN n.score IS NULL THEN 'removed' ELSE 'changed' END AS change,
  o.score AS stored_score, n.score AS score, CASE WHEN o.score IS NOT NULL THEN true END AS rules_changed
FROM n FULL JOIN o USING (page_id, u) WHERE page_id % 5 > 0 AND (o.score IS NULL OR n.score IS NULL OR o.score <> n.score OR th OR word)
UNION ALL SELECT page_id, NULL, 'refused_digest', NULL, NULL, NULL FROM pages WHERE page_id % 5 = 0
""")
def replay_discovery(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    digest = F.when(F.col("page_id") % 5 == 0, "0").otherwise(F.sha2("html", 256))
    # A page's number names its capture; addresses repeat.
    own = F.concat(F.col("url"), F.when(F.col("url").contains("#"), "").otherwise("#"), F.lit("@"),
                   F.col("page_id"))
    pages = pages.select(own.alias("url"), "html", digest.alias("snapshot_sha256"))
    stored = K.discovered(pages, _EARLIER_RULES, "(?i)an")
    out = K.replay_discovery(pages, stored, _PAGE_RULES, "(?i)an")
    return out.select(F.regexp_extract("url", r"@(\d+)$", 1).cast("long").alias("page_id"),
                      "candidate_url", "change", "stored_score", "score", "rules_changed")


@query("result_candidates", f"""
WITH {CP_SQL},
t AS (SELECT DISTINCT page_id, url, link, label, href,
        CASE l_returnflag WHEN 'A' THEN 15 WHEN 'N' THEN 10 ELSE 0 END AS w,
        l_linestatus = 'O' AS kw FROM cpl),
g AS (SELECT page_id, url, link AS candidate_url, max(w + CASE WHEN kw THEN 20 ELSE 0 END) AS score,
        CASE max(w) WHEN 15 THEN 'tabular-artifact' WHEN 10 THEN 'pdf-artifact' ELSE '' END AS signatures,
        count(*) AS evidence FROM t WHERE w > 0 OR kw GROUP BY ALL)
SELECT page_id, candidate_url, score, signatures, evidence FROM g
UNION ALL
SELECT page_id, url, 20, '', 1 FROM (SELECT page_id, url, bool_or(l_linestatus = 'O' OR o_orderstatus = 'F') AS kw
  FROM cpl GROUP BY ALL) WHERE kw
""")
def result_candidates(spark, sf_dir):
    out = L.discover(captured_pages(spark, sf_dir).drop("o_orderdate"))
    return out.select("page_id", "candidate_url", "score",
                      F.array_join("signatures", "|").alias("signatures"),
                      F.size("provenance").cast("long").alias("evidence"))


@query("public_candidates", f"""
WITH {CP_SQL},
t AS (SELECT page_id, link, label, CASE l_returnflag WHEN 'N' THEN 10 ELSE 0 END AS w,
        l_linestatus = 'O' AS kw FROM cpl WHERE l_returnflag <> 'A')
SELECT page_id, link AS candidate_url, max(w + CASE WHEN kw THEN 20 ELSE 0 END) AS score
FROM t WHERE w > 0 OR kw GROUP BY ALL
UNION ALL
SELECT page_id, url, 20 FROM (SELECT page_id, url, bool_or(l_linestatus = 'O' OR o_orderstatus = 'F') AS kw
  FROM cpl GROUP BY ALL) WHERE kw
""")
def public_candidates(spark, sf_dir):
    found = L.discover(captured_pages(spark, sf_dir).drop("o_orderdate"))
    return L.clean_candidates(found).select("page_id", "candidate_url", "score")


@query("label_matches", r"""
WITH x AS (SELECT unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS s, NULL AS page_id FROM pages
  UNION ALL SELECT regexp_extract(html, '<title>([^<]*)</title>', 1), page_id FROM pages),
w AS (SELECT page_id, trim(regexp_replace(lower(array_to_string([CASE WHEN strip_accents(c) <> c
        THEN strip_accents(c) || ' ' ELSE c END FOR c IN string_split(replace(s, 'ß', 'ss'), '')], '')), '[^a-z0-9]+', ' ', 'g')) AS f FROM x),
n AS (SELECT DISTINCT f FROM w WHERE page_id IS NULL AND f <> ''),
m AS (SELECT page_id, n.f FROM w t JOIN n ON contains(' ' || t.f || ' ', ' ' || n.f || ' ') WHERE page_id IS NOT NULL)
SELECT m.page_id, m.f AS unit_id FROM m
WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.page_id = m.page_id AND o.f <> m.f
                  AND contains(' ' || o.f || ' ', ' ' || m.f || ' '))
""")
def label_matches(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    names = L.anchors(pages).select(F.col("label").alias("canonical_name")).distinct()
    names = names.withColumn("id", ids.words(F.col("canonical_name"))).filter("id <> ''")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    titles = pages.select("page_id", title.alias("title"))
    return L.label_matches(titles, ["page_id"], "title", names, "id", level=None)


@query("result_links", f"""
WITH {CP_SQL}
SELECT page_id, link, arg_max(label, l_linenumber) AS label FROM cpl
WHERE l_linestatus = 'F' GROUP BY ALL
UNION ALL
SELECT page_id, link, label FROM cpl WHERE false
""")
def result_links(spark, sf_dir):
    pages = captured_pages(spark, sf_dir).select("page_id", "url", "html")
    out = L.result_links(pages, terms=r"(?i)\bofficial results?\b")
    return out.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("page_id"),
                      F.regexp_replace("link", r"\?utm_source=x$", "").alias("link"), "label")


@query("link_scores", f"""
WITH {CP_SQL}
SELECT DISTINCT page_id, link,
  CASE l_returnflag WHEN 'A' THEN 3.0 WHEN 'N' THEN 3.0 ELSE 1.0 END::DOUBLE AS score FROM cpl
""")
def link_scores(spark, sf_dir):
    pages = captured_pages(spark, sf_dir).select("page_id", "url", "html")
    out = L.scored_links(pages)
    return out.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("page_id"),
                      F.regexp_replace("link", r"\?utm_source=x$", "").alias("link"), "score")


_VARIANTS = ["vendor", "download", "cms", "archive", "document", "report", "dynamic"]


@query("artifact_links", f"""
WITH {CP_SQL},
r AS (SELECT l_returnflag AS f, l_linestatus AS s, count(DISTINCT (page_id, link)) AS n FROM cpl GROUP BY ALL),
d AS (SELECT page_id, link, l_returnflag AS f, bool_or(l_linestatus = 'O') AS o,
        bool_or(l_linestatus = 'F') AS x, arg_max(l_linestatus, l_linenumber) AS last
      FROM cpl GROUP BY ALL)
SELECT 'vendor' AS variant, 'csv' AS kind, count(*) AS links FROM d WHERE f = 'A'
UNION ALL SELECT 'download', 'csv', count(*) FROM d WHERE f = 'A'
UNION ALL SELECT 'cms', CASE f WHEN 'A' THEN 'structured_download' WHEN 'N' THEN 'document' ELSE 'web' END,
  count(*) FROM d WHERE true GROUP BY ALL
UNION ALL SELECT 'archive', CASE f WHEN 'A' THEN 'csv' WHEN 'N' THEN 'pdf' ELSE 'web' END, count(*)
  FROM d GROUP BY ALL
UNION ALL SELECT 'document', 'csv', count(*) FROM d WHERE f = 'A'
UNION ALL SELECT 'document', 'pdf', count(*) FROM d WHERE f = 'N'
UNION ALL SELECT 'report', 'cumulative', count(*) FROM d WHERE x
""")
def artifact_links(spark, sf_dir):
    pages = captured_pages(spark, sf_dir).select("url", "html")
    rows = write_once(L.anchors(pages))
    return L.artifact_kinds(rows, _VARIANTS).groupBy("variant", "kind").agg(
        F.count(F.lit(1)).alias("links"))


@query("surface_fingerprints", f"""
WITH {CP_SQL},
a AS (SELECT page_id, count(DISTINCT href) FILTER (l_returnflag = 'A') AS n FROM cpl GROUP BY ALL)
SELECT page_id, CASE WHEN n > 0 THEN 'structured_web' ELSE 'unknown_web' END AS family,
       CASE WHEN n > 0 THEN 'medium' ELSE 'low' END AS confidence,
       concat_ws('|', CASE WHEN n > 0 THEN 'download_artifacts:' || CAST(n AS VARCHAR) END,
                 'official_host') AS evidence, n AS artifacts
FROM a
""")
def surface_fingerprints(spark, sf_dir):
    out = L.surface_fingerprint(captured_pages(spark, sf_dir).select("page_id", "url", "html"))
    return out.select("page_id", "family", "confidence",
                      F.array_join("evidence", "|").alias("evidence"),
                      F.size("discovered_artifacts").cast("long").alias("artifacts"))


@query("page_states", f"""
WITH {CP_SQL},
p AS (SELECT DISTINCT page_id, o_orderstatus, title, 'NATION_' || CAST(page_id % 25 AS VARCHAR) AS name
      FROM cpl),
m AS (SELECT page_id, bool_or(l_linestatus = 'O') AS canvass, list(s_nationkey) AS ns FROM cpl GROUP BY ALL)
SELECT page_id, CASE o_orderstatus WHEN 'O' THEN 'blocked_html' ELSE 'html_content' END AS access_state,
  CASE WHEN (canvass OR o_orderstatus = 'F') AND list_contains(ns, page_id % 25) AND o_orderstatus <> 'O'
    AND title = 'Election Results' THEN 'context_supported' ELSE 'fetched_unverified' END AS assessment
FROM p JOIN m USING (page_id)
""")
def page_states(spark, sf_dir):
    pages = captured_pages(spark, sf_dir).select("page_id", "html")
    read = pages.select("page_id", "html", H.first_element_text(F.col("html"), "title")
                        .alias("title"), H.text_of(F.col("html")).alias("text"))
    name = F.concat(F.lit("NATION_"), (F.col("page_id") % 25).cast("string"))
    return read.select(
        "page_id", C.access_state(F.col("html"), F.col("title"), F.col("text"))
        .alias("access_state"),
        C.context_assessment(F.col("text"), name, F.lit("election results"), U.RESULT_PATTERN)
        .alias("assessment"))


@query("directory_links", f"""
WITH {CP_SQL},
n2 AS (SELECT n_nationkey, 'S' || CAST(n_regionkey AS VARCHAR) AS st FROM nation),
a AS (SELECT DISTINCT page_id, url, state, link, label, s_nationkey, l_returnflag,
             l_linestatus, 'us:nation:' || CAST(s_nationkey AS VARCHAR) AS id, n2.st = state AS named
      FROM cpl JOIN n2 ON n_nationkey = s_nationkey WHERE title <> 'Access Denied'),
k AS (SELECT page_id, state, link AS url, CASE WHEN named THEN id ELSE '' END AS ids,
        CASE WHEN l_returnflag IN ('A', 'N') THEN 'artifact_lead' WHEN named THEN 'unit_label_candidate'
             ELSE 'unmatched_directory_link' END AS match_status
      FROM a
      WHERE named OR (l_returnflag = 'N') OR (l_returnflag = 'R'))
SELECT DISTINCT * FROM k
""")
def directory_links(spark, sf_dir):
    pages = captured_pages(spark, sf_dir).select("url", "state", "html")
    units = _nation_units(spark, sf_dir)
    out = L.directory_links(pages, units)
    return out.select(
        F.regexp_extract("observed_from", r"(\d+)$", 1).cast("long").alias("page_id"), "state",
        "url", F.array_join("associated_unit_ids", "|").alias("ids"), "match_status")


def _line_pages(spark, sf_dir, line, before, after):
    """One page per order from its lines; an order has at most a handful."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"),
        (F.col("l_suppkey") % 25).alias("nation"), F.col("l_returnflag").alias("flag"))
    rows = li.withColumn("ref", F.concat_ws("-", "k", "n")).select("k", "n", line.alias("x"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "x"))),
                                    lambda e: e.x), "")
    pages = rows.groupBy("k").agg(text.alias("t"))
    return pages.select("k", F.concat(F.lit("https://d.example.org/"), F.col("k")).alias("url"),
                        F.concat(before, F.col("t"), after).alias("html"))


@query("nested_directory_links", """
WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n, l_suppkey % 25 AS nation FROM lineitem)
SELECT k, '/board/' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS path, '' AS ids, 'authority_keyword' AS match_basis FROM l
UNION SELECT k, '/out/' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR), 'us:nation:' || CAST(nation AS VARCHAR), 'directory_row'
FROM l JOIN nation ON n_nationkey = nation WHERE n_regionkey = k % 5
UNION SELECT k, '/last/' || CAST(k AS VARCHAR), 'us:nation:' || CAST(n_nationkey AS VARCHAR), 'details_summary'
FROM (SELECT DISTINCT k FROM l) JOIN nation ON n_nationkey = k % 25 WHERE n_regionkey = k % 5
""")
def nested_directory_links(spark, sf_dir):
    # The inner item's link lies in no item that names a unit; the outer one's does, after the inner
    # list's end tag. Paragraphs stay open, as do the items of the second list.
    line = F.concat(F.lit("<li>NATION_"), F.col("nation"), F.lit(' <ul><li><a href="/board/'),
                    F.col("ref"), F.lit('">Go</a></ul><p><a href="/out/'), F.col("ref"),
                    F.lit('">Go</a></li>'))
    pages = _line_pages(
        spark, sf_dir, line, F.lit("<title>Units</title><ul>"),
        F.concat(F.lit("</ul><details><summary>NATION_"), F.col("k") % 25, F.lit(
            "</summary><details><summary>x</summary></details><ul></ul></li><b><a href='/last/"),
            F.col("k"), F.lit("'>Go</a></b></details>")))
    pages = pages.withColumn("state", F.concat(F.lit("S"), F.col("k") % 5))
    out = L.directory_links(pages, _nation_units(spark, sf_dir))
    return out.select(
        F.regexp_extract("observed_from", r"(\d+)$", 1).cast("long").alias("k"),
        U.path(F.col("url")).alias("path"),
        F.array_join("associated_unit_ids", "|").alias("ids"), "match_basis")


@query("hidden_candidates", """
WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n, l_suppkey % 25 AS nation, l_returnflag AS flag FROM lineitem),
c AS (SELECT k, '/in/' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS path, 'row_context' AS bases FROM l
      WHERE k % 3 = 2 OR (k % 3 = 0 AND flag = 'A') OR (k % 3 = 1 AND flag = 'N')
  UNION ALL SELECT k, '/data/' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR), 'data_attribute' FROM l WHERE flag = 'R'
  UNION ALL SELECT DISTINCT k, '/both/' || CAST(k AS VARCHAR), 'row_context|script' FROM l)
SELECT DISTINCT k, path, bases FROM c
""")
def hidden_candidates(spark, sf_dir):
    # The word of a unit stands in the nearest division or article of a link, or only further out.
    word = F.when(F.col("flag") == "A", "Parish").when(F.col("flag") == "N", "County").otherwise("x")
    line = F.concat(
        F.lit("<section>Parish County<div><article>"), word,
        F.lit("<p>a<div>y</div> <a class=b HREF='/in/"), F.col("ref"), F.lit("'>z</a></article></div>"),
        F.when(F.col("flag") == "R", F.concat(F.lit("<i data-Website-x = /data/"), F.col("ref"),
                                              F.lit(" title='>'>"))).otherwise(""),
        F.lit("</section>"))
    both = F.concat(F.lit("https://d.example.org/both/"), F.col("k"))
    pages = _line_pages(spark, sf_dir, line, F.lit("<title>u</title>"), F.concat(
        F.lit('<script>var a="'), both, F.lit('\\", b="https://www.facebook.com/x";</script>'
                                              '<td>county parish <a href="'), both,
        F.lit('">county parish</a>')))
    states = F.element_at(F.array(F.lit("LA"), F.lit("MN"), F.lit("ZZ")),
                          (F.col("k") % 3 + 1).cast("int"))
    out = L.hidden_candidates(pages.withColumn("state", states), F.col("state"))
    return out.select("k", U.path(F.col("candidate_url")).alias("path"),
                      F.array_join("bases", "|").alias("bases"))


def _nation_units(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("us:nation:"), F.col("n_nationkey")).alias("jurisdiction_id"),
        F.concat(F.lit("S"), F.col("n_regionkey")).alias("state"),
        F.col("n_name").alias("canonical_name"), F.lit("county").alias("jurisdiction_level"))


@query("slug_tokens", r"""
SELECT doc_id, trim(regexp_replace(lower(regexp_replace(strip_accents(w), '[^\x00-\x7F]+', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-') AS token,
       trim(regexp_replace(lower(trim(w)), '[^a-z0-9]+', '-', 'g'), '-') AS alias_token,
       trim(regexp_replace(lower(w), '[^a-z0-9]+', ' ', 'g')) AS label
FROM (SELECT doc_id, text AS w FROM documents)
""")
def slug_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    return docs.select("doc_id", ids.token(text).alias("token"),
                       ids.alias_token(text).alias("alias_token"),
                       ids.mode_label(text).alias("label"))
