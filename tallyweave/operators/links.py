"""Link discovery on captured pages: a page table goes in, candidate rows come out."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import classify as C
from tallyweave.functions import html as H
from tallyweave.functions import urls as U
from tallyweave.functions.ids import words
from tallyweave.functions.nesting import TAG, inner_html, numbered, with_anchors, with_elements
from tallyweave.session import bind, write_once


@dataclass(frozen=True)
class Rule:
    """A fingerprint: where to look, what to find, and how much it weighs."""

    id: str
    family: str
    role: str
    field: str
    pattern: str
    weight: int


ROLES = ["result_platform", "authority_discovery", "report_family"]
RULE_FIELDS = ["host", "path", "url", "text", "html"]

# The shipped fingerprint catalog.
CATALOG = [
    Rule("clarity-host", "clarity", "result_platform", "host", r"(^|\.)clarityelections\.com$", 80),
    Rule("enhanced-public", "enhanced_voting", "result_platform", "url",
         r"^https?://app\.enhancedvoting\.com/results/public/", 85),
    Rule("enhanced-host", "enhanced_voting", "result_platform", "host",
         r"^app\.enhancedvoting\.com$", 55),
    Rule("scytl-brand", "scytl", "result_platform", "text", r"\bscytl\b", 35),
    Rule("civicplus-brand", "civicplus", "authority_discovery", "text",
         r"\bcivicplus\b|\bcivicengage\b", 0),
    Rule("electionware-report", "electionware", "report_family", "text", r"\belectionware\b", 20),
    Rule("pdf-artifact", "pdf", "report_family", "path", r"\.pdf$", 10),
    Rule("tabular-artifact", "tabular_download", "report_family", "path",
         r"\.(csv|xlsx?|xml|json|zip)$", 15),
    Rule("enhanced-government-hosts", "enhanced_voting", "result_platform", "host",
         r"^(results\.sos\.ga\.gov|electionresults\.utah\.gov|enr\.elections\.virginia\.gov)$", 75),
    Rule("public-results-path", "public_results_app", "result_platform", "path",
         r"^/results/public/[^/]+/(?:elections/)?[^/]+", 60),
    Rule("civicplus-script", "civicplus", "authority_discovery", "html",
         r"<script\b[^>]*src\s*=\s*[\'\"][^\'\"]*(?:civicplus|civicengage)", 0),
    Rule("quest-enr-html", "quest_enr", "result_platform", "html",
         r"(?s)^(?=.*Quest Information Systems)(?=.*Scripts/EnrAngular/)", 70),
]


def load_rules(path: str) -> list[Rule]:
    """Rules from a JSON file with a ``rules`` list, checked before use."""
    with open(path, encoding="utf-8") as stream:
        rows = json.load(stream)["rules"]
    rules = [Rule(*[r[k] for k in ("id", "family", "role", "field", "pattern", "weight")])
             for r in rows]
    check_rules(rules)
    return rules


def check_rules(rules: list[Rule]) -> None:
    if len({r.id for r in rules}) != len(rules):
        raise ValueError("rule ids must be unique")
    for rule in rules:
        if rule.role not in ROLES or rule.field not in RULE_FIELDS:
            raise ValueError(f"rule {rule.id} has an unknown role or field")
        if not 0 <= rule.weight <= 100:
            raise ValueError(f"rule {rule.id} has a weight outside 0..100")
        re.compile(rule.pattern)


def _pieces(name: str, kind: str, source: Column) -> Column:
    """Tags of a page as (kind, tag, inner) structs."""
    if name in ("a", "script"):
        found = H.elements(source, name)
        inner = lambda t: _inner(name, t)
    else:
        found = H.open_tags(source, name)
        inner = lambda t: F.lit("")
    return F.transform(found, lambda t: F.struct(
        F.lit(kind).alias("kind"), F.regexp_extract(t, r"(?is)^(<[^>]*>)", 1).alias("tag"),
        inner(t).alias("inner")))


def _inner(name: str, element: Column) -> Column:
    return F.regexp_replace(element, rf"(?is)^<{name}\b[^>]*>|</{name}\s*>$", "")


def _embedded(source: Column) -> Column:
    """Targets inside the scripts of a page, as pieces."""
    def inside(script: Column) -> Column:
        return F.concat(
            F.regexp_extract_all(script, F.lit(
                r"(?:location(?:\.href)?\s*=|location\.replace\(|fetch\()\s*[\"']([^\"']+)[\"']"),
                F.lit(1)),
            F.regexp_extract_all(script, F.lit(r"[\"'](https?://[^\"'<>\s]+)[\"']"), F.lit(1)))

    return F.flatten(F.transform(H.elements(source, "script"), lambda t: F.transform(
        inside(_inner("script", t)), lambda u: F.struct(
            F.lit("embedded").alias("kind"), F.lit("").alias("tag"), u.alias("inner")))))


def extract_targets(pages: DataFrame, page_url: str = "url", html: str = "html",
                    requested: str | None = None) -> DataFrame:
    """One row per link target of each page: kind, raw target, label and the page's base.

    Anchors, frames, script sources, canonical links, meta refreshes, targets inside scripts,
    the page itself and a redirect from the requested URL. Exploding needs no shuffle, and each
    page is read once.
    """
    keep = [c for c in pages.columns if c != html]
    base = F.regexp_extract(F.col(html), r"(?is)(<base\b[^>]*>)", 1)
    based = bind(pages, _basehref=F.coalesce(H.attribute(base, "href"), F.lit("")))
    # Only a base element is resolved against the page.
    based = bind(based, _against=F.when(F.col("_basehref") != "", F.col(page_url))
                 .otherwise(F.lit("")))
    based = U.normalize_urls(based, "_basehref", "_base", "_against")
    based = bind(based, resolution_base=F.when(
        (F.col("_basehref") != "") & (F.col("_base") != ""), F.col("_base"))
        .otherwise(F.col(page_url)))

    h = F.col(html)
    whole = F.array(F.struct(F.lit("response").alias("kind"), F.lit("").alias("tag"),
                             h.alias("inner")))
    pieces = [whole, _pieces("a", "link", h), _pieces("iframe", "iframe", h),
              _pieces("script", "script", h), _pieces("link", "canonical", h),
              _pieces("meta", "meta_redirect", h), _embedded(h)]
    if requested is not None:
        pieces.append(F.when(
            F.col(requested).isNotNull() & (F.col(requested) != F.col(page_url)),
            F.array(F.struct(F.lit("redirect").alias("kind"), F.lit("").alias("tag"),
                             F.col(requested).alias("inner")))
        ).otherwise(F.array().cast("array<struct<kind:string,tag:string,inner:string>>")))
    rows = based.select(*keep, "resolution_base", F.inline(F.concat(*pieces)))

    tag, kind = F.col("tag"), F.col("kind")
    refresh = F.regexp_extract(F.coalesce(H.attribute(tag, "content"), F.lit("")),
                               r"(?i)url\s*=\s*['\"]?([^'\"]+)", 1)
    is_canonical = F.lower(F.coalesce(H.attribute(tag, "rel"), F.lit(""))).rlike(
        r"(^|\s)canonical(\s|$)")
    is_refresh = F.lower(F.coalesce(H.attribute(tag, "http-equiv"), F.lit(""))) == "refresh"
    raw = (
        F.when(kind.isin("response", "redirect"), F.col(page_url))
        .when(kind == "link", F.coalesce(H.attribute(tag, "href"), F.lit("")))
        .when(kind == "embedded", F.col("inner"))
        .when(kind.isin("iframe", "script"), H.attribute(tag, "src"))
        .when((kind == "canonical") & is_canonical, H.attribute(tag, "href"))
        .when((kind == "meta_redirect") & is_refresh & (refresh != ""), refresh)
    )
    label = (F.when(kind.isin("response", "link"), H.text_of(F.col("inner")))
             .when(kind == "redirect", F.col("inner")).otherwise(F.lit("")))
    return bind(rows, raw_target=raw, label=label).select(
        *keep, "resolution_base", "kind", "raw_target", "label",
        F.when(kind == "response", F.col("inner")).otherwise(F.lit("")).alias("body")
    ).filter("raw_target is not null and raw_target <> ''")


def rule_matches(rules: list[Rule], host: Column, path: Column, url: Column, text: Column,
                 html: Column) -> Column:
    """Array of (id, role, family, weight) of the rules a target satisfies."""
    fields = {"host": host, "path": path, "url": url, "text": text, "html": html}
    hits = [
        F.when(fields[r.field].rlike("(?i)" + r.pattern), F.struct(
            F.lit(r.id).alias("id"), F.lit(r.role).alias("role"),
            F.lit(r.family).alias("family"), F.lit(r.weight).alias("weight")))
        for r in rules
    ]
    return F.array_compact(F.array(*hits))


def discover(pages: DataFrame, page_url: str = "url", html: str = "html",
             requested: str | None = None, rules: list[Rule] | None = None,
             keyword: str = U.RESULT_PATTERN) -> DataFrame:
    """Result candidates of each page with score, signatures, roles and provenance (L1).

    A target counts when a rule or the keyword matches. Its score is the heaviest rule plus 20
    for the keyword, at most 100. Grouping is by page and URL, so a group is never larger than
    one page.
    """
    rules = CATALOG if rules is None else rules
    check_rules(rules)
    targets = extract_targets(pages, page_url, html, requested)
    targets = U.normalize_urls(targets, "raw_target", "candidate_url", "resolution_base")
    targets = targets.filter("candidate_url <> ''")
    word = F.concat_ws(" ", "candidate_url", "label").rlike(keyword)
    parts = bind(targets, _host=U.host(F.col("candidate_url")),
                 _path=U.path(F.col("candidate_url")), keyword_match=word)
    hit = bind(parts, _rules=rule_matches(rules, F.col("_host"), F.col("_path"), F.col(
        "candidate_url"), F.col("label"), F.col("body"))).filter("size(_rules) > 0 or keyword_match")
    heaviest = F.coalesce(F.array_max(F.transform("_rules", lambda r: r.weight)), F.lit(0))
    score = F.least(F.lit(100), heaviest + F.when(F.col("keyword_match"), 20).otherwise(0))
    keep = [c for c in pages.columns if c not in (html, page_url)]
    provenance = F.struct(
        F.col(page_url).alias("page_url"), "resolution_base", "kind", "raw_target",
        "label", "keyword_match")
    return (
        hit.withColumn("_score", score)
        .groupBy(*keep, page_url, "candidate_url")
        .agg(
            F.max("_score").alias("score"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(
                F.transform("_rules", lambda r: r.id))))).alias("signatures"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(
                F.transform("_rules", lambda r: r.role))))).alias("roles"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(
                F.transform("_rules", lambda r: r.family))))).alias("families"),
            F.array_sort(F.collect_set(provenance)).alias("provenance"),
        )
    )


def clean_candidates(candidates: DataFrame, url: str = "candidate_url") -> DataFrame:
    """Publishable candidates with safe provenance and redacted labels."""
    safe = lambda p: (
        U.publishable(p.page_url) & U.publishable(p.raw_target) & U.publishable(p.resolution_base))
    kept = F.transform(F.filter("provenance", safe), lambda p: p.withField(
        "label", U.clean_label(p.label)))
    return candidates.filter(U.publishable(F.col(url)) & F.exists("provenance", safe)).withColumn(
        "provenance", kept)


def surface_fingerprint(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Family, confidence, evidence and artifacts of each result page (L2)."""
    blob = F.lower(F.concat(F.col(url), F.lit("\n"), F.col(html)))
    family, hits = F.lit(None).cast("string"), F.array().cast("array<string>")
    for name, tokens in reversed(C.SURFACE_SIGNATURES):
        test = C.any_of(F.col("_blob"), tokens)
        found = F.array_compact(F.array(*[
            F.when(F.col("_blob").contains(t), F.lit(f"signature:{t}")) for t in tokens]))
        family = F.when(test, F.lit(name)).otherwise(family)
        hits = F.when(test, found).otherwise(hits)
    marked = bind(bind(pages, _blob=blob), _family=family, _hits=hits).drop("_blob")
    links = F.regexp_extract_all(html, F.lit(r"(?i)(?:href|src)\s*=\s*[\"']([^\"']+)[\"']"),
                                 F.lit(1))
    calls = F.concat(
        F.regexp_extract_all(html, F.lit(r"(?i)https?://[^\"'\s<>]+/api/[^\"'\s<>]+"), F.lit(0)),
        F.regexp_extract_all(html, F.lit(r"(?i)fetch\([\"']([^\"']+)[\"']"), F.lit(1)))
    resolve = lambda raw: resolve_simple(raw, F.col(url))
    out = bind(
        marked,
        _artifacts=F.array_distinct(F.filter(F.transform(links, resolve), lambda u: F.lower(
            u).rlike(r"\.(csv|json|xml|zip|xls)"))),
        _apis=F.array_distinct(F.transform(calls, resolve)))
    official = U.host(F.col(url)).endswith(".gov")
    evidence = F.concat(F.col("_hits"), F.array_compact(F.array(
        F.when(F.size("_artifacts") > 0,
               F.concat(F.lit("download_artifacts:"), F.size("_artifacts"))),
        F.when(F.size("_apis") > 0, F.concat(F.lit("api_clues:"), F.size("_apis"))),
        F.when(official, F.lit("official_host")))))
    clues = (F.size("_artifacts") > 0) | (F.size("_apis") > 0)
    return out.select(
        *[c for c in pages.columns if c != html],
        F.coalesce("_family", F.when(clues, "structured_web").otherwise("unknown_web"))
        .alias("family"),
        F.when(F.size("_hits") > 0, "high").when(clues, "medium").otherwise("low")
        .alias("confidence"),
        evidence.alias("evidence"),
        F.array_sort(F.array_distinct(F.concat("_artifacts", "_apis")))
        .alias("discovered_artifacts"))


def resolve_simple(raw: Column, base: Column) -> Column:
    """Resolve a link inside an expression: absolute, host-relative, rooted or sibling."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"^(.*//[^/]*/.*/|.*//[^/]*/)",
                              1)
    folder = F.when(folder == "", F.concat(root, F.lit("/"))).otherwise(folder)
    return (
        F.when(raw.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), raw)
        .when(raw.startswith("//"), F.concat(scheme, raw))
        .when(raw.startswith("/"), F.concat(root, raw))
        .otherwise(F.concat(folder, raw))
    )


# Fixed value: what counts as a web address in running text.
TEXT_URL_PATTERN = r"""(?U)https?://[^\s\x1c-\x1f"'<>)]+"""


def anchors(pages: DataFrame, page_url: str = "url", html: str = "html") -> DataFrame:
    """One row per anchor with href, label and resolved link; the base for L3 and L4."""
    keep = [c for c in pages.columns if c != html]
    tags = pages.select(*keep, F.posexplode(H.elements(F.col(html), "a")).alias("pos", "_tag"))
    opened = F.regexp_extract("_tag", r"(?is)^(<[^>]*>)", 1)
    rows = bind(tags, href=H.attribute(opened, "href"), label=H.text_of(F.col("_tag")))
    rows = rows.select(*keep, "pos", "href", "label").filter("href is not null")
    return U.safe_urls(rows, "href", "link", page_url)


# What a result link says.
RESULT_TERMS = (
    r"(?i)\b(election results?|unofficial results?|official results?|precinct results?|"
    r"election night|live results?|enr|statement of votes cast|sovc?|cumulative results?|"
    r"precinct summary|summary report|precinct report|precincts reported|canvass report)\b")


def result_links(pages: DataFrame, page_url: str = "url", html: str = "html",
                 terms: str = RESULT_TERMS) -> DataFrame:
    """Anchors whose label or target uses a result term, one per page and link (L3)."""
    rows = anchors(pages, page_url, html).filter("link is not null")
    rows = rows.filter(F.concat_ws(" ", "label", "link").rlike(terms))
    return rows.groupBy(page_url, "link").agg(F.max_by("label", "pos").alias("label"))


def scored_links(pages: DataFrame, page_url: str = "url", html: str = "html") -> DataFrame:
    """Links with an election score above zero (L3)."""
    rows = anchors(pages, page_url, html).filter("link is not null")
    return (
        rows.withColumn("score", U.link_score(F.col("link"), F.lit("")))
        .filter("score > 0").groupBy(page_url, "link").agg(F.max("score").alias("score"))
    )


def artifact_links(pages: DataFrame, variant: str, page_url: str = "url",
                   html: str = "html") -> DataFrame:
    """Links of one artifact variant with its class (L4)."""
    return artifact_anchors(anchors(pages, page_url, html), variant, page_url)


def artifact_anchors(rows: DataFrame, variant: str, page_url: str = "url") -> DataFrame:
    """The same of ``anchors``, for several variants of the same pages."""
    rows = rows.filter("link is not null")
    test, kind = _artifact_tests()[variant]
    return (
        bind(rows.filter(test), kind=kind).groupBy(page_url, "link")
        .agg(F.max_by("label", "pos").alias("label"), F.max_by("kind", "pos").alias("kind"))
    )


def artifact_kinds(rows: DataFrame, variants: list[str], page_url: str = "url") -> DataFrame:
    """(page, link, variant, kind) of ``anchors`` for several variants, in one grouping of the links."""
    tests = _artifact_tests()
    rows = rows.filter("link is not null").select(page_url, "link", *[
        F.when(tests[v][0], F.struct("pos", tests[v][1].alias("kind"))).alias(v) for v in variants])
    # Links are shuffled and sorted by a number before their texts, once: few of a page are equal.
    rows = rows.withColumn("_hash", F.xxhash64(page_url, "link")).repartition("_hash")
    last = rows.groupBy("_hash", page_url, "link").agg(
        *[F.max(v).alias(v) for v in variants])
    return last.select(page_url, "link", F.inline(F.array_compact(F.array(*[
        F.when(F.col(v).isNotNull(), F.struct(F.lit(v).alias("variant"), F.col(v)["kind"].alias("kind")))
        for v in variants]))))


def _artifact_tests() -> dict[str, tuple[Column, Column]]:
    """Per variant, whether an anchor is one of its links, and of which kind."""
    link, label = F.col("link"), F.col("label")
    blob = F.lower(F.concat_ws(" ", link, label))
    return {
        "vendor": (C.any_of(F.lower(link), [".json", ".xml", ".csv", ".zip", "/api/", "results",
                                            "report"]), C.artifact_kind(link)),
        "download": (C.any_of(blob, [".csv", ".xml", ".json", ".zip", "download",
                                     "detail report", "precinct"]), C.artifact_kind(link)),
        "cms": (blob.rlike(r"(election|unofficial|official|results?|statement of votes|canvass)"),
                F.when(C.is_vendor("enhanced_voting", link), "enhanced_voting")
                .when(C.is_vendor("clarity", link), "clarity")
                .when(C.any_of(F.lower(link), [".pdf", "documentcenter/view"]), "document")
                .when(C.any_of(F.lower(link), [".csv", ".xlsx", ".xls"]), "structured_download")
                .otherwise("web")),
        "archive": (C.result_artifact(link, label), C.archive_artifact(link, label)),
        "document": (C.document_format(F.col("href")).isNotNull(),
                     C.document_format(F.col("href"))),
        "report": (label.rlike(REPORT_LINK), _report_kind(label)),
        "dynamic": (C.dynamic_document(link).isNotNull()
                    & F.concat_ws(" ", label, link).rlike(
                        r"(?i)(election|result|vote|canvass|primary|general)"),
                    C.dynamic_document(link)),
    }


# Report link names and the kinds they stand for.
REPORT_LINK = (r"(?i)(cumulative|official results|precinct\s+detail|overlap|"
               r"overlapping districts|results by groups)")
REPORT_KINDS = {"official results": "cumulative", "overlapping districts": "overlap",
                "results by groups": "group_detail"}


def _report_kind(label: Column) -> Column:
    raw = F.lower(F.regexp_extract(label, REPORT_LINK, 1))
    out = F.replace(raw, F.lit(" "), F.lit("_"))
    for name, kind in REPORT_KINDS.items():
        out = F.when(raw == name, kind).otherwise(out)
    return out


# Words that mark a unit entry in state directories.
UNIT_WORDS = {
    "LA": ["parish"], "MA": ["city", "town"], "MN": ["county"], "ND": ["county"],
    "NM": ["county"], "NY": ["county", "board of elections"],
    "RI": ["board of canvassers", "town", "city"], "SC": ["county"], "VT": ["town", "city"],
    "WI": ["clerk", "county", "town", "village", "city"], "AL": ["county", "election official"],
    "GA": ["county", "election office"], "KS": ["county", "election officer"],
}
_SOCIAL_OR_CODE = r"(?i)(facebook|twitter|youtube|instagram|googleapis|schema\.org)"


def hidden_candidates(pages: DataFrame, state: Column, page_url: str = "url",
                      html: str = "html") -> DataFrame:
    """Targets of anchors in a unit's context, of URL attributes and in scripts.

    An anchor's context is the nearest row, item, article, section or division around it, or else its
    own text; it must hold a word of the state's units, if the state has any. Attributes count
    whose name holds url or website. One row per page and URL.
    """
    keep = [c for c in pages.columns if c != html]
    base = F.col(page_url)
    unit_words = F.from_json(F.lit(json.dumps(UNIT_WORDS)), "map<string,array<string>>")
    wanted = F.coalesce(F.element_at(unit_words, state), F.array().cast("array<string>"))
    cut = with_elements(pages.withColumn("_words", wanted), html,
                        {"card": ["tr", "li", "article", "section", "div"]})

    # Each context is read once, however many anchors it holds.
    anchors = F.filter("_elements", lambda e: e["name"] == "a")
    cut = bind(cut, _anchors=anchors)
    own = F.transform("_anchors", lambda a: F.coalesce(a["card"], a["number"]))

    def told(number: Column) -> Column:
        text = F.lower(H.text_of(inner_html(numbered(number))))
        return (F.size("_words") == 0) | F.exists("_words", lambda w: text.contains(w))

    cut = bind(cut, _told=F.filter(F.array_distinct(own), told))
    in_context = F.filter("_anchors", lambda a: F.array_contains(
        "_told", F.coalesce(a["card"], a["number"])))
    in_rows = cut.select(*keep, F.explode(F.transform(in_context, lambda a: H.attribute(
        F.get("_pieces", a["start"]), "href"))).alias("raw"), F.lit("row_context").alias("basis"))
    in_rows = in_rows.filter("raw is not null")
    pair = (r"(?is)[\s\"'/][^\s\"'<>/=]*(?:url|website)[^\s\"'<>/=]*\s*=\s*"
            r"(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
    tags = F.transform(F.filter("_pieces", lambda p: p.rlike(r"(?i)^<[a-z]")),
                       lambda p: F.regexp_extract(p, rf"(?is)^{TAG}", 0))
    pairs = F.flatten(F.transform(tags, lambda t: F.regexp_extract_all(t, F.lit(pair), F.lit(0))))
    in_data = cut.select(*keep, F.explode(F.transform(pairs, lambda p: F.concat(
        *[F.regexp_extract(p, pair, i) for i in (1, 2, 3)]))).alias("raw"),
        F.lit("data_attribute").alias("basis"))
    in_script = (
        pages.select(*keep, F.explode(H.elements(F.col(html), "script")).alias("_s"))
        .select(*keep, F.explode(F.regexp_extract_all(
            "_s", F.lit(r"(?i)https?://[^\s'\"<>]+"), F.lit(0))).alias("raw"),
            F.lit("script").alias("basis"))
        .filter(~F.col("raw").rlike(_SOCIAL_OR_CODE))
        .withColumn("raw", F.regexp_replace("raw", r"[\\,}\]]+$", ""))
    )
    both = in_rows.unionByName(in_data).unionByName(in_script)
    return (
        both.withColumn("candidate_url", resolve_simple(F.trim("raw"), base))
        .filter(F.col("candidate_url").startswith("http"))
        .groupBy(*keep, "candidate_url")
        .agg(F.array_sort(F.collect_set("basis")).alias("bases"))
    )


def unit_name_forms(units: DataFrame, name: str = "canonical_name",
                    level: str | None = "jurisdiction_level") -> DataFrame:
    """Word forms of unit names; counties and parishes also without their suffix."""
    units = bind(units, _full=words(F.col(name)))
    full = F.col("_full")
    forms = F.array(full)
    if level is not None:
        short = F.regexp_replace(full, " (county|parish)$", "")
        forms = F.when(F.col(level).isin("county", "county_equivalent", "parish"),
                       F.array_distinct(F.array(full, short))).otherwise(forms)
    return units.withColumn("_form", F.explode(forms)).drop("_full").filter("_form <> ''")


def label_matches(texts: DataFrame, text_id: list[str], text: str, units: DataFrame,
                  unit_id: str, scope: list[str] | None = None, name: str = "canonical_name",
                  level: str | None = "jurisdiction_level") -> DataFrame:
    """Units named as a whole phrase in each text.

    Names are indexed by the word of theirs that the fewest names hold. Each word of a text meets the
    names it is the index of, and is compared in place, so the work grows with the text and
    no text meets a unit without that word. A name that lies inside a longer matched name of the same
    text is dropped; equal names of several units stay ambiguous.
    """
    scope = scope or []
    named = unit_name_forms(units, name, level).select(
        *scope, F.col(unit_id).alias("unit_id"), "_form").distinct()
    forms = named.select(*scope, "_form").distinct()
    parts = forms.select(*scope, "_form", F.posexplode(F.split("_form", " ")).alias("_off", "_word"))
    held = parts.groupBy(*scope, "_word").agg(F.count(F.lit(1)).alias("_names"))
    index = parts.join(held, [*scope, "_word"]).groupBy(*scope, "_form").agg(
        F.min_by(F.struct("_word", "_off"), F.struct("_names", "_off")).alias("_key"))
    index = index.select(*scope, F.col("_key._word").alias("_word"), F.col("_key._off").alias("_off"),
                         "_form", F.size(F.split("_form", " ")).alias("_len"))
    longest = forms.agg(F.coalesce(F.max(F.size(F.split("_form", " "))), F.lit(0)).alias("_max"))
    split = bind(texts.select(*text_id, *scope, F.col(text).alias("_label")),
                 _w=F.split(words(F.col("_label")), " ")).drop("_label")
    # One row: the longest name's word count. A word goes with as many words around it.
    split = split.join(F.broadcast(longest)).filter("_max > 0")
    first = F.greatest(F.col("_i") - F.col("_max") + 1, F.lit(0))
    at = split.select(*text_id, *scope, "_w", "_max", F.posexplode("_w").alias("_i", "_word"))
    at = at.select(*text_id, *scope, "_word", (F.col("_i") - first).alias("_at"),
                   F.slice("_w", first + 1, 2 * F.col("_max") - 1).alias("_around"))
    start = F.col("_at") - F.col("_off")
    same = F.array_join(F.slice("_around", F.greatest(start, F.lit(0)) + 1, F.col("_len")),
                        " ") == F.col("_form")
    hits = at.join(index, [*scope, "_word"]).filter((start >= 0) & same).select(
        *text_id, *scope, "_form").distinct()
    found = hits.groupBy(*text_id, *scope).agg(F.collect_set("_form").alias("_all"))
    inside = lambda h: F.exists("_all", lambda f: (f != h) & F.concat(
        F.lit(" "), f, F.lit(" ")).contains(F.concat(F.lit(" "), h, F.lit(" "))))
    kept = found.select(*text_id, *scope, F.explode(F.filter(
        "_all", lambda h: ~inside(h))).alias("_form"))
    return kept.join(named, [*scope, "_form"]).select(*text_id, *scope, "unit_id").distinct()


#: A row of up to 1000 characters is no longer in raw text: references have up to 33 for one.
LONGEST_ROW = 33_000
# Hosts that are no authority's, words that name one, and endings of documents.
SOCIAL_HOSTS = r"(^|\.)(facebook\.com|twitter\.com|x\.com|instagram\.com|youtube\.com)$"
AUTHORITY_WORDS = (r"(?i)\b(elections?|clerk|registrar|board|county|parish|municipal|town|city)\b")
DOCUMENT_PATH = r"(?i)\.(pdf|csv|xlsx?|docx?|zip|xml|json)$"
GOOD_ROLES = ["authority_website_lead", "external_website_lead", "result_page_lead"]


def directory_links(pages: DataFrame, units: DataFrame, election_year: int = 2026,
                    page_url: str = "url", html: str = "html", state: str = "state") -> DataFrame:
    """Directory links tied to named units by label, row, summary or term.

    The link's own text is tried first, then that of the nearest table row or list item around it (up
    to 1000 characters), then the summary of the nearest details element or the term before the nearest
    definition (up to 300). Elements nest as a browser's parser without repairs would nest them. A row whose
    raw text is longer than ``LONGEST_ROW`` is no context. Of the links of a page with equal target,
    units and status the first is kept. Associated ids are a set of at most the units one text names.
    """
    h = F.col(html)
    snap = F.sha2(h, 256)
    base = pages.select(page_url, state, html, snap.alias("snapshot_sha256"))
    base = U.normalize_urls(base, page_url, "_page")
    base = base.filter((F.col("_page") != "") & U.publishable(F.col("_page")))
    base = bind(base, _title=H.first_element_text(h, "title"), _words=H.text_of(h))
    access = C.access_state(h, F.col("_title"), F.col("_words"))
    base = bind(base, _access=access).filter("_access = 'html_content'")
    base = base.drop("_title", "_words", "_access")
    tag = F.regexp_extract(h, r"(?is)(<base\b[^>]*>)", 1)
    base = bind(base, _href0=F.coalesce(H.attribute(tag, "href"), F.lit("")))
    base = U.normalize_urls(base, "_href0", "_b", "_page")
    base = bind(base, resolution_base=F.when(
        (F.col("_href0") != "") & (F.col("_b") != ""), F.col("_b")).otherwise(F.col("_page")))

    base = with_anchors(base, html, LONGEST_ROW)
    found = base.select("_page", state, "snapshot_sha256", "resolution_base", F.inline("_anchors"))
    found = U.normalize_urls(found, "href", "link", "resolution_base")
    found = found.filter((F.col("link") != "") & U.publishable(F.col("link"))
                         & ~(F.col("link").rlike(r"(?:facebook|twitter|x|instagram|youtube)\.com")
                             & U.host(F.col("link")).rlike(SOCIAL_HOSTS)))
    # Both the texts to match and the links take it, which reads and parses each page once.
    found = write_once(found)
    options = [("anchor_label", "label", None), ("directory_row", "_row", 1000),
               ("details_summary", "_summary", 300), ("definition_term", "_term", 300)]
    text = {c: F.col(c) if most is None else F.when(F.length(c) <= most, F.col(c))
            for _, c, most in options}
    texts = F.array_distinct(F.array_compact(F.array(*text.values())))
    distinct_texts = found.select(state, F.explode(texts).alias("_text")).distinct()
    named = label_matches(distinct_texts, ["_text"], "_text", units, "jurisdiction_id",
                          scope=[state])
    # Only texts that name a unit; as a table its size is known to the joins that follow.
    named = write_once(named.groupBy(state, "_text").agg(
        F.array_sort(F.collect_set("unit_id")).alias("_ids"), F.lit(0).cast("long").alias("_own")))
    # The first basis that names a unit wins for each anchor. A text that is not looked up has a key
    # of its own, so that rows without one do not meet in one task.
    ids, basis, head = (F.lit(None).cast(t) for t in ("array<string>", "string", "string"))
    rows = found.withColumns({"_ids": ids, "_basis": basis, "_head": head})
    for name, c, _ in options:
        rows = rows.withColumn("_text", F.when(F.col("_ids").isNull(), text[c]))
        rows = rows.withColumn("_own", F.when(F.col("_text").isNull(), F.xxhash64(
            "_page", "_anchor")).otherwise(F.lit(0).cast("long")))
        hit = named.select(state, "_text", "_own", F.col("_ids").alias("_hit"))
        rows = rows.join(hit, [state, "_text", "_own"], "left")
        new = F.col("_hit").isNotNull()
        rows = rows.withColumns({
            "_basis": F.when(new, name).otherwise(F.col("_basis")),
            "_head": F.when(new, F.col("_text")).otherwise(F.col("_head")),
            "_ids": F.coalesce("_ids", "_hit")}).drop("_hit", "_text", "_own")
    context = (F.when(F.col("_ids").isNull(), F.coalesce("_row", "label"))
               .when(F.col("_basis") == "anchor_label", F.col("label"))
               .when(F.col("_basis") == "directory_row", F.col("_head"))
               .otherwise(F.concat_ws(" ", F.col("_head"), F.col("label"))))
    rows = rows.select(
        F.col(state).alias("state"), F.col("link").alias("url"),
        F.col("_page").alias("observed_from"), "resolution_base", "href", "label",
        context.alias("_context"),
        F.coalesce("_ids", F.array().cast("array<string>")).alias("associated_unit_ids"),
        "_basis", "snapshot_sha256", "_anchor")
    n = F.size("associated_unit_ids")
    rows = rows.filter((n > 0) | F.concat_ws(" ", F.col("label"), U.path(F.col("url")))
                       .rlike(AUTHORITY_WORDS))
    artifact = U.path(F.col("url")).rlike(DOCUMENT_PATH)
    anchor_only = F.col("href").startswith("#") | (F.col("url") == F.col("observed_from"))
    status = (F.when(anchor_only, "directory_anchor").when(artifact, "artifact_lead")
              .when(n == 1, "unit_label_candidate").when(n > 1, "ambiguous_unit_label")
              .otherwise("unmatched_directory_link"))
    rows = rows.select(
        "*", status.alias("match_status"),
        F.when(n > 0, F.col("_basis")).otherwise("authority_keyword").alias("match_basis"))
    key = ["observed_from", "state", "url", "associated_unit_ids", "match_status"]
    # Rows are sorted by a number before their texts; what follows from the others is added after.
    first = rows.groupBy(F.xxhash64(*key).alias("_hash"), *key).agg(F.min(F.struct(
        "_anchor", F.unhex("snapshot_sha256").alias("_snapshot"), "resolution_base", "match_basis",
        "label", "_context")).alias("_first")).select(*key, "_first.*")
    here = F.col("match_status") == "directory_anchor"
    first = first.select(
        *key, "resolution_base", "match_basis", "label", "_context",
        F.lower(F.hex("_snapshot")).alias("snapshot_sha256"),
        U.link_role(F.col("url"), F.col("observed_from"), F.col("label"), F.col("_context"),
                    artifact, here).alias("link_role"),
        F.when((n == 1) & ~artifact & ~here, "review_unit_and_authority_association")
        .otherwise("review_ambiguous_or_unmapped_link").alias("next_action"))
    first = U.source_context(first, "url", F.col("_context"), election_year)
    first = first.withColumns({"label": U.clean_label(F.col("label")),
                               "evidence_excerpt": U.clean_label(F.col("_context"))})
    return first.select(
        "state", "url", "observed_from", "resolution_base", "associated_unit_ids",
        "match_status", "match_basis", "link_role", "label", "evidence_excerpt",
        "snapshot_sha256", "next_action", "election_context", "election_year_clues",
        "source_format", "update_evidence")


def unresolved_units(units: DataFrame, links: DataFrame) -> DataFrame:
    """Units without a single unambiguous website label."""
    matched = links.filter(
        (F.col("match_status") == "unit_label_candidate") & F.col("link_role").isin(GOOD_ROLES)
    ).select(F.element_at("associated_unit_ids", 1).alias("jurisdiction_id"), "state").distinct()
    return units.join(matched, ["jurisdiction_id", "state"], "left_anti").select(
        "jurisdiction_id", "state", F.col("canonical_name").alias("jurisdiction_name"),
        F.lit("hunt_additional_authority_evidence").alias("next_action"))


def csv_directory(rows: DataFrame, units: DataFrame, page_url: Column, name: str, url: str,
                  state: str = "state", row_number: str = "row_number") -> DataFrame:
    """Directory rows from explicit name and URL columns."""
    absolute = F.lower(F.trim(F.col(url))).rlike("^https?://")
    named = rows.filter((F.trim(F.col(name)) != "") & absolute)
    named = U.normalize_urls(named.withColumn("observed_from", page_url), url, "link")
    named = named.filter((F.col("link") != "") & U.publishable(F.col("link")))
    hits = label_matches(named, [row_number], name, units, "jurisdiction_id", scope=[state])
    ids = hits.groupBy(row_number, state).agg(
        F.array_sort(F.collect_set("unit_id")).alias("associated_unit_ids"))
    joined = named.join(ids, [row_number, state], "left")
    n = F.coalesce(F.size("associated_unit_ids"), F.lit(0))
    artifact = U.path(F.col("link")).rlike(DOCUMENT_PATH)
    here = F.col("link") == F.col("observed_from")
    status = (F.when(here, "directory_anchor").when(artifact, "artifact_lead")
              .when(n == 1, "unit_label_candidate").when(n > 1, "ambiguous_unit_label")
              .otherwise("unmatched_directory_link"))
    label = U.clean_label(F.col(name))
    keyword = F.concat(F.lit("Website "), U.path(F.col("link"))).rlike(AUTHORITY_WORDS)
    return joined.filter((n > 0) | keyword).select(
        state, F.col("link").alias("url"), "observed_from", row_number,
        F.coalesce("associated_unit_ids", F.array().cast("array<string>"))
        .alias("associated_unit_ids"),
        status.alias("match_status"), F.lit("csv_row").alias("match_basis"),
        U.link_role(F.col("link"), F.col("observed_from"), F.lit("Website"),
                    F.concat_ws(" ", F.col(name), F.lit("Website")), artifact, here)
        .alias("link_role"), label.alias("label"))


def text_urls(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """One numbered lead per distinct web address in a text, in order of first appearance.

    Adds ``source_record_id`` (the ``prefix`` column and the number from 1), ``lead_url`` and
    ``official_status``. Punctuation at an address's end is not part of it. Texts without an address,
    null ones included, give no row.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(TEXT_URL_PATTERN), F.lit(0))
    urls = F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, "[.,;:]+$", "")))
    rows = df.select("*", F.posexplode(urls).alias("_at", "lead_url"))
    return rows.withColumns({
        "source_record_id": F.concat_ws(":", F.col(prefix), F.col("_at") + 1),
        "official_status": U.lead_status(F.col("lead_url"))}).drop("_at")
