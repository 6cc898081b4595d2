"""Ordered decision tables: platforms, artifacts, tiers, actions and grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyweave.functions.urls import host, path

# Fixed values. Each table is read top to bottom; a row is (result, any of these tokens).
PAGE_PLATFORMS = [
    ("clarity", ["clarityelections"]),
    ("washtenaw_enr", ["electionresults.ewashtenaw.org/electionreporting"]),
    ("washtenaw_archive", ["electionarchive.washtenaw.org"]),
    ("scytl", ["scytl"]),
    ("electionware", ["electionware", "essvote"]),
    ("dominion", ["dominionvoting", "dominion voting"]),
    ("enhanced_voting", ["enhancedvoting", "enhanced voting"]),
    ("knowink_totalvote", ["knowink", "totalvote"]),
    ("electionsource", ["electionsource"]),
]
RESULT_FAMILIES = [
    ("enhanced_voting", ["enhancedvoting"]),
    ("clarity", ["clarityelections", "election night reporting"]),
    ("scytl", ["scytl"]),
    ("electionware", ["electionware"]),
    ("civicplus", ["civicplus", "civicengage", "documentcenter"]),
    ("tabular_download", [".csv", ".xlsx", ".xls"]),
    ("pdf", [".pdf"]),
]
HOST_PLATFORMS = [
    ("enhanced_voting", ["enhancedvoting"]),
    ("clarity", ["clarityelections"]),
    ("election_reporting", ["electionreporting"]),
]
SURFACE_SIGNATURES = [
    ("enhanced_voting", ["enhancedvoting", "enhanced voting"]),
    ("clarity", ["clarityelections", "election night reporting", "enrresults"]),
    ("scytl", ["scytl"]),
    ("electionware", ["electionware"]),
]
VENDOR_TOKENS = {
    "clarity": ["clarityelections.com", "election night reporting"],
    "enhanced_voting": ["enhancedvoting.com", "enhanced voting"],
    "scytl": ["scytl"],
    "electionware": ["electionware"],
    "civicplus": ["civicplus", "civicengage", "documentcenter/view"],
}
DYNAMIC_DOCUMENTS = [
    ("tyler_portico", r"(?i)(tyler|portico|navigator)"),
    ("document_center", r"(?i)(documentcenter|document-center)"),
    ("laserfiche", r"(?i)laserfiche"),
]
ARTIFACT_SCORES = {"json": 50, "xml": 40, "csv": 30, "excel": 20, "archive": 10, "unknown": 0}
GENERIC_NAME_TOKENS = [
    "elections", "election", "voting", "vote", "results", "result", "auditor", "auditors",
    "clerk", "clerks", "county", "counties", "official", "officials", "sos", "state", "www",
    "gov", "government", "departments", "department", "about", "contact",
]
ARCHIVE_RESULT = (r"(?i)(election\s+results?|official\s+results?|statement\s+of\s+votes?|"
                  r"canvass|precinct\s+results?|ward\s+results?|turnout|referendum\s+results?)")
ARCHIVE_CONTEXT = r"(?i)(election|primary|general|referendum|vote|ballot)"
ARCHIVE_NEGATIVE = (
    r"(?i)(absentee\s+(ballot\s+)?(request|application)|request\s+absentee|"
    r"voter\s+registration|faq|frequently\s+asked|search\s+results?|"
    r"sample\s+ballot|polling\s+place|where\s+do\s+i\s+vote)")
ARCHIVE_DYNAMIC = r"(?i)(tyler|portico|navigator|documentcenter|laserfiche)"
STAGES = ["discovered", "fetchable", "parser_selected", "parse_executed", "normalized",
          "replay_tested", "refresh_verified"]


def any_of(text: Column, tokens: list[str]) -> Column:
    out = F.lit(False)
    for t in tokens:
        out = out | text.contains(t)
    return out


def first_table_match(text: Column, rows: list[tuple[str, list[str]]],
                      default: str | None = None) -> Column:
    """Result of the first row that has one of its tokens in the text."""
    out = None
    for result, tokens in rows:
        out = F.when(any_of(text, tokens), result) if out is None else out.when(
            any_of(text, tokens), result)
    return out.otherwise(F.lit(default))


def _blob(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *parts))


def page_platform(url: Column, html: Column) -> Column:
    """Twelve-family platform fingerprint of a page (F29); null when none."""
    blob = _blob(url, html)
    reports = blob.contains("precincts reported") & any_of(
        blob, ["summary report", "precinct report"])
    archive = blob.contains("cumulative results") & blob.contains("precinct results")
    return F.coalesce(
        first_table_match(blob, PAGE_PLATFORMS),
        F.when(reports, "report_center_precinct_summary")
        .when(any_of(blob, ["statement of votes cast", "sovc"]), "statement_of_votes_cast")
        .when(archive, "cumulative_precinct_archive"))


def result_family(url: Column, text: Column) -> Column:
    """Access family of a result URL."""
    official = host(url).endswith(".gov") | host(url).contains(".gov.")
    return F.coalesce(
        first_table_match(_blob(url, text), RESULT_FAMILIES),
        F.when(official, "official_web").otherwise("unknown_web"))


def host_platform(url: Column) -> Column:
    return first_table_match(host(url), HOST_PLATFORMS, "unknown_web")


def queue_family(url: Column) -> Column:
    """Family and parser of a harvested URL as a struct."""
    h, p = host(url), F.lower(path(url))

    def pair(family: str, parser: str) -> Column:
        return F.struct(F.lit(family).alias("family"), F.lit(parser).alias("parser"))

    return (
        F.when(h.contains("clarityelections.com"), pair("clarity", "clarity"))
        .when(p.contains("/results/public/"), pair("results_portal", ""))
        .when(any_of(h, ["electionresults.", "results."]) | h.startswith("enr."),
              pair("results_portal", ""))
        .when(p.endswith(".csv") | any_of(p, ["export", "mediafiles"]),
              pair("tabular_export", "generic_csv"))
        .when(p.rlike(r"\.xlsx?$"), pair("tabular_export", "generic_excel"))
        .when(p.endswith(".pdf"), pair("document", "pdf_extract"))
        .when(h.endswith(".gov") | h.contains(".gov.") | h.endswith(".us"),
              pair("official_web", ""))
        .otherwise(pair("unknown", ""))
    )


def is_vendor(vendor: str, url: Column, body: Column | None = None) -> Column:
    """Vendor predicate over URL and body."""
    return any_of(_blob(url, *([body] if body is not None else [])), VENDOR_TOKENS[vendor])


def dynamic_document(url: Column, body: Column | None = None) -> Column:
    """Document platform named by URL or body."""
    text = F.concat_ws(" ", url, *([body] if body is not None else []))
    out = None
    for name, pattern in DYNAMIC_DOCUMENTS:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(
            text.rlike(pattern), name)
    return out


def artifact_kind(url: Column) -> Column:
    """Kind of a downloadable artifact by path."""
    p = F.lower(path(url))
    return (
        F.when(p.endswith(".json") | p.contains("/api/"), "json")
        .when(p.endswith(".xml"), "xml").when(p.endswith(".csv"), "csv")
        .when(p.rlike(r"\.xlsx?$"), "excel").when(p.endswith(".zip"), "archive")
        .otherwise("unknown")
    )


def artifact_score(url: Column) -> Column:
    """Base score of the kind, +5 for results, +4 for precinct detail (K4)."""
    kind, low = artifact_kind(url), F.lower(url)
    base = F.lit(0)
    for name, score in ARTIFACT_SCORES.items():
        base = F.when(kind == name, score).otherwise(base)
    return (base + F.when(low.contains("result"), 5).otherwise(0)
            + F.when(any_of(low, ["precinct", "detail"]), 4).otherwise(0))


def detail_artifact_score(url: Column) -> Column:
    """Vendor variant of the artifact score (K4)."""
    p = F.lower(path(url))

    def points(test: Column, n: int) -> Column:
        return F.when(test, n).otherwise(0)

    return (points(p.endswith(".xml"), 5) + points(p.contains("detail"), 4)
            + points(p.contains("precinct"), 3) + points(p.endswith(".json"), 2)
            + points(p.endswith(".csv"), 1))


def archive_artifact(url: Column, label: Column) -> Column:
    """Class of an archive link."""
    blob = _blob(url, label)
    return (
        F.when(blob.rlike(ARCHIVE_DYNAMIC), "dynamic_document")
        .when(blob.contains(".pdf"), "pdf")
        .when(any_of(blob, [".xlsx", ".xls"]), "spreadsheet")
        .when(blob.contains(".csv"), "csv")
        .when(blob.rlike(ARCHIVE_RESULT), "web")
        .otherwise("other")
    )


def result_artifact(url: Column, label: Column) -> Column:
    """True when an archive link really points at results."""
    blob = F.concat_ws(" ", url, label)
    named = blob.rlike(ARCHIVE_RESULT)
    document = archive_artifact(url, label).isin("pdf", "spreadsheet", "csv", "dynamic_document")
    context = blob.rlike(ARCHIVE_CONTEXT) & F.lower(blob).contains("result")
    return ~(blob.rlike(ARCHIVE_NEGATIVE) & ~named) & F.when(
        document, named | context).otherwise(named)


def document_format(href: Column) -> Column:
    """pdf, csv, xlsx or xls by the link's suffix before any query."""
    clean = F.lower(F.regexp_extract(href, r"^([^?]*)", 1))
    found = F.regexp_extract(clean, r"\.(pdf|csv|xlsx|xls)$", 1)
    return F.when(found != "", found)


def document_hints(label: Column, href: Column) -> Column:
    """Precinct, summary and audit hints of a document link."""
    blob = _blob(label, href)
    return F.struct(
        blob.contains("precinct").alias("precinct_hint"),
        any_of(blob, ["summary", "cumulative"]).alias("summary_hint"),
        any_of(blob, ["audit", "recount"]).alias("audit_hint"))


def access_state(html: Column, title: Column, text: Column) -> Column:
    """blocked_html, application_shell or html_content."""
    low = F.lower(text)
    blocked = (
        F.lower(F.coalesce(title, F.lit(""))).isin(
            "just a moment...", "request rejected", "access denied", "radware captcha page")
        | (low.contains("request blocked") & low.contains("cloudfront"))
        | text.startswith("Request Rejected The requested URL was rejected")
        | ((text == "") & html.rlike(r"(?is)<script\b[^>]*src\s*=\s*[\"']?[^\"'>]*/_Incapsula_Resource"))
    )
    shell = html.rlike(r"(?i)<app-root\b") | text.contains("{{")
    return F.when(blocked, "blocked_html").when(shell, "application_shell").otherwise(
        "html_content")


def whole_word(text: Column, word: Column) -> Column:
    """Case-insensitive match of a column's text as a whole word."""
    quoted = F.concat(F.lit("(?iU)(?<!\\w)\\Q"), F.replace(word, F.lit("\\E"), F.lit("")),
                      F.lit("\\E(?!\\w)"))
    return F.regexp(text, quoted)


def context_assessment(text: Column, name: Column, election: Column,
                       result_pattern: str) -> Column:
    """Whether a page names results, the place and the election (F32)."""
    results = text.rlike(result_pattern)
    place = (F.length(F.trim(name)) > 2) & whole_word(text, name)
    cycle = (F.coalesce(election, F.lit("")) != "") & whole_word(text, election)
    return F.when(results & place & cycle, "context_supported").otherwise("fetched_unverified")


def _tabular(url: Column, *suffixes: str) -> Column:
    low = F.lower(url)
    out = F.lit(False)
    for s in suffixes:
        out = out | low.endswith(s) | low.contains(s + "?")
    return out


def ingest_tier(family: Column, url: Column) -> Column:
    """How ready a family is to be read."""
    return (
        F.when(family.isin("enhanced_voting", "clarity"), "ready_adapter")
        .when((family == "tabular_download") & _tabular(url, ".csv", ".xls", ".xlsx"),
              "ready_adapter")
        .when(family.isin("tabular_download", "scytl", "electionware"),
              "needs_adapter_completion")
        .when(family == "pdf", "document_adapter")
        .when(family == "civicplus", "discovery_only")
        .otherwise("unsupported_web")
    )


TIER_ORDER = ["ready_adapter", "needs_adapter_completion", "document_adapter", "discovery_only",
              "unsupported_web"]


def tier_rank(tier: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, TIER_ORDER)), tier), F.lit(0))
                      - 1, F.lit(9))


def promotion_blocker(family: Column, url: Column) -> Column:
    """Why a candidate cannot be promoted."""
    return (
        F.when((family == "tabular_download") & _tabular(url, ".xls"), "xls_parser_required")
        .when((family == "tabular_download") & _tabular(url, ".xlsx"), "xlsx_parser_required")
        .when(family == "tabular_download", "tabular_schema_or_format_review")
        .when(family == "pdf", "document_adapter")
        .when(family.isin("official_web", "unknown_web"), "web_platform_signature_unknown")
        .otherwise("adapter_completion")
    )


def next_action(fetch_status: Column, family: Column, artifacts: Column) -> Column:
    """Next action of a harvested source."""
    return (
        F.when(~fetch_status.eqNullSafe("fetchable"), "fetch_blocked")
        .when(family.isin("clarity", "enhanced_voting"), "execute_existing_adapter")
        .when(F.coalesce(artifacts, F.lit("")) != "", "artifact_discovery")
        .when(family.isin("structured_web", "scytl", "electionware"), "new_platform_adapter")
        .otherwise("platform_probe_followup")
    )


def residual_class(failure: Column, stage: Column, family: Column) -> Column:
    """Why an execution did not finish."""
    failure = F.coalesce(failure, F.lit(""))
    return (
        F.when((failure == "") & stage.isin("normalized", "replay_tested", "refresh_verified"),
               "complete")
        .when(failure.startswith("http_")
              | failure.isin("network_error", "timeout", "promotion_fetch_blocked"),
              "fetch_hardening")
        .when(failure.isin("no_structured_artifact_discovered",
                           "requires_download_artifact_selection",
                           "artifact_discovered_requires_fetch"), "artifact_discovery")
        .when(failure.isin("invalid_json_payload", "no_normalized_observations"),
              "schema_adaptation")
        .when(failure.isin("parser_not_executable", "artifact_family_not_executable",
                           "needs_platform_work"), "new_platform_or_parser")
        .when(stage == "parser_selected", "parser_followup")
        .when(family.isin("clarity", "structured_json", "structured_xml", "tabular_download"),
              "known_family_followup")
        .otherwise("unclassified_followup")
    )


def residual_priority(kind: Column) -> Column:
    return (
        F.when(kind == "complete", 0).when(kind == "known_family_followup", 5)
        .when(kind.isin("artifact_discovery", "schema_adaptation"), 4)
        .when(kind == "fetch_hardening", 3).otherwise(2)
    )


def state_phase(enumerated: Column, reached: Column, result_links: Column) -> Column:
    """Coverage phase of a state."""
    return (
        F.when(F.coalesce(enumerated, F.lit(0)) > 0, "canonicalized")
        .when((reached > 0) & (result_links > 0), "promote_discovered_sources")
        .when(reached > 0, "classify_reached_authorities")
        .otherwise("resolve_central_directory")
    )


def authority_action(status: Column, result_links: Column) -> Column:
    """Next action for one state's authority row."""
    has = F.trim(F.coalesce(result_links, F.lit(""))) != ""
    return (
        F.when((status == "reached") & has, "promote_result_source")
        .when(status == "reached", "inspect_reached_authority")
        .otherwise("resolve_directory")
    )


# Parser names of this engine by access family and by artifact kind.
FAMILY_PARSERS = {"enhanced_voting": "script_json", "clarity": "download_links",
                  "tabular_download": "wide_csv"}
KIND_ROUTES = {
    "json": ("structured_json", "nested_json"),
    "csv": ("tabular_download", "wide_csv"),
    "xml": ("structured_xml", "vendor_links"),
    "excel": ("tabular_download", "wide_sheet"),
}
PAYLOAD_ROUTES = {k: KIND_ROUTES[k] for k in ("json", "csv", "excel")}
EXECUTABLE = ["script_json", "wide_csv", "nested_xml", "nested_json", "wide_sheet"]
DISCOVERY = ["download_links", "vendor_links"]


def _route(family: str | Column, parser: str) -> Column:
    family = F.lit(family) if isinstance(family, str) else family
    return F.struct(family.alias("family"), F.lit(parser).alias("route"))


def readiness_route(family: Column, best_kind: Column) -> Column:
    """Family and parser route for a source and its best artifact's kind."""
    fam = F.lower(F.trim(F.coalesce(family, F.lit(""))))
    out = (
        F.when(fam == "enhanced_voting", _route("enhanced_voting", "script_json"))
        .when((fam == "clarity") & best_kind.eqNullSafe("xml"),
              _route("clarity_xml", "nested_xml"))
        .when(fam == "clarity", _route("clarity", "download_links"))
        .when(fam.isin("scytl", "electionware", "results_portal", "structured_web")
              & best_kind.isNull(), _route(fam, "vendor_links"))
    )
    for kind, (name, parser) in KIND_ROUTES.items():
        out = out.when(best_kind == kind, _route(name, parser))
    return out.otherwise(_route(fam, ""))


def payload_route(kind: Column) -> Column:
    """Route by sniffed payload kind."""
    out = None
    for name, (family, parser) in PAYLOAD_ROUTES.items():
        step = _route(family, parser)
        out = F.when(kind == name, step) if out is None else out.when(kind == name, step)
    return out.otherwise(_route("", ""))


def artifact_route(url: Column) -> Column:
    """Route by artifact URL."""
    kind = artifact_kind(url)
    return (
        F.when(kind == "xml", _route("structured_xml", "nested_xml"))
        .when(kind.isin("json", "csv", "excel"), payload_route(kind))
        .otherwise(_route("", ""))
    )


def supported_parser(tier: Column, family: Column, url: Column) -> Column:
    """Parser able to read a candidate today, else null."""
    sheet = (family == "tabular_download") & _tabular(url, ".xls", ".xlsx")
    out = F.when(sheet, "wide_sheet")
    for name, parser in FAMILY_PARSERS.items():
        out = out.when(family == name, parser)
    return F.when(tier == "ready_adapter", out)


def promotion_action(fetch_status: Column, route: Column) -> Column:
    """What to do with a routed source."""
    return (
        F.when(~fetch_status.eqNullSafe("fetchable"), "fetch_blocked")
        .when(route.isin(EXECUTABLE), "execute_now")
        .when(route.isin(DISCOVERY), "discover_artifact")
        .otherwise("needs_platform_work")
    )


def portability(status: Column, rows: Column, units: Column, text_layer: Column) -> Column:
    """Provisional grade A-E."""
    return (
        F.when((status == "parsed") & (rows > 0) & (units > 0), "A")
        .when(status == "partial", "C")
        .when((status == "unreadable") & text_layer.eqNullSafe(False), "E")
        .when(status == "structurally_unresolved", "D")
        .otherwise("C")
    )


def needs_escalation(status: Column, rows: Column, error: Column) -> Column:
    """Whether an audited artifact must be looked at."""
    return (status.isin("unreadable", "structurally_unresolved") | (rows == 0)
            | F.coalesce(F.abs(error) > 0.005, F.lit(False)))


def verification_priority(url: Column, verification: Column, official: Column) -> Column:
    """Priority and reasons of a lead as a struct."""
    tests = [
        (~verification.eqNullSafe("verified"), 2, "unverified"),
        (official.eqNullSafe("likely_official"), 2, "likely_official"),
        (url.startswith("http://"), 1, "legacy_http"),
        (any_of(url, ["current-election", "eid=", "2020"]), 1, "cycle_or_current_pointer"),
    ]
    score = sum((F.when(t, w).otherwise(0) for t, w, _ in tests), F.lit(0))
    reasons = F.array_compact(F.array(*[F.when(t, F.lit(n)) for t, _, n in tests]))
    return F.struct(score.alias("priority"), F.array_join(reasons, ";").alias("reasons"))


def inferred_unit(url: Column, status: Column, model: Column) -> Column:
    """Unit name token and level from a county pattern in a URL (F37); null when generic."""
    place = F.concat(host(url), F.lower(path(url)))
    first = F.regexp_extract(place, r"(?i)(?:www\.)?([a-z][a-z0-9-]*?)county", 1)
    second = F.regexp_extract(place, r"(?i)county[-_/]([a-z][a-z0-9-]+)", 1)
    name = F.regexp_replace(F.when(first != "", first).otherwise(second), "^-+|-+$", "")
    model = F.coalesce(model, F.lit(""))
    level = (
        F.when(model.contains("parish"), "parish")
        .when(model.contains("municipal") | model.contains("town"), "municipality")
        .when(model.contains("local-election-authority"), "election_authority")
        .otherwise("county")
    )
    ok = (status == "reached") & (name != "") & ~name.isin(GENERIC_NAME_TOKENS)
    return F.when(ok, F.struct(name.alias("name_token"), level.alias("jurisdiction_level")))


def administrative_keys(*levels: str) -> Column:
    """Array of (level, key) for every non-blank level of a reporting path."""
    pairs = [F.when(F.coalesce(F.col(l), F.lit("")) != "",
                    F.struct(F.lit(l).alias("level"), F.col(l).alias("key"))) for l in levels]
    return F.array_compact(F.array(*pairs))


def harvested_family(url: Column) -> Column:
    """Family and parser route of a harvested source by its address (D3); blank where unknown."""
    where, to = host(url), F.lower(path(url))
    # Parts of hosts and paths, in order.
    return (
        F.when(where.contains("clarityelections.com"), _route("clarity", "clarity"))
        .when(to.contains("/results/public/") | where.contains("electionresults.")
              | where.contains("results.") | where.startswith("enr."), _route("results_portal", ""))
        .when(to.endswith(".csv") | to.contains("export") | to.contains("mediafiles"),
              _route("tabular_export", "wide_csv"))
        .when(to.endswith(".xlsx") | to.endswith(".xls"), _route("tabular_export", "wide_sheet"))
        .when(to.endswith(".pdf"), _route("document", "document_text"))
        .when(where.endswith(".gov") | where.contains(".gov.") | where.endswith(".us"),
              _route("official_web", ""))
        .otherwise(_route("unknown", ""))
    )
