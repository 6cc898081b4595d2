"""URL canonical forms, safety and relevance rules.

Whole-table functions take a DataFrame, so each parsed part is computed once per row and stays
in generated code; small predicates are plain Column expressions.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.html import unescape
from tallyweave.session import bind, let

# Generic URI syntax: scheme, authority, path, query, fragment; each pattern reads no further than its part.
_URI = (r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)",
        r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", r"^[^?#]*\?([^#]*)", r"(?s)^[^#]*#(.*)$")
_HAS_AUTHORITY = r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//"

# Words, hosts and patterns of the link rules.
RESULT_PATTERN = (r"(?i)election[\s/_-]*results?|unofficial[\s/_-]*results?|"
                  r"statement\s+of\s+votes?|canvass")
EMAIL_PATTERN = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PRIVATE_KEY_PATTERN = (r"(?i)token|session|auth|signature|ticket|saml|email|challenge|__cf_|"
                       r"captcha")
SAFE_QUERY_KEYS = [
    "erselectionid", "eid", "officeinelectionid", "officeinelectionidlist", "archived",
    "scenario", "sc_lang", "election", "electionid", "election_id", "electionyear",
    "electiondate", "year", "county", "countyid", "county_id", "state", "precinct",
    "precinctid", "precinct_id", "contest", "contestid", "contest_id", "race", "raceid",
    "race_id", "office", "officeid", "office_id", "district", "districtid", "district_id",
    "language", "lang", "view", "mode", "format", "page",
]
CHALLENGE_HOSTS = ["cloudflare.com", "perimeterx.net", "perfdrive.com"]
ARTIFACT_PATTERN = r"(?i)\.(pdf|csv|xlsx?|xml|json|zip|js|css)$"
ELECTION_TERMS = ["election", "voting", "vote", "result", "ballot", "clerk", "referendum",
                  "archive"]
VENDOR_HOSTS = ["enhancedvoting.com", "clarityelections.com", "electionreporting.com"]
PUBLIC_RESULT_HOSTS = ["app.enhancedvoting.com", "results.sos.ga.gov",
                       "electionresults.utah.gov", "enr.elections.virginia.gov"]
FORMAT_BY_SUFFIX = {
    "pdf": "pdf", "csv": "csv", "tsv": "tsv", "xls": "spreadsheet", "xlsx": "spreadsheet",
    "json": "json", "xml": "xml", "html": "html", "htm": "html", "aspx": "html", "php": "html",
}
# Address blocks that are not globally reachable (first address, prefix length).
NON_GLOBAL_V4 = [("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8),
                 ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 29),
                 ("192.0.0.170", 31), ("192.0.2.0", 24), ("192.168.0.0", 16),
                 ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24),
                 ("240.0.0.0", 4)]
NON_GLOBAL_V6 = r"^\[(::1?\]|::ffff:|64:ff9b:1:|100::|2001:db8:|3fff:|f[cd]|fe[89ab])"


def uri_part(url: Column, part: int) -> Column:
    """Part 1 scheme, 2 authority, 3 path, 4 query or 5 fragment; '' when absent."""
    return F.regexp_extract(url, _URI[part - 1], 1)


def host(url: Column) -> Column:
    """Lower-case host name, '' when there is none."""
    authority = F.regexp_replace(uri_part(url, 2), r"^.*@", "")
    return F.lower(F.regexp_extract(authority, r"^(\[[^\]]*\]|[^:]*)", 1))


def path(url: Column) -> Column:
    return uri_part(url, 3)


def _remove_dots(value: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of a path."""
    step = lambda acc, s: (
        F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(s))))

    def closed(joined: Column) -> Column:
        return F.when(value.rlike(r"(^|/)\.\.?$") & ~joined.endswith("/"),
                      F.concat(joined, F.lit("/"))).otherwise(joined)

    def rooted(out: Column) -> Column:
        return F.when(out.startswith("/"), out).otherwise(F.concat(F.lit("/"), out))

    folded = F.aggregate(F.split(value, "/"), F.array().cast("array<string>"), step)
    return F.when(value.rlike(r"(^|/)\.\.?(/|$)"), let(
        let(F.array_join(folded, "/"), closed), rooted)).otherwise(value)


def _clean_percent(value: Column) -> Column:
    """Decode percent escapes of unreserved characters; write the others in upper case."""
    def piece(p: Column) -> Column:
        code = F.upper(F.substring(p, 1, 2))
        char = F.char(F.conv(code, 16, 10).cast("long"))
        plain = code.rlike("^[0-7][0-9A-F]$") & char.rlike(r"^[A-Za-z0-9._~-]$")
        return (
            F.when(~p.rlike("^[0-9a-fA-F]{2}"), F.concat(F.lit("%"), p))
            .when(plain, F.concat(char, F.substr(p, F.lit(3))))
            .otherwise(F.concat(F.lit("%"), code, F.substr(p, F.lit(3))))
        )

    def rebuilt(parts: Column) -> Column:
        return F.concat(F.element_at(parts, 1), F.array_join(F.transform(
            F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), piece), ""))

    return let(value, lambda v: F.when(v.contains("%"), let(F.split(v, "%"), rebuilt)).otherwise(v))


def _decode(value: Column) -> Column:
    return F.coalesce(F.try_url_decode(value), F.replace(value, F.lit("+"), F.lit(" ")))


def _encode(value: Column) -> Column:
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")),
                     F.lit("%7E"), F.lit("~"))


def query_pairs(query: Column) -> Column:
    """Decoded ``(k, v)`` pairs of a query string; blank values are kept."""
    def pair(piece: Column) -> Column:
        key = F.regexp_extract(piece, r"(?s)^([^=]*)", 1)
        value = F.when(piece.contains("="), F.regexp_extract(piece, r"(?s)^[^=]*=(.*)$", 1))
        return F.struct(_decode(key).alias("k"),
                        _decode(F.coalesce(value, F.lit(""))).alias("v"))
    return F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), pair)


def _sorted_query(query: Column) -> Column:
    kept = F.filter(query_pairs(query), lambda p: ~F.lower(p.k).startswith("utm_"))
    text = F.array_join(F.transform(
        F.array_sort(kept), lambda p: F.concat(_encode(p.k), F.lit("="), _encode(p.v))), "&")
    return F.when(query == "", F.lit("")).otherwise(text)


def _public_host(name: Column) -> Column:
    v4 = name.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}"
                    r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$")

    def value(octets: Column) -> Column:
        return sum((F.coalesce(F.try_element_at(octets, F.lit(i + 1)).try_cast("long"), F.lit(0))
                    * 256 ** (3 - i) for i in range(4)), F.lit(0))

    def inside(number: Column) -> Column:
        out = F.lit(False)
        for first, length in NON_GLOBAL_V4:
            low = sum(int(o) * 256 ** (3 - i) for i, o in enumerate(first.split(".")))
            out = out | number.between(low, low + 2 ** (32 - length) - 1)
        return out

    blocked = let(let(F.split(name, r"\."), value), inside)
    return (
        (name != "") & (name != "localhost") & ~name.rlike(r"\.(local|localhost)$")
        & ~(v4 & blocked) & ~name.rlike(NON_GLOBAL_V6)
    )


def _resolved(link: Column, base: Column | None, squeeze: bool) -> Column:
    """The parts s, a, p and q of a link resolved against ``base``, as a struct.

    Parts are worked out inside one expression: as columns of their own each step would copy the row.
    """
    base = F.lit("") if base is None else F.coalesce(base, F.lit(""))

    def parts(url: Column, *more: Column) -> Column:
        return F.struct(F.lower(uri_part(url, 1)).alias("s"), uri_part(url, 2).alias("a"),
                        uri_part(url, 3).alias("p"), uri_part(url, 4).alias("q"), *more)

    def told(s: Column, a: Column, p: Column, q: Column) -> Column:
        return F.struct(s.alias("s"), a.alias("a"), p.alias("p"), q.alias("q"))

    def against(u: Column, b: Column) -> Column:
        absolute = ((u["s"] != "") & (u["s"] != b["s"])) | u["ua"]
        folder = let(F.regexp_extract(b["p"], r"(?s)^(.*/)", 1),
                     lambda f: F.when(f == "", F.lit("/")).otherwise(f))
        joined = F.concat(folder, u["p"])
        if squeeze:
            joined = F.regexp_replace(joined, "(?<=.)/{2,}", "/")
        relative = F.when(u["p"].startswith("/"), u["p"]).otherwise(joined)
        merged = F.when(u["p"] == "", b["p"]).otherwise(let(relative, _remove_dots))
        query = F.when((u["p"] == "") & (u["q"] == ""), b["q"]).otherwise(u["q"])
        scheme = F.when(u["s"] != "", u["s"]).otherwise(b["s"])
        return F.when(absolute, told(scheme, u["a"], u["p"], u["q"])).otherwise(
            told(scheme, b["a"], merged, query))

    # A link with scheme and host needs nothing of its base.
    return let(link, lambda v: let(parts(v, v.rlike(_HAS_AUTHORITY).alias("ua")), lambda u: F.when(
        (u["s"] != "") & u["ua"], told(u["s"], u["a"], u["p"], u["q"])).otherwise(
        let(let(base, lambda w: parts(w)), lambda b: against(u, b)))))


# Most links need no parsing: characters of a path that stay as they are, a plain public host, and
# links that are the result themselves or are appended to their base's site or folder.
_PLAIN = r"[A-Za-z0-9_~.,;:=@!$'()*+/-]"
_SITE = r"https?://(?:[a-z0-9-]++\.)+(?!local(?:host)?(?:[/?#]|\z))[a-z]{2,}"
_ANY_SITE = r"https?://[A-Za-z0-9.-]++(?::[0-9]++)?"
_QUERY = r"(?:\?[A-Za-z0-9_~.,;:=@!$'()*+/&%-]++)?"


def _quick(raw: Column, base: str | None, site: str, query: str) -> Column:
    """A plain link resolved; null for one that has to be parsed."""
    out = F.when(raw.rlike(rf"\A{site}/{_PLAIN}*+{query}\z"), raw)
    if base is None:
        return out
    b = F.col(base)

    def joined(start: str) -> Column:
        return let(F.regexp_extract(b, start, 1),
                   lambda first: F.when(first != "", F.concat(first, raw)))

    dots = raw.contains("/.") | raw.startswith(".") | raw.contains("//")
    folder = rf"\A({site}(?![^?#]*(?://|/\.))/(?:{_PLAIN}*/)?){_PLAIN}*(?:[?#]|\z)"
    return (out.when(~dots & raw.rlike(rf"\A/{_PLAIN}*+{query}\z"),
                     joined(rf"\A({site})(?:[/?#]|\z)"))
            .when(~dots & raw.rlike(rf"\A[A-Za-z0-9_~-][A-Za-z0-9_~./-]*+{query}\z"), joined(folder)))


def normalize_urls(df: DataFrame, raw: str, out: str, base: str | None = None) -> DataFrame:
    """Add ``out``: the raw link resolved, made canonical, or '' when unusable.

    Only public http(s) hosts on the default ports and without credentials remain. Unreserved
    percent escapes are decoded, ``utm_*`` keys dropped, the query sorted, the fragment dropped.
    """
    strip = F.regexp_replace(F.coalesce(F.col(raw), F.lit("")),
                             r"^[\s\x00-\x1f]+|[\s\x00-\x1f]+$", "")
    link = F.regexp_replace(unescape(strip), r"[\t\r\n]", "")

    def site(r: Column) -> Column:
        return let(F.regexp_replace(r["a"], r"^.*@", ""), lambda bare: F.struct(
            F.lower(F.regexp_extract(bare, r"^(\[[^\]]*\]|[^:]*)", 1)).alias("host"),
            F.regexp_extract(bare, r"^(?:\[[^\]]*\]|[^:]*):(.*)$", 1).alias("port")))

    def final(r: Column, at: Column) -> Column:
        valid = (r["s"].isin("http", "https") & ~r["a"].rlike("^[^@:]+(:[^@]*)?@")
                 & let(at["host"], _public_host) & at["port"].rlike(r"^(|0*80|0*443|0+)$"))
        query = let(_sorted_query(r["q"]), lambda q: F.when(
            q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
        clean = F.when(r["p"] == "", F.lit("/")).otherwise(_clean_percent(r["p"]))
        return F.when(valid, F.concat(r["s"], F.lit("://"), at["host"], clean, query)).otherwise(
            F.lit(""))

    done = let(_resolved(link, None if base is None else F.col(base), squeeze=True),
               lambda r: let(site(r), lambda at: final(r, at)))
    done = F.coalesce(_quick(F.col(raw), base, _SITE, ""), done)
    keep = [c for c in df.columns if c != out]
    return bind(df, _final=done).select(*keep, F.col("_final").alias(out))


def canonical_url(url: Column) -> Column:
    """Ledger form: lower scheme and host, keep port and query, drop fragment.

    Null when not absolute http(s), or with credentials or spaces in the host.
    """
    u = F.trim(url)
    authority = uri_part(u, 2)
    scheme = F.lower(uri_part(u, 1))
    ok = (scheme.isin("http", "https") & (authority != "")
          & ~authority.rlike(r"^[^@]+@") & ~authority.rlike(r"\s"))
    p = F.when(uri_part(u, 3) == "", F.lit("/")).otherwise(uri_part(u, 3))
    q = F.when(uri_part(u, 4) != "", F.concat(F.lit("?"), uri_part(u, 4))).otherwise(F.lit(""))
    return F.when(ok, F.concat(scheme, F.lit("://"), F.lower(authority), p, q))


def safe_urls(df: DataFrame, raw: str, out: str, base: str | None = None) -> DataFrame:
    """Add ``out``: the resolved link without fragment, null when not followable.

    Script, mail and data links and links with credentials are refused; unlike the normalized
    form the host case, port and query order are kept.
    """
    def final(u: Column, r: Column) -> Column:
        refused = u.rlike(r"(?i)^(javascript|mailto|data):") | (u == "")
        ok = (~refused & r["s"].isin("http", "https") & (r["a"] != "") & ~r["a"].rlike("^[^@]+@"))
        return F.when(ok, F.concat(r["s"], F.lit("://"), r["a"], r["p"], F.when(
            r["q"] != "", F.concat(F.lit("?"), r["q"])).otherwise(F.lit(""))))

    link = F.trim(F.coalesce(F.col(raw), F.lit("")))
    done = let(link, lambda u: let(
        _resolved(u, None if base is None else F.col(base), squeeze=False), lambda r: final(u, r)))
    done = F.coalesce(_quick(F.col(raw), base, _ANY_SITE, _QUERY), done)
    keep = [c for c in df.columns if c != out]
    return bind(df, _final=done).select(*keep, F.col("_final").alias(out))


def publisher_key(url: Column) -> Column:
    """Election root of a hosted result page, else the normalized URL itself."""
    root = F.concat(uri_part(url, 1), F.lit("://"), uri_part(url, 2))
    clarity = F.regexp_extract(path(url), r"^(/[^/]+/[^/]+/\d+/)", 1)
    public = F.regexp_extract(path(url), r"^(/results/public/[^/]+/elections/[^/]+)", 1)
    query = F.when(uri_part(url, 4) != "", F.concat(F.lit("?"), uri_part(url, 4))).otherwise(
        F.lit(""))
    return (
        F.when(host(url).endswith(".clarityelections.com") & (clarity != ""),
               F.concat(root, clarity))
        .when(host(url).isin(PUBLIC_RESULT_HOSTS) & (public != ""), F.concat(root, public, query))
        .otherwise(url)
    )


def publishable(url: Column) -> Column:
    """True when a URL carries no person, session or challenge data (F16)."""
    decoded = F.when(url.contains("%"), F.coalesce(
        F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)).otherwise(url)
    mail = decoded.contains("@") & decoded.rlike(EMAIL_PATTERN)
    unsafe_pair = url.contains("?") & F.exists(query_pairs(uri_part(url, 4)), lambda p: (
        ~F.lower(p.k).isin(SAFE_QUERY_KEYS) | p.k.rlike(PRIVATE_KEY_PATTERN)
        | (F.length(p.v) > 160) | p.v.rlike(r"^[A-Za-z0-9_-]{40,}$")))
    hosts = "|".join(name.replace(".", r"\.") for name in CHALLENGE_HOSTS)
    named = reduce(or_, (F.lower(url).contains(name) for name in CHALLENGE_HOSTS))
    challenge = (url.contains("/cdn-cgi/") & path(url).contains("/cdn-cgi/")) | (
        named & host(url).rlike(rf"(?:{hosts})\z"))
    return ~mail & ~challenge & ~unsafe_pair


def clean_label(label: Column) -> Column:
    """Single spaces and no e-mail addresses."""
    flat = F.trim(F.regexp_replace(label, r"(?U)\s+", " "))
    return F.regexp_replace(flat, EMAIL_PATTERN, "[email omitted]")


def source_context(df: DataFrame, url: str, label: Column | None = None,
                   election_year: int = 2026) -> DataFrame:
    """Add election_context, election_year_clues, source_format, update_evidence."""
    decoded = F.coalesce(F.try_url_decode(F.replace(F.col(url), F.lit("+"), F.lit("%2B"))),
                         F.col(url))
    text = F.concat(decoded, F.lit(" "), F.coalesce(label, F.lit("")) if label is not None
                    else F.lit(""))
    df1 = bind(df, _text=text)
    years = F.array_sort(F.array_distinct(F.regexp_extract_all(
        "_text", F.lit(r"(?<!\d)(20\d{2})(?!\d)"), F.lit(1))))
    archive = F.col("_text").rlike(
        r"(?i)\b(?:archive|archived|historical|past elections)\b|resultsarchive")
    df2 = bind(df1, _years=years, _archive=archive)
    have = F.size("_years") > 0
    context = (
        F.when(F.col("_archive") | (have & F.forall(
            "_years", lambda y: y.cast("int") < election_year)), "historical")
        .when((F.size("_years") == 1) & (F.element_at("_years", 1) == str(election_year)),
              "current_year_candidate")
        .when(have, "mixed_or_other_years")
        .otherwise("unknown")
    )
    formats = F.create_map(*[F.lit(x) for pair in FORMAT_BY_SUFFIX.items() for x in pair])
    kind = F.coalesce(F.element_at(formats, F.lower(
        F.element_at(F.split(path(F.col(url)), r"\."), -1))), F.lit("unknown"))
    return df2.select(
        *df.columns, context.alias("election_context"),
        F.array_join("_years", " | ").alias("election_year_clues"),
        kind.alias("source_format"), F.lit("unknown").alias("update_evidence"))


def official_host(url: Column) -> Column:
    """True for hosts under .gov."""
    return host(url).endswith(".gov") | (host(url) == "gov")


def lead_status(url: Column) -> Column:
    return F.when(official_host(url), "likely_official").otherwise("unknown")


def link_score(url: Column, text: Column) -> Column:
    """Number of election terms present, plus two on an official host."""
    hay = F.lower(F.concat(url, F.lit(" "), text))
    terms = sum((hay.contains(t).cast("int") for t in ELECTION_TERMS), F.lit(0))
    official = host(url).endswith(".gov") | host(url).contains(".gov.")
    return (terms + F.when(official & (terms > 0), 2).otherwise(0)).cast("double")


def link_role(target: Column, page_url: Column, label: Column, context: Column,
              artifact: Column, anchor_only: Column) -> Column:
    """First matching role of a directory link."""
    around = F.concat_ws(" ", label, context, path(target))
    return (
        F.when(anchor_only, "directory_anchor")
        .when(artifact | path(target).rlike(r"(?i)/(?:media|documents?|download|maps)/"),
              "document_or_map_lead")
        .when(F.concat_ws(" ", target, label).rlike(
            r"(?i)election[\s/_-]*results?|results?archive|/results(?:/|$)|\benr\b|canvass"),
            "result_page_lead")
        .when(around.rlike(
            r"(?i)clerk|registrar|board\s+of\s+elections|elections?\s+(?:office|board)|"
            r"supervisor\s+of\s+elections"), "authority_website_lead")
        .when(host(target) != host(page_url), "external_website_lead")
        .otherwise("other_unit_link")
    )


def allowed_link(seed_url: Column, candidate: Column) -> Column:
    """Same site as the seed, or a known result vendor."""
    seed, target = host(seed_url), host(candidate)
    out = (target == seed) | target.endswith(F.concat(F.lit("."), seed))
    for vendor in VENDOR_HOSTS:
        out = out | (target == vendor) | target.endswith("." + vendor)
    return out


def election_root(url: Column) -> Column:
    """Hosted election root, else the folder of the URL."""
    hosted = F.regexp_extract(
        url, r"(?i)^(https?://results\.enr\.clarityelections\.com/[^/]+/[^/]+/\d+/)", 1)
    folder = F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"^(.*//.*/|.*//[^/]*$)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return F.when(hosted != "", hosted).otherwise(folder)


def archived_original(url: Column) -> Column:
    """Original URL inside an archive capture URL, else the URL itself."""
    inner = F.regexp_extract(
        url, r"(?i)^https?://web\.archive\.org/web/\d+(?:[a-z_]+)?/(https?://.+)$", 1)
    return F.when(inner != "", inner).otherwise(url)
