"""A capture is parsed once, however many of its values are used."""

from pyspark.sql import functions as F

from tallyweave.functions import urls as U
from tallyweave.operators import links as L
from tallyweave.sources import results as R
from tallyweave.sources.crosscheck import district_captures


def test_nested_xml_parses_each_unit_once(spark):
    body = F.concat(
        F.lit('<R><Precinct id="k'), F.col("id"), F.lit('"><Contest><Name>Race</Name><Choice name="A">'
        '<Total votes="'), F.col("id") + 5, F.lit('"/></Choice></Contest></Precinct>'
        '<Precinct><Name>u</Name></Precinct></R>'))
    out = R.nested_xml(spark.range(2).select(body.alias("body")), "body",
                       R.Context.of("2026", "mi-x", "src", "2026-11-03 00:00:00"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1
    rows = out.select("reporting_unit_name", "contest_name", "choice_name", "votes").collect()
    assert sorted(map(tuple, rows)) == [("k0", "Race", "A", 5), ("k1", "Race", "A", 6)]


def test_link_targets_read_each_page_once(spark):
    html = F.concat(F.lit("<a href='/a'>x</a><script src='/s.js'>fetch('/f'); y = \"https://o.org/"),
                    F.col("id"), F.lit("\"</script>"))
    pages = spark.range(2).select("id", F.lit("https://e.org/d/p").alias("url"), html.alias("html"))
    out = L.extract_targets(pages)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    rows = out.filter("id = 1").select("kind", "raw_target", "resolution_base").collect()
    assert sorted((r.kind, r.raw_target) for r in rows) == [
        ("embedded", "/f"), ("embedded", "https://o.org/1"), ("link", "/a"),
        ("response", "https://e.org/d/p"), ("script", "/s.js")]
    assert {r.resolution_base for r in rows} == {"https://e.org/d/p"}


def test_uri_parts_stop_at_their_delimiters(spark):
    texts = ["http://u@h:1/a/b?q=1?2#f?g#h", "//h?x", "a:b/c#", "/p//q?#z", "x//y", "1a://b", "", "#?a",
             "http:/x", "h\nt://a\nb/c\nd?e\nf#g\nh"]
    whole = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for part in range(1, 6):
        assert not df.filter(U.uri_part(F.col("t"), part) != F.regexp_extract("t", whole, part)).count()


def test_statewide_tables_parse_pages_before_their_four_results(spark):
    cells = lambda *xs: "<tr>" + "".join(f"<td>{x}</td>" for x in xs) + "</tr>"
    page = "<table>" + cells(*R.STATEWIDE_HEADER) + cells("A", "DEM", 1, 2, 3, 4, 10, "5%") + cells(
        "Totals", "", 1, 2, 3, 5, 11, "100%") + "</table>"
    good, bad = R.statewide_tables(spark.createDataFrame([(1, page)], "k int, body string"), ["k"], "body")
    for out in (good, bad):
        assert "regexp_extract_all(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.candidate, r.total) for r in good.collect()] == [("A", 10)]
    assert [r.rule_id for r in bad.collect()] == ["candidate_sums_differ"]


def test_district_files_are_parsed_before_their_results(spark):
    head = ",".join([*R.DISTRICT_KEY, "County Name", *R.DISTRICTS])
    body = head + "\n00,Gov,,A,DEM,State,1,2,3,4,5,6,7,8\n"
    files = spark.createDataFrame([(1, body.encode())], "k int, body binary")
    rows, bad = district_captures(files, "body", "k")
    plans = rows.unionByName(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plans and "LogicalRDD" not in plans
    assert [(r.candidate, r.district_sum) for r in rows.collect()] == [("A", 36)] and not bad.count()


def test_directory_pages_are_parsed_before_their_texts_are_matched(spark):
    page = spark.createDataFrame([("https://s.gov/dir", "SS", "<a href='/c'>York County</a>")],
                                 "url string, state string, html string")
    units = spark.createDataFrame([("u0", "SS", "York County", "county")],
                                  "jurisdiction_id string, state string, canonical_name string,"
                                  "jurisdiction_level string")
    out = L.directory_links(page, units)
    assert "regexp_extract_all(html" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.url, r.associated_unit_ids) for r in out.collect()] == [("https://s.gov/c", ["u0"])]


def test_parts_of_an_expression_stand_in_it_once(spark):
    from tallyweave.functions.html import unescape

    df = spark.createDataFrame([("&#65;&amp;&ampx;&x; &#X42",)], "t string")
    out = U.normalize_urls(df.select("t", unescape(F.lower("t")).alias("low")), "t", "u")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(t") == 1 and plan.count("conv(") <= 6
    assert out.first().low == "A&&x;&x; B"


def test_artifact_variants_share_one_table_of_anchors(spark):
    from tallyweave.plans.web import artifact_links

    out = artifact_links(spark, "/root/testdata/sf0.001")
    assert "regexp_extract_all(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_script_pages_are_read_once_for_counts_and_completion(spark):
    body = F.concat(
        F.lit('<script type="application/json">{"a":['), *[F.lit(x) for x in (
            '{"precinctsReporting":"1,002","totalPrecincts":9,"Complete":"yes"},',
            '{"isC\\u006fmplete":false},{"reportingcomplete":"1","precinct":"P"},')],
        F.lit('{"precinct":"Q","votes":'), F.col("id"), F.lit("},{}]}</script>"))
    out = R.script_progress(spark.range(1).select(body.alias("body")), "body",
                            R.Context.of("2026", "mi-x", "src", "2026-11-03 00:00:00"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    rows = out.select("kind", "reporting_count", "expected_count", "complete",
                      "reporting_unit_name").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([
        ("source_counts", 1002, 9, None, None), ("source_complete", None, None, True, None),
        ("source_complete", None, None, False, None), ("source_complete", None, None, True, "P")],
        key=repr)


def test_directory_links_shuffle_no_page_text_by_its_columns(spark):
    from pyspark.sql.types import StringType

    page = spark.createDataFrame([(f"https://s.gov/{i}", "SS", "<li>York County <a href='/c'>Go</a></li>")
                                  for i in range(3)], "url string, state string, html string")
    units = spark.createDataFrame([("u0", "SS", "York County", "county")],
                                  "jurisdiction_id string, state string, canonical_name string,"
                                  "jurisdiction_level string")
    out = L.directory_links(page, units)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1  # the links are grouped once, at the end
    assert out.schema["snapshot_sha256"].dataType == StringType()
    assert {(r.match_basis, tuple(r.associated_unit_ids), len(r.snapshot_sha256)) for r in out.collect()} == {
        ("directory_row", ("u0",), 64)}


def test_plain_links_resolve_as_parsed_ones(spark):
    links = [("docs/1.pdf", "https://a.gov/x/y?q", "https://a.gov/x/docs/1.pdf"),
             ("docs/1.pdf", "https://a.gov/./y", "https://a.gov/docs/1.pdf"),
             ("/a.b", "https://a.gov", "https://a.gov/a.b"), ("b", "https://a.gov/c//d/", "https://a.gov/c/d/b"),
             ("https://x.local/a", "https://a.gov/", ""), ("https://a.local.org/a", None, "https://a.local.org/a"),
             ("/a//b", "https://a.gov/", "https://a.gov/a//b"), ("a:b", "https://a.gov/", ""),
             ("/x", "https://u@a.gov/", ""), ("/x\n", "https://a.gov/", "https://a.gov/x")]
    df = spark.createDataFrame(links, "t string, b string, want string")
    out = U.normalize_urls(df, "t", "u", "b")
    assert [(r.t, r.u) for r in out.collect()] == [(t, want) for t, _, want in links]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1


def test_set_pages_are_not_joined_by_their_digests(spark):
    head = '<a href="precinctreport?id=1">p</a><a href="precinctreport?id=2">p</a>Total Precincts: 2'
    row = "<h2>U</h2><table><tr><td class='headertr'>R</td></tr><tr><td>c</td>" + "<td>{}</td>" * 4 + "</tr></table>"
    summaries = spark.createDataFrame([("https://x.org/s/summary", head)], "url string, body string")
    pages = spark.createDataFrame(
        [("https://x.org/s/precinctreport?id=1", t, row.format(v, v, v, v)) for t, v in (
            ("2026-11-03 01:00:00", 1), ("2026-11-03 03:00:00", 3), ("2026-11-03 02:00:00", 2))]
        + [("https://x.org/s/precinctreport?id=2", "2026-11-03 01:00:00", row.format(3, 3, 3, 3))],
        "url string, fetched_at string, body string").withColumn(
        "fetched_at", F.col("fetched_at").cast("timestamp"))
    ctx = R.Context(F.lit("2026"), F.lit("us:mi:county:x"), F.col("set_url"), F.col("fetched_at"),
                    F.lit("certified"), F.sha2("body", 256))
    facts, sets, missing = R.page_set_results(summaries, pages, ctx)
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join " in line and "_digest" in line]
    assert {r.votes for r in facts.collect()} == {3} and not missing.count()
    # Both pages have the same bytes, so one of them counts as parsed.
    assert [tuple(r)[1:5] + (r.complete,) for r in sets.collect()] == [(2, 2, 1, 2, False)]


def test_artifact_kinds_group_the_links_once(spark):
    from tallyweave.plans.web import _VARIANTS

    html = ("<a href='/r.csv'>Official results 1</a><a href='/r.csv'>download</a><a href='d/x.pdf'>Precinct detail</a>"
            "<a href='https://v.org/documentcenter/view/3'>canvass</a><a href='mailto:x'>results</a>")
    pages = spark.createDataFrame([(f"https://a.gov/{i}/", html) for i in range(2)], "url string, html string")
    rows = L.anchors(pages)
    got = L.artifact_kinds(rows, _VARIANTS)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    want = {(r.url, r.link, v, r.kind) for v in _VARIANTS for r in L.artifact_anchors(rows, v).collect()}
    assert {tuple(r) for r in got.select("url", "link", "variant", "kind").collect()} == want and len(want) > 12
