"""Queries that read result files: each order is one captured report of its line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.plans.registry import query
from tallyweave.plans.views import table
from tallyweave.sources import crosscheck as X
from tallyweave.sources import intake as I
from tallyweave.sources import results as R

_L_SQL = """
l AS (SELECT l_orderkey AS k, l_linenumber AS n, 'Order ' || CAST(l_orderkey AS VARCHAR) AS unit, 'Race ' || l_returnflag AS race,
        'Part ' || CAST(l_partkey AS VARCHAR) || ' x' AS choice, CAST(l_quantity AS BIGINT) AS v, l_linestatus AS ls, o_orderpriority AS pr
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def _lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"),
        F.concat(F.lit("Race "), F.col("l_returnflag")).alias("race"),
        F.concat(F.lit("Part "), F.col("l_partkey"), F.lit(" x")).alias("choice"),
        F.col("l_quantity").cast("long").alias("v"), F.col("l_linestatus").alias("ls"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return li.join(o, F.col("k") == F.col("o_orderkey")).withColumn(
        "unit", F.concat(F.lit("Order "), F.col("k"))).drop("o_orderkey")


def _documents(spark, sf_dir, line, before, after):
    """One text per order: the line texts in order between a head and a foot.

    An order has at most a handful of lines, so the list of a group is bounded.
    """
    rows = _lines(spark, sf_dir).select("k", "unit", "n", line.alias("x"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "x"))),
                                    lambda s: s.x), "")
    docs = rows.groupBy("k", "unit").agg(text.alias("t"))
    return docs.select("k", F.concat(before, F.col("t"), after).alias("body"))


def _context():
    return R.Context(F.lit("2026"), F.lit("us:mi:county:x"), F.lit("src"),
                     F.lit("2026-11-03 00:00:00").cast("timestamp"), F.lit("certified"),
                     F.sha2("body", 256))


def _plain():
    return R.Context.of("2026", "mi-x", "src", "2026-11-03 00:00:00")


@query("wide_results", f"""
WITH {_L_SQL},
w AS (SELECT unit, race, choice, n, unnest([{{'m': 'mail', 'raw': 'mail', 'v': v}}, {{'m': 'absentee', 'raw': 'av', 'v': CASE WHEN ls = 'F' THEN v + 1000 END}},
        {{'m': 'unknown', 'raw': 'pre_process_absentee', 'v': NULL}}]) AS x FROM l)
SELECT 'mi-x:' || unit AS reporting_unit_id, race AS contest_name, choice AS choice_name, n AS source_order, x.m AS vote_mode, x.raw AS raw_vote_mode, x.v AS votes
FROM w WHERE x.v IS NOT NULL
""")
def wide_results(spark, sf_dir):
    raw = _lines(spark, sf_dir).select(
        F.lit("").alias("Precinct"), F.col("unit").alias(" Reporting_Unit "),
        F.col("race").alias("Office"), F.col("choice").alias("Candidate"),
        F.col("n").cast("string").alias("Order"), F.col("v").cast("string").alias("Mail"),
        F.when(F.col("ls") == "F", F.format_number(F.col("v") + 1000, 0)).otherwise(" ")
        .alias("AV"), F.lit("n/a").alias("Pre_Process_Absentee"))
    out = R.wide_results(raw, _plain())
    return out.select("reporting_unit_id", "contest_name", "choice_name", "source_order",
                      "vote_mode", "raw_vote_mode", "votes")


@query("nested_json", f"""
WITH {_L_SQL}
SELECT 'us:mi:county:x:election:2026:regime:certified:src:reporting-unit:precinct:k-' || CAST(k AS VARCHAR) AS reporting_unit_id, unit AS reporting_unit_name,
  race AS contest_name, choice AS choice_name, n AS source_order, CASE ls WHEN 'F' THEN 'early' ELSE 'total' END AS vote_mode, v AS votes FROM l
""")
def nested_json(spark, sf_dir):
    choice = F.concat(
        F.lit('{"name":"'), F.col("race"), F.lit('","choices":[{"name":" '), F.col("choice"),
        F.lit('","order":'), F.col("n"), F.lit(',"votes":'), F.col("v"),
        F.when(F.col("ls") == "F", ',"mode":"Early Voting"').otherwise(""), F.lit("}]},"))
    docs = _documents(
        spark, sf_dir, choice,
        F.concat(F.lit('{"reporting_units":[{"id":"k_'), F.col("k"), F.lit('","name":"'),
                 F.col("unit"), F.lit('","contests":[')), F.lit('{"name":""}]}]}'))
    out = R.nested_json(docs, "body", _context())
    return out.select("reporting_unit_id", "reporting_unit_name", "contest_name", "choice_name",
                      "source_order", "vote_mode", "votes")


@query("nested_xml", f"""
WITH {_L_SQL}
SELECT unit AS reporting_unit_name, race AS contest_name, choice AS choice_name, n AS source_order, 'P' || CAST(n AS VARCHAR) AS party,
  CASE ls WHEN 'F' THEN 'provisional' ELSE 'total' END AS vote_mode, v + 2000 AS votes FROM l
""")
def nested_xml(spark, sf_dir):
    contest = F.concat(
        F.lit("<Contest><Name>"), F.col("race"), F.lit('</Name><Choice name="'), F.col("choice"),
        F.lit('" Order="'), F.col("n"), F.lit('"><Party>P'), F.col("n"),
        F.lit("</Party><Total "), F.when(F.col("ls") == "F", 'Mode="Provisional" ').otherwise(""),
        F.lit('votes="'), F.format_number(F.col("v") + 2000, 0), F.lit('"/></Choice></Contest>'))
    docs = _documents(
        spark, sf_dir, contest,
        F.concat(F.lit('<?xml version="1.0"?><R><G><Precinct id="k'), F.col("k"),
                 F.lit('" name="'), F.col("unit"), F.lit('">')), F.lit("</Precinct></G></R>"))
    out = R.nested_xml(docs, "body", _context())
    return out.select("reporting_unit_name", "contest_name", "choice_name", "source_order",
                      "party", "vote_mode", "votes")


def _script_pages(spark, sf_dir):
    item = F.concat(
        F.lit('{"precinctName":"'), F.col("unit"), F.lit('","Office":"'), F.col("race"),
        F.lit('","candidate":"'), F.col("choice"), F.lit(' '), F.col("n"),
        F.lit('","Early":"'), F.col("v"), F.lit('","total":'), F.col("v") + 1, F.lit("},"))
    return _documents(
        spark, sf_dir, item,
        F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"a":{"b":['
                       '{"precinctsReporting":'), F.col("k") % 9,
                 F.lit(',"totalPrecincts":"9","isCumulative":true,"complete":'),
                 F.when(F.col("k") % 9 == 0, '"yes"').otherwise("false"), F.lit("},")),
        F.lit("{}]}}</script></html>"))


@query("script_results", f"""
WITH {_L_SQL}
SELECT unit AS reporting_unit_name, race AS contest_name, choice || ' ' || CAST(n AS VARCHAR) AS choice_name, 'early' AS vote_mode, v AS votes FROM l
UNION ALL SELECT unit, race, choice || ' ' || CAST(n AS VARCHAR), 'total', v + 1 FROM l
""")
def script_results(spark, sf_dir):
    out = R.script_results(_script_pages(spark, sf_dir), "body", _context())
    return out.select("reporting_unit_name", "contest_name", "choice_name", "vote_mode", "votes")


@query("script_progress", f"""
WITH {_L_SQL}, d AS (SELECT DISTINCT k FROM l)
SELECT 'source_counts' AS kind, k % 9 AS reporting_count, 9 AS expected_count, CAST(NULL AS BOOLEAN) AS complete, 'cumulative' AS update_semantics, count(*) AS captures
FROM d GROUP BY ALL
UNION ALL SELECT 'source_complete', NULL, NULL, k % 9 = 0, 'cumulative', count(*) FROM d GROUP BY ALL
""")
def script_progress(spark, sf_dir):
    out = R.script_progress(_script_pages(spark, sf_dir), "body", _context())
    return out.groupBy("kind", "reporting_count", "expected_count", "complete",
                       "update_semantics").agg(F.count(F.lit(1)).alias("captures"))


@query("mode_tables", f"""
WITH {_L_SQL}
SELECT k, race AS contest_name, choice AS choice_name, 'early' AS vote_mode, v AS votes FROM l
UNION ALL SELECT k, race, choice, 'total', v + 1500 FROM l WHERE ls = 'F'
""")
def mode_tables(spark, sf_dir):
    rows = F.concat(
        F.lit('<table data-contest="'), F.col("race"),
        F.lit('"><tr><th>Name</th><th>Early Voting</th><th>Pct</th><th>Total Votes</th></tr><tr>'
              "<td>"), F.col("choice"), F.lit("</td><td>"), F.col("v"),
        F.lit("</td><td>5%</td><td>"),
        F.when(F.col("ls") == "F", F.format_number(F.col("v") + 1500, 0)).otherwise("none"),
        F.lit("</td></tr></table>"))
    docs = _documents(spark, sf_dir, rows, F.lit("<html>"), F.lit("</html>"))
    out = R.mode_tables(docs, "body", _plain(), unit=F.col("k").cast("string"))
    return out.select(F.col("reporting_unit_name").cast("long").alias("k"), "contest_name",
                      "choice_name", "vote_mode", "votes")


@query("heading_pages", f"""
WITH {_L_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY k, n ORDER BY n) AS o FROM l)
SELECT unit AS reporting_unit_name, race || ' District ' || CAST(n AS VARCHAR) AS contest_name, choice AS choice_name, 1 AS source_order,
  m.m AS vote_mode, v * m.f AS votes, CAST(k * 3 AS BIGINT) AS registered_voters
FROM r, (VALUES ('early', 1), ('absentee', 2), ('election_day', 3), ('total', 6)) m(m, f)
""")
def heading_pages(spark, sf_dir):
    row = F.concat(
        F.lit('<tr><td class="headertr">'), F.col("race"), F.lit(" District "), F.col("n"),
        F.lit("</td><td>detail</td></tr><tr><td>"), F.col("choice"), F.lit("</td><td>"),
        F.col("v"), F.lit("</td><td>"), F.col("v") * 2, F.lit("</td><td>"), F.col("v") * 3,
        F.lit("</td><td>"), F.col("v") * 6, F.lit("</td></tr>"))
    docs = _documents(
        spark, sf_dir, row,
        F.concat(F.lit("<h1>Election Night</h1><h2>"), F.col("unit"),
                 F.lit("</h2><p>Registered Voters: "), F.format_number(F.col("k") * 3, 0),
                 F.lit("</p><table><tr><td>Summary</td></tr>")), F.lit("</table>"))
    out = R.heading_page(docs, "body", _context())
    return out.select("reporting_unit_name", "contest_name", "choice_name", "source_order",
                      "vote_mode", "votes", "registered_voters")


@query("line_reports", f"""
WITH {_L_SQL},
f AS (SELECT k, min(n) AS fn FROM l GROUP BY ALL),
r AS (SELECT l.*, ls = 'F' OR n = fn AS head, row_number() OVER (PARTITION BY k ORDER BY n, choice, race, v, ls) AS rn FROM l JOIN f USING (k)),
g AS (SELECT *, sum(head::INT) OVER (PARTITION BY k ORDER BY rn) AS grp FROM r)
SELECT unit AS reporting_unit_name, first_value(race) OVER w || ' Member ' || CAST(first_value(n) OVER w AS VARCHAR) || ' seat' AS contest_name,
  choice AS choice_name, row_number() OVER w AS source_order, v + 3000 AS votes, CAST(k AS BIGINT) AS registered_voters FROM g
WINDOW w AS (PARTITION BY k, grp ORDER BY rn)
""")
def line_reports(spark, sf_dir):
    # A contest line is written for every line item of status F and for the first of an order.
    rows = _lines(spark, sf_dir)
    first = rows.groupBy("k").agg(F.min("n").alias("_first"))
    rows = rows.join(first, "k")
    line = F.concat(
        F.when((F.col("ls") == "F") | (F.col("n") == F.col("_first")), F.concat(
            F.lit("\n"), F.col("race"), F.lit(" Member  "), F.col("n"), F.lit(" seat")))
        .otherwise(""),
        F.lit("\n  "), F.col("choice"), F.lit("   "), F.format_number(F.col("v") + 3000, 0),
        F.lit("\nTotal Votes 99\nOvervotes 1\n"))
    entry = F.struct("n", "choice", "race", "v", "ls", line.alias("x"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda s: s.x), "")
    docs = rows.groupBy("k", "unit").agg(text.alias("t")).select("k", F.concat(
        F.lit("Report\n\nPrecinct: "), F.col("unit"), F.lit("\r\nRegistered Voters "),
        F.col("k"), F.col("t")).alias("body"))
    out = R.line_report(docs, "body", _context())
    return out.select("reporting_unit_name", "contest_name", "choice_name",
                      F.col("source_order").cast("long").alias("source_order"), "votes",
                      "registered_voters")


@query("detail_tables", f"""
WITH {_L_SQL}
SELECT unit AS reporting_unit_name, race AS contest_name, choice AS choice_name, v + 4000 AS votes FROM l
""")
def detail_tables(spark, sf_dir):
    row = F.concat(
        F.lit("<tr><th>"), F.col("race"), F.lit("</th></tr><tr><td>"), F.col("choice"),
        F.lit("</td><td>x</td><td>"), F.format_number(F.col("v") + 4000, 0),
        F.lit("</td></tr>"))
    docs = _documents(
        spark, sf_dir, row, F.concat(F.lit("<table><tr><td>Precinct</td><td>"), F.col("unit"),
                                     F.lit("</td></tr>")), F.lit("</table>"))
    out = R.detail_table(docs, "body", _context())
    return out.select("reporting_unit_name", "contest_name", "choice_name", "votes")


@query("page_progress", f"""
WITH {_L_SQL}, d AS (SELECT unit, bool_or(ls = 'F') AS seen FROM l GROUP BY ALL)
SELECT unit AS reporting_unit_name, 'unit_exists' AS kind, true AS reported FROM d
UNION ALL SELECT unit, 'unit_reported', seen FROM d
""")
def page_progress(spark, sf_dir):
    row = F.when(F.col("ls") == "F", F.concat(
        F.lit("<tr><td>"), F.col("choice"),
        F.lit("</td><td>1</td><td>1</td><td>1</td><td>3</td></tr>"))).otherwise(
        F.lit("<tr><td>x</td></tr>"))
    docs = _documents(spark, sf_dir, row, F.concat(F.lit("<h1>"), F.col("unit"),
                                                   F.lit("</h1><table>")), F.lit("</table>"))
    return R.page_progress(docs, "body", _context()).select("reporting_unit_name", "kind",
                                                            "reported")


@query("summary_pages", f"""
WITH {_L_SQL}
SELECT k, string_agg(DISTINCT 'https://x.example.org/s/precinctreport?id=' || CAST(n AS VARCHAR), '|' ORDER BY 'https://x.example.org/s/precinctreport?id=' || CAST(n AS VARCHAR)) AS precinct_urls,
  k * 7 AS precincts_total, k AS precincts_counted, epoch_us(TIMESTAMP '2026-08-04 21:15:30') AS source_timestamp FROM l GROUP BY ALL
""")
def summary_pages(spark, sf_dir):
    row = F.concat(F.lit('<a href="precinctreport?id='), F.col("n"), F.lit('">p</a>'))
    docs = _documents(
        spark, sf_dir, row,
        F.concat(F.lit("<p>Total Precincts: "), F.format_number(F.col("k") * 7, 0),
                 F.lit("</p><p>Fully Counted Precincts "), F.col("k"),
                 F.lit("</p><p>This report created: Tuesday, August 4, 2026 9:15:30 PM "
                       "Registered Voters: 5</p>")), F.lit(""))
    docs = docs.withColumn("url", F.lit("https://x.example.org/s/summary"))
    out = R.summary_page(docs, "url", "body")
    return out.select("k", F.array_join("precinct_urls", "|").alias("precinct_urls"),
                      "precincts_total", "precincts_counted",
                      F.unix_micros("source_timestamp").alias("source_timestamp"))


@query("report_profiles", f"""
WITH {_L_SQL}
SELECT k, CASE WHEN k % 2 = 0 THEN 'election_summary_report' ELSE 'statement_of_votes_cast' END AS family, k % 50 AS precincts_reported, 50 AS precincts_total,
  k % 3 = 0 AS has_turnout, 'mail|election day' AS vote_modes FROM (SELECT DISTINCT k FROM l) WHERE k % 5 > 0
""")
def report_profiles(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).join(
        _lines(spark, sf_dir).select("k").distinct(), "k")
    name = (F.when(F.col("k") % 5 == 0, "Other").when(F.col("k") % 2 == 0,
                                                      "Election  Summary Report")
            .otherwise("STATEMENT OF VOTES CAST"))
    docs = docs.select("k", F.concat(
        name, F.lit("\nPrecincts Reported: "), F.col("k") % 50, F.lit(" of 50\nMail, Election "
                                                                      "Day and MAIL\n"),
        F.when(F.col("k") % 3 == 0, "Turnout").otherwise("")).alias("t"))
    out = R.report_profile(docs, "t")
    return out.withColumn("vote_modes", F.array_join("vote_modes", "|"))


@query("payload_kinds", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'json' WHEN '2-HIGH' THEN 'xml' WHEN '3-MEDIUM' THEN 'csv'
  WHEN '5-LOW' THEN 'excel' ELSE 'unknown' END AS kind FROM orders
""")
def payload_kinds(spark, sf_dir):
    p = F.col("o_orderpriority")
    body = (F.when(p == "1-URGENT", F.to_binary(F.lit("  [1]"), F.lit("utf-8")))
            .when(p == "2-HIGH", F.to_binary(F.lit("<?xml?>"), F.lit("utf-8")))
            .when(p == "3-MEDIUM", F.to_binary(F.lit("a,b,c\n1"), F.lit("utf-8")))
            .when(p == "5-LOW", F.unhex(F.lit("504B030414")))
            .otherwise(F.to_binary(F.lit("a b"), F.lit("utf-8"))))
    return table(spark, sf_dir, "orders").select("o_orderkey", R.payload_kind(body).alias("kind"))


@query("district_sums", """
SELECT CAST(o_custkey % 25 AS VARCHAR) AS county_code, CAST(o_orderkey AS VARCHAR) AS candidate, CAST(o_orderkey % 7 * 8 + 28 AS BIGINT) AS district_sum FROM orders
""")
def district_sums(spark, sf_dir):
    k = F.col("o_orderkey")
    cols = [F.format_number(k % 7 + i, 0).alias(f"Congressional District {i + 1} ")
            for i in range(8)]
    raw = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 25).cast("string").alias("County"),
        F.lit("x").alias("County Name"), F.lit("Governor").alias("Office Name"),
        F.lit("").alias("Office District"), k.cast("string").alias("Candidate Name"),
        F.lit("DEM").alias("Party"), *cols)
    rows, _ = R.district_csv(raw)
    return rows.select("county_code", "candidate", "district_sum")


@query("district_violations", """
SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'invalid_count' END AS rule_id FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_custkey, 'duplicate_key' FROM orders GROUP BY o_custkey HAVING count(*) > 1
""")
def district_violations(spark, sf_dir):
    cols = [F.when(F.col("o_orderstatus") == "P", "1,00").otherwise("100")
            .alias(f"Congressional District {i + 1}") for i in range(8)]
    raw = table(spark, sf_dir, "orders").select(
        F.lit("1").alias("County"), F.lit("x").alias("County Name"),
        F.lit("Governor").alias("Office Name"), F.lit("").alias("Office District"),
        F.col("o_custkey").cast("string").alias("Candidate Name"), F.lit("DEM").alias("Party"),
        *cols)
    return R.district_csv(raw)[1].select(
        F.col("`Candidate Name`").cast("long").alias("o_custkey"), "rule_id")


@query("statewide_tables", f"""
WITH {_L_SQL},
t AS (SELECT DISTINCT k FROM l)
SELECT k, 'ok' AS rule_id, choice || ' ' || CAST(n AS VARCHAR) AS candidate, v * 4 + 6 AS total FROM l
UNION ALL SELECT k, 'candidate_sums_differ', NULL, NULL FROM t WHERE k % 10 = 0
UNION ALL SELECT k, 'duplicate_candidate', NULL, NULL FROM l GROUP BY k, choice, n HAVING count(*) > 1
""")
def statewide_tables(spark, sf_dir):
    v = F.col("v")
    cells = lambda name, parts: F.concat(
        F.lit("<tr>"), *[F.concat(F.lit("<td>"), p, F.lit("</td>")) for p in (name, *parts)],
        F.lit("</tr>"))
    rows = _lines(spark, sf_dir)
    line = cells(F.concat(F.col("choice"), F.lit(" "), F.col("n")),
                 [F.lit("DEM"), v.cast("string"), (v + 1).cast("string"), (v + 2).cast("string"),
                  (v + 3).cast("string"), (v * 4 + 6).cast("string"), F.lit("5%")])
    grouped = rows.select("k", "n", "v", line.alias("x")).groupBy("k").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "x"))),
                                 lambda s: s.x), "").alias("t"),
        F.sum("v").alias("s"), F.count(F.lit(1)).alias("c"))
    head = cells(F.lit("Name"), [F.lit(h) for h in R.STATEWIDE_HEADER[1:]])
    extra = F.when(F.col("k") % 10 == 0, 1).otherwise(0)
    sums = [F.col("s") + F.col("c") * i + (extra if i == 0 else 0) for i in range(4)]
    total = cells(F.lit("Totals"), [F.lit(""), *[x.cast("string") for x in sums],
                                    (sums[0] + sums[1] + sums[2] + sums[3]).cast("string"),
                                    F.lit("100%")])
    docs = grouped.select("k", F.concat(F.lit("<table>"), head, F.col("t"), total,
                                        F.lit("</table>")).alias("body"))
    good, bad = R.statewide_tables(docs, ["k"], "body")
    return good.select("k", F.lit("ok").alias("rule_id"), "candidate", "total").unionByName(
        bad.select("k", "rule_id", F.lit(None).cast("string").alias("candidate"),
                   F.lit(None).cast("long").alias("total")))


#: Orders of the three headers; the columns of a capture follow the one its order key picks.
_HEADERS = [["Precinct", "Office", "Candidate", "Order", "Mail", "AV"],
            ["AV ", " candidate", "RACE", "mail", "Polling_Place", "position"],
            ["party", "Choice", "Votes", "Absentee", "Contest_Name", "reporting_unit"]]


def _csv_captures(spark, sf_dir):
    """One CSV body per order in one of three column orders, with quoted fields of commas, quotes
    and line ends; lines of parts divisible by 5 have a field too many, by 7 one too few."""
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    choice = quoted(F.concat(F.col("choice"), F.lit(', ""jr""\nof '), F.col("n")))
    v, n = F.col("v").cast("string"), F.col("n").cast("string")
    av = F.when(F.col("ls") == "F", quoted(F.format_number(F.col("v") + 1000, 0))).otherwise("")
    unit, race = quoted(F.col("unit")), F.col("race")
    orders = [[unit, race, choice, n, v, av], [av, choice, race, v, unit, n],
              [F.lit(""), choice, v, av, race, unit]]
    own = F.col("k") % 3
    line = F.lit(None).cast("string")
    for i, columns in enumerate(orders):
        part = F.regexp_extract("choice", r"(\d+)", 1).cast("long")
        short = F.concat_ws(",", *columns[:-1])
        full = F.concat_ws(",", *columns)
        line = F.when(own == i, F.when(part % 5 == 0, F.concat(full, F.lit(",more"))).when(
            part % 7 == 0, short).otherwise(full)).otherwise(line)
    head = F.element_at(F.array(*[F.lit(",".join(h)) for h in _HEADERS]), (own + 1).cast("int"))
    docs = _documents(spark, sf_dir, F.concat(line, F.lit("\r\n")),
                      F.concat(F.lit("\ufeff"), head, F.lit("\n\n")), F.lit(""))
    return docs.withColumn("body", F.col("body").cast("binary"))


_CSV_SQL = f"""{_L_SQL},
c AS (SELECT *, k % 3 AS h, CAST(regexp_extract(choice, '[0-9]+') AS BIGINT) AS part FROM l)
"""


@query("mixed_header_csv", f"""
WITH {_CSV_SQL},
w AS (SELECT *, part % 7 = 0 AS short, unnest([{{'m': 'mail', 'raw': 'mail', 'v': CASE WHEN h < 2 THEN v END}},
        {{'m': 'absentee', 'raw': 'av', 'v': CASE WHEN h < 2 AND ls = 'F' THEN v + 1000 END}},
        {{'m': 'absentee', 'raw': 'absentee', 'v': CASE WHEN h = 2 AND ls = 'F' THEN v + 1000 END}},
        {{'m': 'total', 'raw': 'votes', 'v': CASE WHEN h = 2 THEN v END}}]) AS x FROM c WHERE part % 5 > 0)
SELECT 'mi-x:' || unit AS reporting_unit_id, race AS contest_name, choice || ', "jr"' || chr(10) || 'of ' || CAST(n AS VARCHAR) AS choice_name,
  CASE WHEN h = 0 OR (h = 1 AND NOT short) THEN n END AS source_order, x.m AS vote_mode, x.raw AS raw_vote_mode, x.v AS votes
FROM w WHERE x.v IS NOT NULL AND NOT (short AND (h = 2 OR (h = 0 AND x.raw = 'av')))
""")
def mixed_header_csv(spark, sf_dir):
    facts, _ = I.csv_results(_csv_captures(spark, sf_dir), "body", _plain(), ["k"])
    return facts.select("reporting_unit_id", "contest_name", "choice_name", "source_order",
                        "vote_mode", "raw_vote_mode", "votes")


@query("ragged_csv_rows", f"""
WITH {_CSV_SQL}
SELECT k, CASE WHEN part % 5 = 0 THEN 'wide_row' ELSE 'narrow_row' END AS rule_id, CASE WHEN part % 5 = 0 THEN 7 ELSE 5 END AS n_fields,
  6 AS n_columns, count(*) AS n_rows FROM c WHERE part % 5 = 0 OR part % 7 = 0 GROUP BY ALL
""")
def ragged_csv_rows(spark, sf_dir):
    _, ragged = I.csv_results(_csv_captures(spark, sf_dir), "body", _plain(), ["k"])
    return ragged.groupBy("k", "rule_id", "n_fields", "n_columns").agg(
        F.count(F.lit(1)).alias("n_rows"))


def _judged(spark, sf_dir):
    """Each order as a capture: JSON where the customer is divisible by 4, else CSV.

    Orders divisible by 13 lack the marker, by 17 have a count that is no number, by 19 name each line
    twice; lines of 5 units count below zero.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"),
        F.col("l_quantity").cast("long").alias("v"))
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 4 == 0).alias("json"))
    votes = F.when(F.col("k") % 17 == 0, "1.5").when(F.col("v") == 5, "-5").otherwise(
        F.col("v").cast("string"))
    csv = F.concat(F.lit("u,r,c"), F.col("n"), F.lit(","), votes, F.lit("\n"))
    obj = F.concat(F.lit('{"name":"c'), F.col("n"), F.lit('","votes":'), votes, F.lit("},"))
    line = F.when(F.col("json"), obj).otherwise(csv)
    line = F.when(F.col("k") % 19 == 0, F.concat(line, line)).otherwise(line)
    rows = o.join(li, "k", "left").select(
        "k", "json", F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias(
            "v"), F.coalesce(line, F.lit("")).alias("x")).alias("e"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda s: s.x), "")
    docs = rows.groupBy("k", "json").agg(text.alias("t"))
    mark = F.when(F.col("k") % 13 > 0, "official").otherwise("other")
    body = F.when(F.col("json"), F.concat(
        F.lit('{"mark":"'), mark, F.lit('","reporting_units":[{"name":"u","contests":[{"name":"r",'
                                        '"choices":['),
        F.regexp_replace("t", ",$", ""), F.lit("]}]}]}"))).otherwise(F.concat(
            F.lit("precinct,race,candidate,total,"), mark, F.lit("\n"), F.col("t")))
    return docs.select(F.concat(F.lit("s"), F.col("k")).alias("source_id"),
                       F.when(F.col("json"), "json").otherwise("csv").alias("parser"),
                       F.lit("official").alias("required_text"),
                       body.cast("binary").alias("body"))


def _judge_context():
    return R.Context(F.lit("2026"), F.lit("us:mi:county:x"), F.col("source_id"),
                     F.lit("2026-11-03 00:00:00").cast("timestamp"), F.lit("certified"),
                     F.sha2("body", 256))


_JUDGED_SQL = """
o AS (SELECT o_orderkey AS k, o_custkey % 4 = 0 AS json FROM orders),
l AS (SELECT k, json, l_linenumber AS n, CAST(l_quantity AS BIGINT) AS v, k % 17 = 0 AS bad, CASE WHEN k % 19 = 0 THEN 2 ELSE 1 END AS c
      FROM lineitem JOIN o ON l_orderkey = k),
e AS (SELECT k, n, sum(c) AS c, sum(c) FILTER (v = 5) AS neg FROM l WHERE NOT bad GROUP BY ALL),
f AS (SELECT k, 'votes_not_integer' AS rule_id, CASE WHEN any_value(json) THEN 1 ELSE sum(c) END AS findings FROM l WHERE bad GROUP BY k
  UNION ALL SELECT k, 'marker_absent', 1 FROM o WHERE k % 13 = 0
  UNION ALL SELECT k, 'no_rows', 1 FROM o WHERE k NOT IN (SELECT k FROM e)
  UNION ALL SELECT k, 'duplicate_observation', count(*) FROM e WHERE c > 1 GROUP BY k
  UNION ALL SELECT k, 'negative_votes', sum(neg) FROM e WHERE neg > 0 GROUP BY k)
"""


@query("capture_findings", f"""
WITH {_JUDGED_SQL}
SELECT 's' || CAST(k AS VARCHAR) AS source_id, rule_id, CAST(findings AS BIGINT) AS findings FROM f
""")
def capture_findings(spark, sf_dir):
    return I.judge_captures(_judged(spark, sf_dir), _judge_context())[1]


@query("accepted_captures", f"""
WITH {_JUDGED_SQL}
SELECT 's' || CAST(k AS VARCHAR) AS source_id, 'c' || CAST(n AS VARCHAR) AS choice_name, v AS votes FROM l WHERE k NOT IN (SELECT k FROM f)
""")
def accepted_captures(spark, sf_dir):
    return I.judge_captures(_judged(spark, sf_dir), _judge_context())[0].select(
        "source_id", "choice_name", "votes")


_SET_SQL = """
l AS (SELECT l_orderkey AS k, l_linenumber AS n, min(CAST(l_quantity AS BIGINT)) AS v, min(l_returnflag) AS f FROM lineitem GROUP BY ALL)
"""


def _page_sets(spark, sf_dir):
    """Each order is a summary, each of its lines a page of it. Pages of flag R were never captured,
    those of flag N twice, the first time with other counts; pages of 7 units have no rows."""
    li = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(
        F.min(F.col("l_quantity").cast("long")).alias("v"), F.min("l_returnflag").alias("f"))
    at = F.concat(F.lit("https://x.example.org/s/"), F.col("k"))
    name = F.concat_ws("-", "k", "n")
    link = F.concat(F.lit('<a href="precinctreport?id='), name, F.lit('">p</a>'))
    docs = li.groupBy("k").agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("t"),
                               F.count(F.lit(1)).alias("c"))
    summaries = docs.select(F.concat(at, F.lit("/summary")).alias("url"), F.concat(
        F.lit("<p>Total Precincts: "), F.col("c"), F.lit("</p>"), F.col("t")).alias("body"))

    def page(v, time):
        row = F.concat(F.lit('<tr><td class="headertr">Race</td><td>d</td></tr><tr><td>c</td><td>'), v,
                       F.lit("</td><td>"), v * 2, F.lit("</td><td>"), v * 3, F.lit("</td><td>"),
                       v * 6, F.lit("</td></tr>"))
        return F.struct(F.lit(time).cast("timestamp").alias("fetched_at"), F.concat(
            F.lit("<h2>Unit "), name, F.lit("</h2><table>"),
            F.when(F.col("v") != 7, row).otherwise(""), F.lit("</table>")).alias("body"))

    second = page(F.col("v"), "2026-11-03 02:00:00")
    captures = F.when(F.col("f") == "N", F.array(second, page(F.col("v") + 1, "2026-11-03 01:00:00"))
                      ).when(F.col("f") == "A", F.array(second))
    pages = li.select(F.concat(at, F.lit("/precinctreport?id="), name).alias("url"),
                      F.inline(captures))
    ctx = R.Context(F.lit("2026"), F.lit("us:mi:county:x"), F.col("set_url"), F.col("fetched_at"),
                    F.lit("certified"), F.sha2("body", 256))
    return R.page_set_results(summaries, pages, ctx)


@query("page_set_results", f"""
WITH {_SET_SQL}
SELECT 'https://x.example.org/s/' || CAST(k AS VARCHAR) || '/summary' AS set_url, 'Unit ' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS unit,
  m.m AS vote_mode, v * m.f AS votes FROM l, (VALUES ('early', 1), ('absentee', 2), ('election_day', 3), ('total', 6)) m(m, f)
WHERE l.f <> 'R' AND v <> 7
""")
def page_set_results(spark, sf_dir):
    return _page_sets(spark, sf_dir)[0].select(
        F.col("source_id").alias("set_url"), F.col("reporting_unit_name").alias("unit"),
        "vote_mode", "votes")


@query("page_sets", f"""
WITH {_SET_SQL}
SELECT 'https://x.example.org/s/' || CAST(k AS VARCHAR) || '/summary' AS set_url, count(*) AS linked_pages, count(*) FILTER (f <> 'R') AS captured_pages,
  count(*) FILTER (f <> 'R' AND v <> 7) AS parsed_pages, count(*) AS precincts_total, bool_and(f <> 'R' AND v <> 7) AS complete FROM l GROUP BY ALL
""")
def page_sets(spark, sf_dir):
    return _page_sets(spark, sf_dir)[1].select(
        "set_url", "linked_pages", "captured_pages", "parsed_pages", "precincts_total", "complete")


@query("missing_set_pages", f"""
WITH {_SET_SQL}
SELECT 'https://x.example.org/s/' || CAST(k AS VARCHAR) || '/summary' AS set_url,
  'https://x.example.org/s/' || CAST(k AS VARCHAR) || '/precinctreport?id=' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS url FROM l WHERE f = 'R'
""")
def missing_set_pages(spark, sf_dir):
    return _page_sets(spark, sf_dir)[2]


@query("payload_crosscheck", """
WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, min(CAST(l_quantity AS BIGINT)) AS v FROM lineitem GROUP BY ALL),
s AS (SELECT k, CASE WHEN k % 11 = 0 THEN 'duplicate_candidate' WHEN k % 7 = 0 THEN 'candidate_context_mismatch' WHEN k % 5 = 0 THEN 'totals_disagree' ELSE 'crosschecked' END AS status,
  count(*) FILTER (NOT (n = 1 AND (k % 7 = 0 OR k % 5 = 0))) AS matched_keys, CAST(coalesce(sum(4 * v + 6) FILTER (NOT (n = 1 AND (k % 7 = 0 OR k % 5 = 0))), 0) AS BIGINT) AS matched_votes
  FROM l GROUP BY ALL)
SELECT k, status, CASE WHEN status <> 'duplicate_candidate' THEN matched_keys END AS matched_keys, CASE WHEN status <> 'duplicate_candidate' THEN matched_votes END AS matched_votes
FROM s WHERE k IN (SELECT k FROM l WHERE n = 1)
""")
def payload_crosscheck(spark, sf_dir):
    """Each order with a first line is a state: its lines as a table page and as a district file.

    The file lacks the first candidate where 7 divides the order, has one vote more where 5 does, and names
    it twice, in two districts, where 11 does.
    """
    li = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(
        F.min(F.col("l_quantity").cast("long")).alias("v"))
    k, n, v = F.col("k"), F.col("n"), F.col("v")
    cells = lambda parts: F.concat(F.lit("<tr>"), *[
        F.concat(F.lit("<td>"), x, F.lit("</td>")) for x in parts], F.lit("</tr>"))
    name = F.concat(F.lit("c"), n)
    line = cells([name, F.lit("Democratic"), *[(v + i).cast("string") for i in range(4)],
                  (4 * v + 6).cast("string"), F.lit("5%")])
    counts = F.concat_ws(",", *[F.lit("0")] * 6, (4 * v).cast("string"), F.when(
        (n == 1) & (k % 5 == 0), "7").otherwise("6"))
    row = lambda county, district: F.concat(
        F.lit(f"{county},All,Governor / Lt. Governor,{district},"), name, F.lit(",DEM,"), counts,
        F.lit("\n"))
    files = F.when((n == 1) & (k % 7 == 0) & (k % 11 > 0), "").when(
        (n == 1) & (k % 11 == 0), F.concat(row("00", ""), row("00", "1"))).otherwise(
        F.concat(row("00", ""), row("01", "")))
    own = li.groupBy("k").agg(
        F.array_sort(F.collect_list(F.struct("n", line.alias("t"), files.alias("f")))).alias("x"),
        F.sum("v").alias("s"), F.count(F.lit(1)).alias("c"), F.min("n").alias("first"))
    own = own.filter("first = 1")
    head = cells([F.lit(h) for h in R.STATEWIDE_HEADER])
    total = cells([F.lit("Totals"), F.lit(""),
                   *[(F.col("s") + F.col("c") * i).cast("string") for i in range(4)],
                   (F.col("s") * 4 + F.col("c") * 6).cast("string"), F.lit("100%")])
    pages = own.select("k", F.concat(F.lit("<table>"), head, F.array_join(F.col("x")["t"], ""),
                                     total, F.lit("</table>")).alias("body"))
    columns = ["County", "County Name", "Office Name", "Office District", "Candidate Name", "Party",
               *R.DISTRICTS]
    csvs = own.select("k", F.concat(F.lit(",".join(c + " " for c in columns) + "\n"),
                                    F.array_join(F.col("x")["f"], "")).alias("body"))
    out = X.payload_crosscheck(pages, csvs, "k", "Governor / Lt. Governor", "Democratic", "DEM")
    clear = F.col("status") != "duplicate_candidate"
    return out.select("k", "status", *[F.when(clear, F.col(c)).alias(c)
                                       for c in ("matched_keys", "matched_votes")])
