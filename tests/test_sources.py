"""Readers, sinks, page fixtures and streams on small files."""

import datetime as dt

from pyspark.sql import functions as F

from tallyweave.operators import links as L
from tallyweave.sources import captures as S, registry as G, results as R
from tallyweave.streaming import feeds

DIRECTORY = """<html><head><title>Directory</title><base href="https://s.gov/list/"></head><body>
<a href="york">York County Clerk</a><a href="ny">New York County board</a>
<table><tr><td>Kent County</td><td><a href="https://kent.example.org/">Website</a></td></tr></table>
<details><summary>Lake County</summary><a href="/lake/elections">Go</a></details>
<dl><dt>Ford County</dt><dd><a href="/ford.pdf">Go</a></dd></dl>
<a href="https://facebook.com/york">York County</a><a href="#top">York County</a></body></html>"""


def units(spark):
    names = ["York County", "New York County", "Kent County", "Lake County", "Ford County"]
    return spark.createDataFrame([(f"u{i}", "SS", n, "county") for i, n in enumerate(names)],
                                 "jurisdiction_id string, state string, canonical_name string,"
                                 "jurisdiction_level string")


def test_directory_contexts(spark):
    page = spark.createDataFrame([("https://s.gov/dir", "SS", DIRECTORY)],
                                 "url string, state string, html string")
    links = L.directory_links(page, units(spark))
    got = {(r.url, tuple(r.associated_unit_ids), r.match_status, r.match_basis)
           for r in links.collect()}
    assert got == {
        ("https://s.gov/list/york", ("u0",), "unit_label_candidate", "anchor_label"),
        ("https://s.gov/list/ny", ("u1",), "unit_label_candidate", "anchor_label"),
        ("https://kent.example.org/", ("u2",), "unit_label_candidate", "directory_row"),
        ("https://s.gov/lake/elections", ("u3",), "unit_label_candidate", "details_summary"),
        ("https://s.gov/ford.pdf", ("u4",), "artifact_lead", "definition_term"),
        ("https://s.gov/list/", ("u0",), "directory_anchor", "anchor_label")}
    left = {r.jurisdiction_id for r in L.unresolved_units(units(spark), links).collect()}
    assert left == {"u1", "u3", "u4"}


NESTED = """<html><head><title>Directory</title></head><body><table><tr><td>
<ul><li>Kent County <ul><li><a href="/inner-elections">Go</a></li></ul> <a href="/outer">Go</a>
<li>Lake County <a href="/lake">Go</a></ul>
<dl><dt>Ford County<dt>York County</dt><dd><dl><dd><a href="/deep/clerk">Go</a></dd></dl><a href="/york">Go</a>
</dd></dl></td></tr></table><details><summary>Kent County</summary><details><p><a href="/none-board">Go</a>
</p></details><a href="/kent">Go</a></details></body></html>"""


def test_nearest_parents(spark):
    page = spark.createDataFrame([("https://s.gov/dir", "SS", NESTED)],
                                 "url string, state string, html string")
    got = {(r.url, tuple(r.associated_unit_ids), r.match_basis)
           for r in L.directory_links(page, units(spark)).collect()}
    site = "https://s.gov"
    assert got == {
        (f"{site}/inner-elections", (), "authority_keyword"),
        (f"{site}/outer", ("u2", "u3"), "directory_row"),
        (f"{site}/lake", ("u3",), "directory_row"),
        (f"{site}/deep/clerk", ("u0", "u2", "u3", "u4"), "directory_row"),
        (f"{site}/york", ("u0", "u2", "u3", "u4"), "directory_row"),
        (f"{site}/none-board", (), "authority_keyword"), (f"{site}/kent", ("u2",), "details_summary")}
    plain = page.withColumn("html", F.regexp_replace("html", "</?t(able|r|d)>", ""))
    got = {(r.url, tuple(r.associated_unit_ids), r.match_basis)
           for r in L.directory_links(plain, units(spark)).collect()}
    assert (f"{site}/york", ("u0",), "definition_term") in got
    assert (f"{site}/deep/clerk", (), "authority_keyword") in got


def test_discovery_target_kinds(spark):
    html = ("<link rel='canonical' href='/canvass'><meta http-equiv='refresh' content='0; "
            "url=/election-results'><iframe src='https://x.clarityelections.com/a/'></iframe>"
            "<script>location.href='/unofficial-results';var a=\"https://e.org/r.csv\"</script>")
    page = spark.createDataFrame([("https://s.gov/", html)], "url string, html string")
    got = {r.candidate_url: (r.score, r.provenance[0].kind) for r in L.discover(page).collect()}
    assert got == {
        "https://s.gov/canvass": (20, "canonical"),
        "https://s.gov/election-results": (20, "meta_redirect"),
        "https://x.clarityelections.com/a/": (80, "iframe"),
        "https://s.gov/unofficial-results": (20, "embedded"),
        "https://e.org/r.csv": (15, "embedded")}


def test_csv_directory_and_hidden_targets(spark):
    rows = spark.createDataFrame([(2, "SS", "Kent County", "https://kent.example.org"),
                                  (3, "SS", "Nowhere", "kent.example.org")],
                                 "row_number int, state string, name string, site string")
    got = L.csv_directory(rows, units(spark), F.lit("https://s.gov/a.csv"), "name", "site").collect()
    assert [(r.row_number, r.associated_unit_ids, r.match_status) for r in got] == [
        (2, ["u2"], "unit_label_candidate")]
    page = spark.createDataFrame([(
        "https://s.gov/", "ND", '<tr><td>Cass County <a href="/cass">x</a></td></tr>'
        '<div data-website="https://w.example.org"></div><script>var u="https://j.example.org/a"'
        ';</script>')], "url string, state string, html string")
    hidden = L.hidden_candidates(page, F.col("state"))
    assert {r.candidate_url for r in hidden.collect()} == {
        "https://s.gov/cass", "https://w.example.org", "https://j.example.org/a"}


def test_wide_csv_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "﻿Precinct,Office,Candidate,Votes,early_voting\nP1,Gov,Ann,\"1,200\",\nP1,Gov,,5,5\n")
    ctx = R.Context.of("e", "us:mi:county:x", "s", "2026-11-03 00:00:00", "certified",
                       F.lit("0" * 64))
    rows = R.wide_results(R.read_wide_csv(spark, str(tmp_path)), ctx).collect()
    assert [(r.votes, r.vote_mode, r.raw_vote_mode) for r in rows] == [(1200, "total", "votes")]
    assert rows[0].reporting_unit_id.endswith(":regime:certified:s:reporting-unit:precinct:p1")


def test_registry_round_trip(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "object_type,canonical_id,alias_kind,alias_value,alias_namespace,status,confidence,"
        "reconciliation_method,evidence_reference,reviewer,effective_from,effective_to\n"
        "j,b,k,B,n,verified,0.5,m,e,r,2020-01-01,\nj,a,k,A,n,verified,,m,e,r,,\n")
    rows = G.read_identity_aliases(spark, str(tmp_path / "in.csv"))
    assert rows.filter("effective_to is null").count() == 2
    G.write_identity_aliases(rows, str(tmp_path / "out"))
    again = G.read_identity_aliases(spark, str(tmp_path / "out"))
    assert [r.canonical_id for r in again.collect()] == ["a", "b"]
    assert sorted(again.collect()) == sorted(rows.collect()) or again.exceptAll(rows).count() == 0


def test_landing_is_idempotent(spark, tmp_path):
    for name, body in (("a", b"one"), ("b", b"one"), ("c", b"two")):
        (tmp_path / f"{name}.bin").write_bytes(body)
    caps = S.read_captures(spark, str(tmp_path))
    fresh = S.new_captures(caps, caps.limit(0))
    S.land(fresh, str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    assert landed.count() == 2 and S.tampered(landed).count() == 0
    assert S.new_captures(S.read_captures(spark, str(tmp_path / "a.bin")), landed).count() == 0
    assert S.tampered(landed.withColumn("content", F.lit(b"x"))).count() == 2


def captures(spark):
    day = lambda n: dt.datetime(2026, 11, n)
    rounds = [
        [("s", "c1", day(1), "h1", "u", "g", "a", None, "total", "t", 5)],
        [("s", "c1", day(2), "h2", "u", "g", "a", None, "total", "t", 7),
         ("s", "c1", day(2), "h2", "u", "g", "b", None, "total", "t", 1)],
        [("s", "c1", day(3), "h3", "u", "g", "a", None, "total", "t", 6),
         ("s", "c1", day(3), "h3", "u", "g", "b", None, "total", "t", 1)],
        [("s", "c1", day(4), "h4", "u", "g", "a", None, "total", "t", 8)],
        [("s", "c2", day(5), "h5", "u", "g", "a", None, "total", "t", 2)],
    ]
    schema = ("source_id string, config string, captured_at timestamp, sha256 string,"
              "reporting_unit_id string, contest_name string, choice_name string, party string,"
              "vote_mode string, raw_vote_mode string, votes long")
    return [spark.createDataFrame(r, schema) for r in rounds]


WANT = [("h1", "ok", ""), ("h2", "ok", ""),
        ("h3", "review_required", "cumulative_votes_decreased"),
        ("h4", "review_required", "rows_disappeared"), ("h5", "ok", "")]


def test_baseline_batches(spark, tmp_path):
    root = str(tmp_path / "root")
    for n, df in enumerate(captures(spark)):
        feeds.accept_batch(spark, df, n, root)
    feeds.accept_batch(spark, captures(spark)[4], 4, root)  # a repeated batch changes nothing
    log = spark.read.parquet(f"{root}/attempts").orderBy("batch").collect()
    assert [(r.sha256, r.status, r.warnings) for r in log] == WANT
    assert [(r.config, r.votes) for r in feeds.accepted_baseline(spark, root).collect()] == [
        ("c2", 2)]
    status = feeds.attempt_status(spark, root, F.lit(0).cast("long"), F.lit(1),
                                  F.lit(60).cast("long")).first()
    assert status.status == "ok" and status.failures == 0


def test_json_votes_are_never_imputed(spark):
    from tallyweave.operators.quality import json_payload_violations
    doc = '{"reporting_units":[{"id":"u","contests":[{"name":"g","choices":[%s]}]}]}'
    choices = ['{"name":"a","votes":7}', '{"name":"b"}', '{"name":"c","votes":1.5}',
               '{"name":"d","votes":true}', '{"name":"e","votes":null}', '{"name":"f","votes":"-3"}']
    ctx = R.Context.of("2026", "mi-x", "src", "2026-11-03 00:00:00")
    one = spark.createDataFrame([(doc % ",".join(choices),)], "body string")
    assert {(r.choice_name, r.votes) for r in R.nested_json(one, "body", ctx).collect()} == {
        ("a", 7), ("f", -3)}
    bodies = [(n, doc % c) for n, c in enumerate(choices)] + [
        (10, None), (11, ""), (12, "[]"), (13, '{"reporting_units":[{"contests":{}}]}'),
        (14, '{"reporting_units":[]}'), (15, doc % "null")]
    got = json_payload_violations(spark.createDataFrame(bodies, "n int, body string"), "body",
                                  ["n"])
    assert {(r.n, r.rule_id) for r in got.collect()} == {
        *[(n, "votes_not_integer") for n in (1, 2, 3, 4)],
        *[(n, "unsupported_schema") for n in (10, 11, 12)], (13, "invalid_unit"),
        (15, "invalid_choice")}


def test_captures_of_one_batch_are_judged_in_turn(spark, tmp_path):
    root = str(tmp_path / "root")
    days = captures(spark)
    feeds.accept_batch(spark, days[0].unionByName(days[2]).unionByName(days[1]), 0, root)
    feeds.accept_batch(spark, days[4].unionByName(days[3]), 1, root)
    log = spark.read.parquet(f"{root}/attempts").orderBy("batch").collect()
    assert [(r.sha256, r.status, r.warnings) for r in log] == WANT
    feeds.accept_batch(spark, days[0].limit(0), 2, root)
    assert [r.votes for r in feeds.accepted_baseline(spark, root).collect()] == [2]


def test_late_and_repeated_bytes_land_once(spark, tmp_path):
    root = str(tmp_path / "root")
    day = lambda n: dt.datetime(2026, 11, n)
    cols = "source_id string, sha256 string, captured_at timestamp, path string"
    feeds.ingest_batch(spark.createDataFrame(
        [("s", "h2", day(20), "p"), ("s", "h2", day(21), "q"), (None, "h2", day(21), "r")], cols),
        0, root)
    late = spark.createDataFrame([("s", "h1", day(1), "a"), ("s", "h2", day(28), "b"),
                                  (None, "h2", day(1), "c")], cols)
    for _ in range(2):
        feeds.ingest_batch(late, 1, root)
    got = {(r.source_id, r.sha256, r.path) for r in spark.read.parquet(f"{root}/landed").collect()}
    assert got == {("s", "h2", "p"), (None, "h2", "r"), ("s", "h1", "a")}


def test_equal_times_in_the_ledger_follow_arrival(spark, tmp_path):
    root = str(tmp_path / "root")
    cols = "k string, at long, arrival long, verified boolean, failure_class string"
    feeds.ledger_batch(spark, spark.createDataFrame([("s", 5, 1, True, "")], cols), 0, root, ["k"],
                       "at", "arrival")
    feeds.ledger_batch(spark, spark.createDataFrame(
        [("s", 5, 2, False, "x"), ("s", 4, 3, True, "")], cols), 1, root, ["k"], "at", "arrival")
    row = feeds.current_ledger(spark, root, ["k"]).first()
    assert not row.currently_reachable and row.last_failure_class == "x" and row.ever_verified
    assert spark.read.parquet(f"{root}/refused").filter("batch = 1").count() == 1


def test_baseline_state_equals_batches(spark, tmp_path):
    from tallyweave.plans.streams import ROCKS
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    for df in captures(spark):
        df.coalesce(1).write.mode("append").parquet(land)
    stream = feeds.capture_stream(spark, land, captures(spark)[0].schema, max_files=1)
    feeds.run_available(feeds.stateful_verdicts(stream).writeStream.format("parquet")
                        .option("path", out).option("checkpointLocation", str(tmp_path / "c"))
                        .outputMode("append"))
    got = spark.read.parquet(out).orderBy("captured_at").collect()
    assert [(r.sha256, r.status, r.warnings) for r in got] == WANT
