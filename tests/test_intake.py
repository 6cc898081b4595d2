"""CSV captures against the csv module, and the strict intake."""

import csv
import io
import random

from pyspark.sql import functions as F

from tallyweave.sources import intake as I
from tallyweave.sources import results as R


def context():
    return R.Context(F.lit("2026"), F.lit("us:mi:county:x"), F.col("source_id"),
                     F.lit("2026-11-03").cast("timestamp"), F.lit("certified"), F.sha2("body", 256))


def test_fields_equal_the_csv_module(spark):
    rng, texts = random.Random(1), []
    for _ in range(300):
        text = "".join(rng.choice(['a', 'b c', ',', '"', '""', '\n', '\r\n', 'é', ',"', '",'])
                       for _ in range(rng.randint(0, 40)))
        texts.append(text)
    texts += ["x," + '"' + 'q""' * 20_000 + '",z\n1,2', "a\n\n\nb", "", "\n", '"open\n,']
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").withColumn("b", F.col("t").cast("binary"))
    got = {}
    for r in I.csv_rows(df, "b", {"i": F.col("i")}).orderBy("i", "row_number").collect():
        got.setdefault(r["i"], []).append(list(r["_fields"]))
    for i, text in rows:
        try:
            want = list(csv.reader(io.StringIO(text, newline="")))
        except csv.Error:  # a bare carriage return
            continue
        assert got.get(i, []) == [row for row in want[1:] if row], repr(text)


def test_columns_are_found_by_each_capture_s_own_header(spark):
    bodies = [("a", b"\xef\xbb\xbfPrecinct,Office,Candidate,Total,total\n1,r,c,5,\"1,006\"\n2,r,c,7\n"),
              ("b", b"votes, CHOICE ,race,ward_precinct\n\n8,c,r,3\n9,c,r,4,more,5\nx,c,r,5\n,c,r,6"),
              ("c", b"votes,choice,race,precinct"), ("d", b""), ("e", None), ("f", b"\xff,\n\xff,1")]
    df = spark.createDataFrame([(s, bytearray(b) if b is not None else None) for s, b in bodies],
                               "source_id string, body binary")
    facts, ragged = I.csv_results(df, "body", context(), ["source_id"])
    got = sorted((r["source_id"], r["reporting_unit_name"], r["votes"]) for r in facts.collect())
    assert got == [("a", "1", 1006), ("b", "3", 8)]
    assert sorted(tuple(r) for r in ragged.collect()) == [
        ("a", 2, "narrow_row", 4, 5), ("b", 2, "wide_row", 6, 4)]
    found = I.csv_payload_violations(df, "body", ["source_id"]).collect()
    assert {tuple(r) for r in found} == {
        ("a", 2, "missing_votes"), ("b", 2, "wide_row"), ("b", 3, "votes_not_integer"),
        ("b", 4, "missing_votes"), ("f", 0, "invalid_encoding"), ("f", 1, "incomplete_row"),
        ("f", 1, "missing_votes")}


def test_a_capture_is_judged_whole(spark):
    csv_ = "precinct,race,candidate,total\n"
    rows = [("ok", "csv", None, csv_ + "u,r,c,1\n"), ("mark", "csv", "official", csv_ + "u,r,c,1\n"),
            ("twice", "csv", "", csv_ + "u,r,c,1\nu,r,c,2\n"), ("neg", "csv", "u", csv_ + "u,r,c,-1"),
            ("none", "csv", None, csv_), ("what", "pdf", None, "x"), ("null", None, None, None),
            ("json", "json", "units", '{"reporting_units":[{"name":"u","contests":[{"name":"r",'
                                      '"choices":[{"name":"c","votes":3}]}]}]}'),
            ("text", "json", None, "no json")]
    df = spark.createDataFrame(rows, "source_id string, parser string, required_text string, "
                                     "body string").withColumn("body", F.col("body").cast("binary"))
    facts, findings = I.judge_captures(df, context())
    assert {(r["source_id"], r["votes"]) for r in facts.collect()} == {("ok", 1), ("json", 3)}
    assert {tuple(r) for r in findings.collect()} == {
        ("mark", "marker_absent", 1), ("twice", "duplicate_observation", 1),
        ("neg", "negative_votes", 1), ("none", "no_rows", 1), ("what", "no_rows", 1),
        ("what", "unknown_parser", 1), ("null", "no_rows", 1), ("null", "unknown_parser", 1),
        ("text", "no_rows", 1), ("text", "unsupported_schema", 1)}
