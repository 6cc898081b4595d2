"""Orders over all rows, and payloads held against each other."""

import random

from pyspark.sql import functions as F

from tallyweave.operators.ordered import numbered
from tallyweave.sources import crosscheck as X, results as R


def test_places_are_those_of_the_sorted_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 2, 2, 3]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "p int, i int").repartition(7)
    got = numbered(df, [F.col("p").desc_nulls_last(), F.col("i").asc()]).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.p, r.i) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1, 2001))
    same = numbered(df.select(F.lit(1).alias("p")), [F.col("p").asc()]).collect()
    assert sorted(r.position for r in same) == list(range(1, 2001))
    assert numbered(df.limit(0), [F.col("p").asc()]).count() == 0


def test_payloads_agree_or_not(spark):
    head = "".join(f"<td>{h}</td>" for h in R.STATEWIDE_HEADER)
    row = "<tr><td>{}</td><td>Democratic</td><td>1</td><td>1</td><td>1</td><td>{}</td><td>{}</td><td>x</td></tr>"
    total = "<tr><td>Totals</td><td></td><td>1</td><td>1</td><td>1</td><td>{0}</td><td>{1}</td><td>x</td></tr>"
    page = lambda n: f"<table><tr>{head}</tr>{row.format('A', n, n + 3)}{total.format(n, n + 3)}</table>"
    columns = ",".join(["County Name", *R.DISTRICT_KEY, *R.DISTRICTS])
    line = "x,{},Governor,,{},DEM,0,0,0,0,0,0,1,{}\n"
    tables = spark.createDataFrame([(k, page(6)) for k in "abcd"], "k string, body string")
    files = spark.createDataFrame([
        ("a", f"{columns}\n" + line.format("00", "A", 8) + line.format("01", "A", 5)),
        ("b", f"{columns}\n" + line.format("00", "A", 7)),
        ("c", f"{columns}\n" + line.format("00", "B", 8)),
        ("e", f"{columns}\n" + line.format("00", "A", 8) * 2)], "k string, body string")
    got = X.payload_crosscheck(tables, files, "k", "Governor", "Democratic", "DEM").collect()
    assert {(r.k, r.status, r.matched_votes) for r in got} == {
        ("a", "crosschecked", 9), ("b", "totals_disagree", 0), ("c", "candidate_context_mismatch", 0),
        ("d", "candidate_context_mismatch", 0), ("e", "candidate_context_mismatch", 0)}
