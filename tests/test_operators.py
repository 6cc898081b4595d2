"""Positive and negative cases of the operators on small tables."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyweave import schemas
from tallyweave.operators import (
    coverage as V, frontier as Q, graph as G, history, identity, links, modes,
    observations as O, overlap as M, quality)
from tallyweave.operators.sliced import count_since_last, running_before
from tallyweave.session import fixed_table

FACTS = ("reporting_unit_id string, contest_name string, choice_name string, vote_mode string,"
         "votes long")


def test_diff_reports_new_and_changed_only(spark):
    old = spark.createDataFrame([("u", "c", "a", "total", 5), ("u", "c", "b", "total", 7),
                                 ("u", "c", "gone", "total", 1)], FACTS)
    new = spark.createDataFrame([("u", "c", "a", "total", 9), ("u", "c", "b", "total", 7),
                                 ("u", "c", "n", "total", 2)], FACTS)
    got = {(r.choice_name, r.old_votes, r.delta) for r in O.snapshot_diff(old, new).collect()}
    assert got == {("a", 5, 4), ("n", None, 2)}


def test_change_summary_counts_decreases_only_when_cumulative(spark):
    cols = FACTS + ", party string, raw_vote_mode string"
    old = spark.createDataFrame([("u", "c", "a", "total", 5, None, None)], cols)
    new = spark.createDataFrame([("u", "c", "a", "total", 3, None, None)], cols)
    assert O.change_summary(old, new, cumulative=True).first().decreased_rows == 1
    assert O.change_summary(old, new, cumulative=False).first().decreased_rows == 0


def test_double_count_ignores_unknown_and_other(spark):
    rows = [("u", "c", "a", m, 1) for m in ("total", "unknown", "other")]
    df = spark.createDataFrame(rows, FACTS)
    assert O.double_count_violations(df).count() == 0
    more = spark.createDataFrame(rows + [("u", "c", "a", "mail", 1)], FACTS)
    assert O.double_count_violations(more).count() == 1


def test_digest_ignores_order_and_partitions_but_not_rows(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    one = O.table_digest(df.repartition(1)).first().digest
    assert one == O.table_digest(df.orderBy(F.rand()).repartition(13)).first().digest
    assert one != O.table_digest(df.unionByName(df.limit(1))).first().digest
    assert O.same_content(df, df.repartition(3)) and not O.same_content(df, df.limit(999))


@pytest.fixture
def many_parts(spark):
    """Small inputs keep one part per shuffle partition instead of being coalesced to one."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


@pytest.mark.parametrize("ties", [1, 50])
def test_running_values_equal_plain_windows(spark, many_parts, ties):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot", "hot", "hot", "a", None]), i // ties, i,
             rnd.choice([None, rnd.randint(0, 99)])) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t int, u int, v int")
    v = F.col("v")
    got = running_before(df, ["k"], ["t", "u"], {
        "last": ("last", v), "top": ("max", v), "low": ("min", v), "total": ("sum", v),
        "next": ("next", v), "rest": ("max_after", v)})
    rows_of = lambda c: Window.partitionBy("k").orderBy(c).rowsBetween(
        Window.unboundedPreceding, -1)
    w, b = rows_of(F.col("u").asc()), rows_of(F.col("u").desc())
    want = df.select("*", F.last("v", ignorenulls=True).over(w).alias("last"),
                     F.max("v").over(w).alias("top"), F.min("v").over(w).alias("low"),
                     F.coalesce(F.sum("v").over(w), F.lit(0)).alias("total"),
                     F.last("v", ignorenulls=True).over(b).alias("next"),
                     F.max("v").over(b).alias("rest"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_hot_key_and_instant_is_split(spark, many_parts):
    df = spark.range(100_000).select(F.lit("j").alias("k"), F.lit(1.0).alias("f"), "id")
    got = running_before(df, ["k"], ["f"], {"n": ("sum", F.lit(1))})
    counts = got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(counts) == (0, 99_999, 100_000)
    laid = spark.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0])
    parts = [r["count"] for r in laid.groupBy("_part").count().collect()]
    assert len(parts) > 4 and max(parts) < 50_000


def test_running_values_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, t int, v int")
    assert running_before(df, ["k"], ["t"], {"x": ("last", F.col("v"))}).count() == 0


def test_count_since_last(spark):
    df = spark.createDataFrame([("a", 1, "q"), ("a", 2, "r"), ("a", 3, "q"), ("a", 4, "q"),
                                ("b", 1, "q"), ("c", 1, "r")], "k string, t int, e string")
    got = count_since_last(df, ["k"], ["t"], F.col("e") == "r", F.col("e") == "q", "n")
    assert {(r.k, r.n) for r in got.collect()} == {("a", 2), ("b", 1), ("c", 0)}


def test_mode_rules(spark):
    df = spark.createDataFrame([("AV", "MI"), ("AV", "OH"), ("Election-Day", None),
                                ("nonsense", "MI")], "l string, s string")
    got = {(r.l, r.s): r.vote_mode for r in modes.resolve_modes(df, "l", F.col("s")).collect()}
    assert got == {("AV", "MI"): "absentee", ("AV", "OH"): None,
                   ("Election-Day", None): "election_day", ("nonsense", "MI"): None}
    tie = fixed_table(spark, [("x", "MI", None, "mail", "component", "m", "e", "verified", 0),
                              ("x", None, "s", "early", "component", "m", "e", "verified", 1)],
                      modes.RULE_SCHEMA)
    one = spark.createDataFrame([("x",)], "l string")
    assert modes.resolve_modes(one, "l", F.lit("MI"), F.lit("s"), tie).first().vote_mode is None
    assert modes.resolve_modes(one, "l", F.lit("MI"), F.lit("t"), tie).first().vote_mode == "mail"
    assert modes.rule_conflicts(modes.default_rules(spark)).count() == 0


def alias(spark, rows):
    full = [("jurisdiction", c, "external_id", a, n, s, 1.0, "m", "e", "r", f, t)
            for c, a, n, s, f, t in rows]
    df = spark.createDataFrame(
        full, "object_type string, canonical_id string, alias_kind string, alias_value string,"
              "alias_namespace string, status string, confidence double,"
              "reconciliation_method string, evidence_reference string, reviewer string,"
              "effective_from string, effective_to string")
    return df.withColumns({c: F.col(c).cast("date") for c in ("effective_from", "effective_to")})


def test_alias_resolution(spark):
    rows = alias(spark, [("x", "A b", "N", "verified", "2020-01-01", "2020-12-31"),
                         ("y", "a-B", "n ", "verified", "2021-01-01", None),
                         ("z", "a b", "n", "candidate", None, None),
                         ("t", "solo", "n", "verified", None, None),
                         ("p", "two", "n", "verified", None, None),
                         ("q", "two", "n", "verified", None, None)])
    probes = spark.createDataFrame(
        [("a b", "2020-12-31"), ("a b", "2021-01-01"), ("a b", "2019-01-01"), ("a b", None),
         ("solo", None), ("solo", "1999-01-01"), ("two", None), ("two", "2020-01-01")],
        "alias_value string, w string").select(
        F.lit("jurisdiction").alias("object_type"), F.lit("n").alias("alias_namespace"),
        "alias_value", F.col("w").cast("date").alias("when"))
    got = {(r.alias_value, str(r.when)): r.canonical_id
           for r in identity.resolve_aliases(probes, rows).collect()}
    assert got == {("a b", "2020-12-31"): "x", ("a b", "2021-01-01"): "y",
                   ("a b", "2019-01-01"): None, ("a b", "None"): None, ("solo", "None"): "t",
                   ("solo", "1999-01-01"): "t", ("two", "None"): None,
                   ("two", "2020-01-01"): None}
    assert identity.alias_collisions(rows).count() == 1


def test_overlap_witnesses_match_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        s = rnd.randint(0, 300)
        rows.append((rnd.choice("ab"), rnd.choice("xyz"), s, s + rnd.randint(0, 20)))
    df = spark.createDataFrame(rows, "k string, id string, s int, e int")
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), F.col(c))
    spans = df.select("k", "id", day("s").alias("f"), day("e").alias("t"))
    from tallyweave.operators.intervals import overlap_conflicts
    found = {r.k for r in overlap_conflicts(spans, ["k"], "id", "f", "t").collect()}
    brute = {a[0] for a in rows for b in rows
             if a[0] == b[0] and a[1] != b[1] and a[2] <= b[3] and b[2] <= a[3]}
    assert found == brute


def test_mirror_and_zero_norm(spark):
    cols = ("jurisdiction_id string, captured_at long, reporting_fraction double,"
            "result_vector array<double>, reporting_units array<string>, vote_modes array<string>")
    left = spark.createDataFrame([("j", 1, 0.50, [1.0, 2.0], ["u"], [])], cols)
    right = spark.createDataFrame([("j", 3, 0.46, [1.0, 2.0], ["u"], []),
                                   ("j", 2, 0.54, [2.0, 1.0], ["u"], []),
                                   ("j", 9, 0.60, [1.0, 2.0], ["u"], [])], cols)
    pairs = M.match_snapshots(left, right)
    assert [(r.right_at, r.vote_mode_jaccard) for r in pairs.collect()] == [(3, None)] or \
        [(r.right_at, r.vote_mode_jaccard) for r in pairs.collect()] == [(2, None)]
    zero = spark.createDataFrame([([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert zero.select(M.cosine(F.col("a"), F.col("b")).alias("c")).first().c is None
    assert M.summarize_overlap(pairs, ["jurisdiction_id"]).first().residual_independence_established is False


def test_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")],
                                  "child_id string, parent_id string")
    assert G.edge_cycles(edges).count() == 0
    assert G.pointer_cycles(edges, "child_id", "parent_id").count() == 0
    loop = edges.unionByName(spark.createDataFrame([("d", "b")], edges.schema))
    assert {r.child_id for r in G.edge_cycles(loop).collect()} == {"b", "c", "d"}
    assert {r.child_id for r in G.pointer_cycles(loop, "child_id", "parent_id").collect()} == {
        "b", "c", "d"}
    self_loop = spark.createDataFrame([("a", "a"), ("b", "a")], edges.schema)
    assert [r.child_id for r in G.pointer_cycles(self_loop, "child_id", "parent_id").collect()] == [
        "a"]


def test_due_pages_equal_the_rotating_loop(spark):
    rnd = random.Random(11)
    pages = [(f"u{i}", rnd.choice("abcd"), rnd.choice([None, rnd.randint(1, 9)])) for i in range(60)]
    df = spark.createDataFrame(pages, "url string, state string, last_checked_at long").withColumn(
        "next_check_at", F.lit(0))
    got = [(r.url) for r in Q.due_pages(df, F.lit(1), 25).collect()]
    queues = {}
    for url, state, at in pages:
        queues.setdefault(state, []).append((at or 0, url))
    for q in queues.values():
        q.sort()
    want = []
    while len(want) < 25 and any(queues.values()):
        heads = sorted((q[0][0], s) for s, q in queues.items() if q)
        for _, s in heads:
            if len(want) < 25:
                want.append(queues[s].pop(0)[1])
    assert got == want


def test_backoff_and_staleness(spark):
    rows = spark.createDataFrame([("a", 10, 1, "ok"), ("a", 20, 2, "failed"), ("a", 30, 3, "failed"),
                                  ("b", 5, 1, "failed")], "f string, at long, n long, status string")
    got = {r.f: (r.failures, r.stale, r.next_due) for r in history.feed_status(
        rows, ["f"], "at", "n", F.lit(100).cast("long"), F.lit(300), F.lit(60).cast("long"))
        .collect()}
    assert got == {"a": (2, False, 150), "b": (1, True, 65)}


def test_allocation_weights(spark):
    rows = [("u", "split_across", 0.6, "b", "complete"), ("u", "split_across", 0.4, "b", "complete"),
            ("v", "split_across", 0.6, "b", "complete"), ("w", "split_across", 0.7, "b", "partial"),
            ("x", "split_across", 0.9, "b", "unknown"), ("x", "split_across", 0.3, "b", "unknown"),
            ("y", "split_across", None, None, "unknown"), ("y", "split_across", 0.1, "b", "unknown")]
    df = spark.createDataFrame(rows, "reporting_unit_id string, relationship_type string,"
                                     "allocation_weight double, weight_basis string,"
                                     "allocation_coverage string").withColumns({
        "unmapped_weight": F.lit(None).cast("double"), "unmapped_basis": F.lit(None).cast("string"),
        "effective_from": F.lit(None).cast("date"), "effective_to": F.lit(None).cast("date")})
    got = {r.reporting_unit_id: r.finding
           for r in identity.allocation_weight_findings(df).collect()}
    assert got == {"v": "complete_weights_not_one", "x": "weights_exceed_one",
                   "y": "mixed_weighted_and_unweighted"}


def test_visibility_examples(spark):
    df = spark.createDataFrame([(1000,), (8000,), (125000,), (1000000,), (None,)], "p long")
    assert [r[0] for r in df.select(V.visibility_proxy(F.col("p"))).collect()] == [
        1, 2, 5, 10, None]
    big = spark.createDataFrame([(10000,), (100000,), (1000000,), (10000000,)], "p long")
    assert [r[0].typical for r in big.select(V.visibility_band(F.col("p"))).collect()] == [
        2, 7, 25, 89]


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([("a", "a", "contains", True)],
                               "parent_id string, child_id string, relation string, additive boolean")
    found = quality.violations(df, ["child_id"], quality.edge_rules())
    assert {r.rule_id for r in found.collect()} == {"self_edge", "containment_marked_additive"}
    with pytest.raises(ValueError):
        quality.require_clean(found)
    quality.require_clean(found.limit(0))
    assert quality.missing_columns(df, ["relation", "zzz"]) == ["zzz"]


def test_schemas_are_explicit():
    assert len(schemas.OBSERVATION) == 28 and "snapshot_sha256" in schemas.OBSERVATION.names


def test_text_urls_number_distinct_addresses(spark):
    rows = [("a", "See https://e.example.gov/r.csv, then https://e.example.gov/r.csv. (http://x.org/a)"),
            ("b", None), ("c", "no address"), ("d", "q='https://gov:8/x';https://\u00e9.gov\u2003z")]
    got = links.text_urls(spark.createDataFrame(rows, "id string, text string"), "text", "id").collect()
    assert sorted((r["source_record_id"], r["lead_url"], r["official_status"]) for r in got) == [
        ("a:1", "https://e.example.gov/r.csv", "likely_official"),
        ("a:2", "http://x.org/a", "unknown"),
        ("d:1", "https://gov:8/x", "likely_official"),
        ("d:2", "https://\u00e9.gov", "likely_official")]
