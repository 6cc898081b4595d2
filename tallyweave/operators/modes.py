"""Vote-mode labels resolved by a governed rule table; ties of meaning resolve to null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.ids import mode_label
from tallyweave.session import fixed_table

# Labels every source shares, by mode; then labels with a state meaning.
LITERAL_LABELS = {
    "election_day": ["election day", "election_day", "electionday", "ed"],
    "early": ["early", "early voting", "early_voting", "earlyvoting"],
    "absentee": ["absentee"],
    "mail": ["mail"],
    "provisional": ["provisional"],
    "uocava": ["uocava"],
    "total": ["total", "total votes", "votes", "votecount"],
}
STATE_LABELS = {
    ("MI", "absentee"): ["av", "av counting boards", "av_counting_boards", "pre process absentee",
                         "pre_process_absentee"],
}
VOTE_MODES = ["election_day", "early", "absentee", "mail", "provisional", "uocava", "total",
              "other", "unknown"]

RULE_SCHEMA = ("raw_label string,state string,source_id string,vote_mode string,"
               "aggregation string,mapping_method string,evidence_reference string,status string,"
               "rule_order int")


def default_rules(spark: SparkSession) -> DataFrame:
    """The governed defaults as a table."""
    rows = []
    for mode, labels in LITERAL_LABELS.items():
        kind = "aggregate" if mode == "total" else "component"
        for label in labels:
            rows.append((label, None, None, mode, kind, "literal_label", "governed_default",
                         "verified", len(rows)))
    for (state, mode), labels in STATE_LABELS.items():
        for label in labels:
            rows.append((label, state, None, mode, "component", "state_semantic_override",
                         f"{state.lower()}_av_semantics", "verified", len(rows)))
    return fixed_table(spark, rows, RULE_SCHEMA)


def _normalized(rules: DataFrame) -> DataFrame:
    order = F.col("rule_order") if "rule_order" in rules.columns else F.lit(0)
    return rules.withColumn("_label", mode_label(F.col("raw_label"))).withColumn(
        "state", F.upper("state")).withColumn("_order", order)


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """Same label, state and source with more than one meaning."""
    meaning = F.struct("vote_mode", "mapping_method", "evidence_reference", "status",
                       "aggregation")
    return (
        _normalized(rules)
        .groupBy(F.col("_label").alias("label"), "state", "source_id")
        .agg(F.count_distinct(F.to_json(meaning)).alias("meanings"))
        .filter("meanings > 1")
    )


def rules_by_label(rules: DataFrame) -> DataFrame:
    """One row per label holding its verified rules (the rule table is small by governance)."""
    rule = F.struct(
        "_order", "state", "source_id", "vote_mode", "aggregation", "mapping_method",
        "evidence_reference",
        (F.col("state").isNotNull().cast("int") + F.col("source_id").isNotNull().cast("int"))
        .alias("scoped"),
    )
    return (
        _normalized(rules)
        .filter("status = 'verified'")
        .groupBy("_label")
        .agg(F.array_sort(F.collect_list(rule)).alias("_rules"))
    )


def resolve_modes(df: DataFrame, label: str | Column, state: Column | None = None,
                  source_id: Column | None = None, rules: DataFrame | None = None) -> DataFrame:
    """Add vote_mode, vote_mode_mapping_method, vote_mode_evidence_reference, aggregation.

    The most specific matching rule wins: state and source count one each. When rules of equal
    specificity disagree on mode or aggregation nothing is chosen. The default rules are a
    constant and broadcast; for other rules adaptive execution decides by their size in bytes.
    """
    if rules is None:
        table = F.broadcast(rules_by_label(default_rules(df.sparkSession)))
    else:
        table = rules_by_label(rules)
    label = F.col(label) if isinstance(label, str) else label
    state = F.upper(state) if state is not None else F.lit(None).cast("string")
    source_id = source_id if source_id is not None else F.lit(None).cast("string")

    joined = (
        df.withColumn("_in_label", mode_label(label))
        .withColumn("_in_state", state)
        .withColumn("_in_source", source_id)
        .join(table, F.col("_in_label") == F.col("_label"), "left")
    )
    fits = F.filter(
        F.coalesce("_rules", F.array()),
        lambda r: (r.state.isNull() | F.coalesce(r.state == F.col("_in_state"), F.lit(False)))
        & (r.source_id.isNull()
           | F.coalesce(r.source_id == F.col("_in_source"), F.lit(False))),
    )
    joined = joined.withColumn("_fits", fits)
    best = F.array_max(F.transform("_fits", lambda r: r.scoped))
    joined = joined.withColumn("_tied", F.filter("_fits", lambda r: r.scoped == best))
    meanings = F.size(F.array_distinct(F.transform(
        "_tied", lambda r: F.struct(r.vote_mode, r.aggregation))))
    chosen = F.when(meanings == 1, F.element_at("_tied", 1))
    joined = joined.withColumn("_rule", chosen)
    keep = [F.col(c) for c in df.columns if c not in (
        "vote_mode", "vote_mode_mapping_method", "vote_mode_evidence_reference", "aggregation")]
    return joined.select(
        *keep,
        F.col("_rule.vote_mode").alias("vote_mode"),
        F.col("_rule.mapping_method").alias("vote_mode_mapping_method"),
        F.col("_rule.evidence_reference").alias("vote_mode_evidence_reference"),
        F.col("_rule.aggregation").alias("aggregation"),
    )
