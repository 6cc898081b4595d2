"""CSV captures that each bring their own header, and the strict intake of captures.

A capture is cut into records and a record into fields by one pattern each, so a body is read once,
in its own row, without a shuffle; the patterns never go back, so a field may be of any length.
Columns are found per capture by the names in its first record, not by place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import values as N
from tallyweave.operators import observations as O
from tallyweave.operators import quality as Q
from tallyweave.sources import results as R
from tallyweave.session import bind

# A field is quoted if it starts with a quote; doubled quotes are one, and what follows the closing
# one belongs to it. An open quote runs to the end of the text.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+(?:"|\z))?+[^,\r\n]*+'
RECORD = rf"(?:{FIELD},)*+{FIELD}(?:\r\n|[\r\n]|\z)"
QUOTED = r'^"([^"]*+(?:""[^"]*+)*+)'


def body_text(body: Column | str) -> Column:
    """Bytes as text without a byte-order mark; what is no UTF-8 becomes U+FFFD."""
    text = F.make_valid_utf8((F.col(body) if isinstance(body, str) else body).cast("string"))
    return F.regexp_replace(text, "^\ufeff", "")


def split_fields(record: Column) -> Column:
    """The fields of a record, unquoted."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({FIELD})"), F.lit(1))
    return F.transform(raw, lambda f: F.when(f.startswith('"'), F.concat(
        F.replace(F.regexp_extract(f, QUOTED, 1), F.lit('""'), F.lit('"')),
        F.regexp_replace(f, QUOTED + '"?', ""))).otherwise(f))


def csv_rows(captures: DataFrame, body: str, keep: dict[str, Column]) -> DataFrame:
    """One row per record after the header, with the ``keep`` columns of its capture.

    Adds ``row_number`` (1 is the first record after the header; blank lines have none),
    ``_names`` (header names, trimmed, lower case) and ``_fields``. A capture without a second record
    gives no row.
    """
    names = F.transform(split_fields(F.coalesce(F.get("_records", F.lit(0)), F.lit(""))),
                        lambda f: F.lower(F.trim(f)))
    blank = r"^[\r\n]*$"
    cut = captures.select(*[v.alias(k) for k, v in keep.items()],
                          body_text(body).alias("_text"))
    cut = bind(cut, _records=F.regexp_extract_all("_text", F.lit(RECORD), F.lit(0)))
    cut = bind(cut.drop("_text"), _names=names)
    later = F.filter(F.slice("_records", 2, F.greatest(F.size("_records") - 1, F.lit(0))),
                     lambda r: ~r.rlike(blank))
    rows = cut.select(*keep, "_names", F.posexplode(later).alias("_at", "_record"))
    return bind(rows, _fields=split_fields(F.col("_record"))).select(
        *keep, (F.col("_at") + 1).alias("row_number"), "_names", "_fields")


def _value(name: str) -> Column:
    """The field under a header name, the last of equal names; null where the row or header lacks it."""
    back = F.array_position(F.reverse("_names"), name)
    return F.when(back > 0, F.get("_fields", (F.size("_names") - back).cast("int")))


def _first(field: str) -> Column:
    return N.first_present(*[_value(a) for a in R.COLUMN_ALIASES[field]])


def _width() -> Column:
    return (F.when(F.size("_fields") > F.size("_names"), "wide_row")
            .when(F.size("_fields") < F.size("_names"), "narrow_row"))


def csv_results(captures: DataFrame, body: str, ctx: R.Context, keys: list[str],
                rules: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Facts of CSV captures with a header each (S1), and their ragged rows.

    A row with more fields than its header is set aside; one with fewer is read, with its last
    columns missing. Both are in the second table: ``keys``, row_number, rule_id, and the numbers of fields and of
    columns. Rows without unit, contest or choice and counts that are no whole number give no fact.
    """
    own = {f"_key_{k}": F.col(k) for k in keys}
    rows = csv_rows(captures, body, {**ctx.columns(), **own})
    ragged = rows.select(*[F.col(f"_key_{k}").alias(k) for k in keys], "row_number",
                         _width().alias("rule_id"), F.size("_fields").alias("n_fields"),
                         F.size("_names").alias("n_columns")).filter("rule_id is not null")
    good = rows.filter(F.size("_fields") <= F.size("_names"))
    counts = F.array(*[F.struct(F.lit(c).alias("raw_vote_mode"), _value(c).alias("_count"))
                       for c in R.VOTE_COLUMNS])
    good = good.select(
        *R.CONTEXT, _first("precinct").alias("unit_name"), _first("contest").alias("contest_name"),
        _first("candidate").alias("choice_name"), _first("party").alias("party"),
        *[N.lenient_int(_first(c)).alias(c)
          for c in ("source_order", "registered_voters", "ballots_cast")],
        F.filter(counts, lambda c: F.coalesce(c["_count"], F.lit("")) != "").alias("_counts"))
    good = good.filter("unit_name is not null and contest_name is not null "
                       "and choice_name is not null")
    long = good.select(*[c for c in good.columns if c != "_counts"], F.inline("_counts"))
    long = long.withColumn("votes", N.lenient_int(F.col("_count"))).filter("votes is not null")
    return R._facts(long.withColumn("unit_key", F.col("unit_name")), rules=rules), ragged


def csv_payload_violations(captures: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """Strict reading of CSV captures (V4): ``keys``, row_number and rule_id of every fault.

    A body that is no UTF-8 is a fault of row 0. Rows without any value are passed over.
    """
    rows = csv_rows(captures, body, {k: F.col(k) for k in keys})
    rows = rows.filter(F.exists("_fields", lambda f: f != ""))

    def lacks(field: str) -> Column:
        return F.concat(*[F.coalesce(_value(a), F.lit(""))
                          for a in R.COLUMN_ALIASES[field]]) == ""

    votes = F.filter(F.array(*[_value(c) for c in R.VOTE_COLUMNS]),
                     lambda v: F.coalesce(v, F.lit("")) != "")
    rows = bind(rows, _votes=votes)
    found = Q.violations(rows, [*keys, "row_number"], {
        "wide_row": F.size("_fields") > F.size("_names"),
        "incomplete_row": lacks("precinct") | lacks("contest") | lacks("candidate"),
        "missing_votes": F.size("_votes") == 0,
        "votes_not_integer": F.exists("_votes", lambda v: ~F.trim(v).rlike(
            "^-?[0-9][0-9,]*$")),
    })
    broken = captures.filter(~F.is_valid_utf8(F.col(body).cast("string"))).select(
        *keys, F.lit(0).alias("row_number"), F.lit("invalid_encoding").alias("rule_id"))
    return found.unionByName(broken)


def judge_captures(captures: DataFrame, ctx: R.Context, source: str = "source_id",
                   body: str = "body", parser: str = "parser",
                   required_text: str = "required_text",
                   rules: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse captures by their parser, ``csv`` or ``json``, and judge each one whole.

    Returns the facts of captures without a finding, and the findings: ``source``, rule_id and how
    often. A capture must carry its required text, be readable strictly, give facts, name no
    observation twice and count nothing below zero. ``source`` names a capture; ctx.source_id must
    be that column.
    """
    by = {kind: captures.filter(F.col(parser) == kind) for kind in ("csv", "json")}
    facts = csv_results(by["csv"], body, ctx, [source], rules)[0].unionByName(
        R.nested_json(by["json"].withColumn(body, body_text(body)), body, ctx, rules=rules))
    payload = csv_payload_violations(by["csv"], body, [source]).select(source, "rule_id")
    payload = payload.unionByName(Q.json_payload_violations(
        by["json"].select(source, body_text(body).alias("_body")), "_body", [source]))
    unknown = captures.filter(~F.coalesce(F.col(parser).isin(*by), F.lit(False))).select(
        source, F.lit("unknown_parser").alias("rule_id"))
    marker = Q.violations(captures.filter(F.coalesce(required_text, F.lit("")) != ""), [source],
                          {"marker_absent": ~F.contains(body_text(body), F.col(required_text))})
    # One row per observation key, then one per capture: equal keys meet after a partial count.
    keyed = facts.groupBy(F.col("source_id").alias(source), *O.CAPTURE_KEY).agg(
        F.count(F.lit(1)).alias("_copies"), F.count_if(F.col("votes") < 0).alias("_negative"))
    parsed = keyed.groupBy(source).agg(
        F.count_if(F.col("_copies") > 1).alias("duplicate_observation"),
        F.sum("_negative").alias("negative_votes"))
    parsed = captures.select(source).distinct().join(parsed, source, "left")
    own = F.array(
        F.struct(F.lit("no_rows").alias("rule_id"),
                 F.col("negative_votes").isNull().cast("long").alias("findings")),
        *[F.struct(F.lit(c).alias("rule_id"), F.coalesce(c, F.lit(0)).alias("findings"))
          for c in ("duplicate_observation", "negative_votes")])
    own = parsed.select(source, F.inline(own)).filter("findings > 0")
    read = payload.unionByName(unknown).unionByName(marker).groupBy(source, "rule_id").agg(
        F.count(F.lit(1)).alias("findings"))
    findings = own.unionByName(read)
    refused = findings.select(F.col(source).alias("source_id")).distinct()
    return facts.join(refused, "source_id", "left_anti"), findings
