"""Captures of any kind to facts: each body goes to the parser of its route."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.sources import captures as S
from tallyweave.sources import intake as I
from tallyweave.sources import results as R

#: Parser by route; each takes (captures, body column, context). A caller may pass more.
PARSERS = {**R.PARSERS, "wide_csv": lambda df, body, ctx: I.csv_results(df, body, ctx, [])[0]}


def execute(captures: DataFrame, ctx: R.Context, parsers: dict | None = None
            ) -> tuple[DataFrame, DataFrame]:
    """Route, parse and judge captures (P2): the evidence, one row per capture, and the facts.

    ``captures`` has state, result_url, access_family, route, content and smallest_observed_unit, with
    one row per result_url; the context's source must be result_url. A body whose route cannot be
    executed goes by what its bytes are. Each body is read by one parser only.
    """
    parsers = PARSERS if parsers is None else parsers
    routed = S.with_route(captures)
    text = routed.withColumn("_body", I.body_text("content"))
    facts = [parse(text.filter(F.col("_route") == name), "_body", ctx)
             for name, parse in parsers.items()]
    facts = reduce(DataFrame.unionByName, facts)
    counted = facts.withColumn("result_url", F.col("source_id"))
    return S.execution_evidence(captures, counted), facts
