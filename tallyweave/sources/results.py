"""Result files to canonical facts: wide CSV, nested JSON, XML, script JSON, tables and text.

Every reader takes a table of captured bodies, one row per capture, and returns one row per
count. Nothing is shuffled: a capture is cut into rows by arrays inside its own record, headings
carry forward by splitting the record at its headings, and mode rules are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyweave.functions import html as H
from tallyweave.functions import ids
from tallyweave.functions import values as N
from tallyweave.functions.jsontext import last_of_each, with_objects
from tallyweave.functions.nesting import tables
from tallyweave.operators.modes import resolve_modes
from tallyweave.schemas import OBSERVATION, PROGRESS
from tallyweave.session import bind, write_once

# Header aliases and vote columns of wide files.
COLUMN_ALIASES = {
    "precinct": ["precinct", "reporting_unit", "ward_precinct", "precinct_name", "polling_place"],
    "contest": ["office", "contest", "race", "contest_name"],
    "candidate": ["candidate", "choice", "candidate_name", "option"],
    "party": ["party", "candidate_party"],
    "source_order": ["source_order", "order", "position", "ballot_order"],
    "registered_voters": ["registered_voters", "registered", "registration"],
    "ballots_cast": ["ballots_cast", "total_ballots", "ballots"],
}
VOTE_COLUMNS = ["election_day", "ed", "early_voting", "early", "absentee", "av",
                "av_counting_boards", "pre_process_absentee", "mail", "provisional", "votes",
                "total"]
# Keys of script payloads.
UNIT_KEYS = ["precinct", "precinctName", "reportingUnit", "reportingUnitName", "ward"]
CONTEST_KEYS = ["contest", "contestName", "office", "race", "raceName"]
CHOICE_KEYS = ["candidate", "candidateName", "choice", "choiceName", "option"]
PARTY_KEYS = ["party", "partyName", "candidateParty"]
MODE_KEYS = ["electionday", "election_day", "early", "earlyvoting", "absentee", "av", "mail",
             "provisional", "votes", "total", "votecount"]
REPORTING_KEYS = ["precinctsReporting", "reportingPrecincts", "precincts_reported"]
EXPECTED_KEYS = ["precinctsTotal", "totalPrecincts", "precincts_total", "expectedPrecincts"]
COMPLETE_KEYS = ["complete", "isComplete", "reportingComplete", "resultsComplete"]
INCREMENTAL_KEYS = ["incremental", "isIncremental"]
CUMULATIVE_KEYS = ["cumulative", "isCumulative"]
# Modes of the four-column page and its ignored headings.
PAGE_MODES = [("early", "Early Votes"), ("absentee", "Absentee Votes"),
              ("election_day", "Election Day Votes"), ("total", "Total Votes")]
PAGE_NON_CONTESTS = ["summary", "precincts counted", "reports", "map view"]


@dataclass
class Context:
    """Where a capture belongs. Each field is a Column, so it may come from a joined row."""

    election_id: Column
    jurisdiction_id: Column
    source_id: Column
    fetched_at: Column
    regime_kind: Column | None = None
    snapshot_sha256: Column | None = None

    @staticmethod
    def of(election_id: str, jurisdiction_id: str, source_id: str, fetched_at: str,
           regime_kind: str | None = None, snapshot_sha256: Column | None = None) -> "Context":
        return Context(F.lit(election_id), F.lit(jurisdiction_id), F.lit(source_id),
                       F.lit(fetched_at).cast("timestamp"),
                       None if regime_kind is None else F.lit(regime_kind), snapshot_sha256)

    def columns(self) -> dict[str, Column]:
        none = F.lit(None).cast("string")
        regime = none if self.regime_kind is None else ids.reporting_regime_id(
            self.jurisdiction_id, self.election_id, self.regime_kind, self.source_id)
        return {"_election": self.election_id, "_jurisdiction": self.jurisdiction_id,
                "_source": self.source_id, "_fetched": self.fetched_at, "_regime": regime,
                "_snapshot": none if self.snapshot_sha256 is None else self.snapshot_sha256}


CONTEXT = ["_election", "_jurisdiction", "_source", "_fetched", "_regime", "_snapshot"]


def _facts(rows: DataFrame, unit_type: str = "precinct", native: bool = True,
           rules: DataFrame | None = None, fallback: str = "unknown") -> DataFrame:
    """Finish parsed rows: resolve modes, build ids, order the canonical columns.

    ``rows`` carries the context columns, unit_name, unit_key, contest_name, choice_name, votes
    and raw_vote_mode; other canonical columns are kept when present. A row whose vote_mode is
    already set keeps it.
    """
    if "vote_mode" not in rows.columns:
        state = ids.state_of_jurisdiction(F.col("_jurisdiction"))
        rows = resolve_modes(rows, "raw_vote_mode", state, F.col("_source"), rules).drop(
            "aggregation")
        rows = rows.withColumn("vote_mode", F.coalesce("vote_mode", F.lit(fallback)))
    canonical = F.col("_regime").isNotNull()
    key = F.col("unit_key") if native else F.lit("")
    scoped = ids.reporting_unit_id(
        F.split("_jurisdiction", ":")[1], F.col("_election"), F.col("_regime"), F.lit(unit_type),
        F.col("unit_name"), key)
    plain = F.concat_ws(":", "_jurisdiction", "unit_key")
    filled = {
        "election_id": F.col("_election"), "jurisdiction_id": F.col("_jurisdiction"),
        "source_id": F.col("_source"), "fetched_at": F.col("_fetched"),
        "reporting_unit_id": F.when(canonical, scoped).otherwise(plain),
        "reporting_unit_name": F.col("unit_name"), "reporting_regime_id": F.col("_regime"),
        "reporting_unit_raw_name": F.when(canonical, F.col("unit_name")),
        "reporting_unit_source_native_id": F.when(canonical, F.col("unit_key")) if native
        else F.lit(None), "snapshot_sha256": F.col("_snapshot"),
    }
    out = []
    for field in OBSERVATION:
        if field.name in filled:
            value = filled[field.name]
        elif field.name in rows.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*out)


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw wide CSV: every column a string, malformed lines kept for quarantine."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=False, mode="PERMISSIVE",
                          ignoreLeadingWhiteSpace=False)


def _header(df: DataFrame) -> dict[str, str]:
    """Trimmed lower-case header name to column name; the last of equal names wins."""
    return {name.lstrip("﻿").strip().lower(): name for name in df.columns}


def _pick(df: DataFrame, field: str) -> Column:
    header = _header(df)
    found = [F.col(f"`{header[a]}`") for a in COLUMN_ALIASES[field] if a in header]
    return N.first_present(*found)


def wide_results(df: DataFrame, ctx: Context, rules: DataFrame | None = None) -> DataFrame:
    """Wide rows to facts (S1): alias headers, up to twelve vote columns, blanks dropped."""
    header = _header(df)
    counts = F.array(*[F.struct(F.lit(c).alias("raw_vote_mode"),
                                F.col(f"`{header[c]}`").cast("string").alias("_count"))
                       for c in VOTE_COLUMNS if c in header])
    rows = df.select(
        *[v.alias(k) for k, v in ctx.columns().items()],
        _pick(df, "precinct").alias("unit_name"), _pick(df, "contest").alias("contest_name"),
        _pick(df, "candidate").alias("choice_name"), _pick(df, "party").alias("party"),
        N.lenient_int(_pick(df, "source_order")).alias("source_order"),
        N.lenient_int(_pick(df, "registered_voters")).alias("registered_voters"),
        N.lenient_int(_pick(df, "ballots_cast")).alias("ballots_cast"), counts.alias("_counts"))
    rows = rows.filter("unit_name is not null and contest_name is not null "
                       "and choice_name is not null")
    keep = [c for c in rows.columns if c != "_counts"]
    long = rows.select(*keep, F.inline("_counts")).withColumn(
        "votes", N.lenient_int(F.col("_count"))).filter("votes is not null")
    return _facts(long.withColumn("unit_key", F.col("unit_name")), rules=rules)


_CHOICE = "struct<name:string,party:string,order:string,votes:string,mode:string>"
NESTED_JSON = ("struct<reporting_units:array<struct<id:string,name:string,contests:array<struct<"
               f"name:string,choices:array<{_CHOICE}>>>>>>")


def nested_json(df: DataFrame, body: str, ctx: Context, unit_type: str = "precinct",
                rules: DataFrame | None = None) -> DataFrame:
    """``reporting_units[].contests[].choices[]`` to facts.

    A choice without an explicit whole number of votes gives no fact, never a zero;
    ``quality.json_payload_violations`` lists it.
    """
    rows = df.select(*[v.alias(k) for k, v in ctx.columns().items()],
                     F.from_json(body, NESTED_JSON).alias("_d"))
    units = rows.select(*CONTEXT, F.explode("_d.reporting_units").alias("u"))
    units = units.select(*CONTEXT, N.first_present(F.col("u.id"), F.col("u.name"))
                         .alias("unit_key"), F.col("u.name").alias("_n"),
                         F.explode("u.contests").alias("c")).filter("unit_key is not null")
    contests = units.select(
        *CONTEXT, "unit_key", F.coalesce(N.present(F.col("_n")), "unit_key").alias("unit_name"),
        N.present(F.col("c.name")).alias("contest_name"), F.explode("c.choices").alias("h"))
    long = contests.filter("contest_name is not null").select(
        *CONTEXT, "unit_key", "unit_name", "contest_name",
        N.present(F.col("h.name")).alias("choice_name"), N.present(F.col("h.party")).alias("party"),
        F.col("h.order").try_cast("int").alias("source_order"),
        F.when(whole_votes(F.col("h.votes")), F.trim("h.votes").try_cast("long"))
        .alias("votes"),
        F.coalesce(N.present(F.col("h.mode")), F.lit("total")).alias("raw_vote_mode"),
    ).filter("choice_name is not null and votes is not null")
    return _facts(long, unit_type, rules=rules)


def whole_votes(votes: Column) -> Column:
    """Is the JSON text of a vote count an explicit whole number? False for null, true, 1.5."""
    return F.coalesce(F.trim(votes).rlike(r"^-?[0-9]+$"), F.lit(False))


_XML_FIELDS = ["Id", "Name", "Party", "Order", "Mode", "Votes"]
_TOTAL = "struct<mode:string,_mode:string,votes:string,_votes:string>"
_XCHOICE = ("struct<name:string,_name:string,party:string,_party:string,order:string,"
            f"_order:string,Total:array<{_TOTAL}>>")
_XCONTEST = f"struct<name:string,_name:string,Choice:array<{_XCHOICE}>>"
_XPRECINCT = ("id string,_id string,precinctId string,_precinctId string,name string,"
              f"_name string,Contest array<{_XCONTEST}>")


def nested_xml(df: DataFrame, body: str, ctx: Context, rules: DataFrame | None = None) -> DataFrame:
    """Precinct, Contest, Choice, Total elements at any depth to facts (S3).

    A value is the child's text, else the attribute of the same name, in either capitalization.
    """
    text = F.col(body).cast("string")
    for name in _XML_FIELDS:
        low = name.lower()
        # The name comes first in the pattern, so that other characters are passed over at once.
        text = F.regexp_replace(text, rf"{name}(?<=\s{name})(?=\s*=)", low)
        text = F.regexp_replace(text, rf"<(/?){name}\b", f"<$1{low}")
    parts = F.regexp_extract_all(text, F.lit(r"(?s)<Precinct\b.*?</Precinct\s*>"), F.lit(0))
    rows = df.select(*[v.alias(k) for k, v in ctx.columns().items()],
                     F.explode(parts).alias("_x"))
    rows = bind(rows.select(*CONTEXT, "_x"), p=F.from_xml("_x", _XPRECINCT)).drop("_x")
    key = N.first_present(*[F.col(f"p.{c}") for c in ("id", "_id", "precinctId", "_precinctId",
                                                      "name", "_name")])
    units = rows.select(*CONTEXT, key.alias("unit_key"),
                        N.first_present(F.col("p.name"), F.col("p._name"), key).alias("unit_name"),
                        F.explode("p.Contest").alias("c")).filter("unit_key is not null")
    contests = units.select(*CONTEXT, "unit_key", "unit_name", N.first_present(
        F.col("c.name"), F.col("c._name")).alias("contest_name"), F.explode("c.Choice").alias("h"))
    totals = contests.filter("contest_name is not null").select(
        *CONTEXT, "unit_key", "unit_name", "contest_name",
        N.first_present(F.col("h.name"), F.col("h._name")).alias("choice_name"),
        N.first_present(F.col("h.party"), F.col("h._party")).alias("party"),
        N.first_present(F.col("h.order"), F.col("h._order")).alias("_order"),
        F.explode("h.Total").alias("t"))
    long = totals.filter("choice_name is not null").select(
        *CONTEXT, "unit_key", "unit_name", "contest_name", "choice_name", "party",
        F.when(F.col("_order").rlike(r"^\d+$"), F.col("_order").cast("int"))
        .alias("source_order"),
        N.lenient_int(F.coalesce(N.first_present(F.col("t.votes"), F.col("t._votes")), F.lit("0")))
        .alias("votes"),
        F.coalesce(N.first_present(F.col("t.mode"), F.col("t._mode")), F.lit("total"))
        .alias("raw_vote_mode"))
    return _facts(long, rules=rules)


def script_objects(df: DataFrame, body: str, ctx: Context,
                   names: list[list[str]] | None = None) -> DataFrame:
    """Every JSON object embedded in a page's scripts, as a map of its scalar fields.

    With ``names``, those without a field of one of these lists may be left out.
    """
    scripts = df.select(*[v.alias(k) for k, v in ctx.columns().items()],
                        F.explode(H.elements(F.col(body), "script")).alias("_s"))
    tag = F.regexp_extract("_s", r"(?is)^(<[^>]*>)", 1)
    inner = F.regexp_replace("_s", r"(?is)^<script\b[^>]*>|</script\s*>$", "")
    typed = (F.lower(F.coalesce(H.attribute(tag, "type"), F.lit(""))) == "application/json") | (
        F.coalesce(H.attribute(tag, "id"), F.lit("")) == "__NEXT_DATA__")
    assigned = F.regexp_extract_all(
        inner, F.lit(r"(?s)(?:window\.__\w+|__INITIAL_STATE__)\s*=\s*(\{.*?\});?\s*$"), F.lit(1))
    texts = F.concat(F.when(typed, F.array(inner)).otherwise(
        F.array().cast("array<string>")), assigned)
    docs = scripts.select(*CONTEXT, F.explode(texts).alias("_j"))
    return with_objects(docs, "_j", names).select(*CONTEXT, F.explode("_objects").alias("o"))


def _field(keys: list[str]) -> Column:
    """First present value under the keys, exact spelling before any capitalization."""
    options = []
    for k in keys:
        options += [F.element_at("o", k), F.element_at(F.col("_low"), k.lower())]
    return N.first_present(*options)


def _with_lower(objects: DataFrame) -> DataFrame:
    """Add the fields by lower-case name; the last of names that differ by case wins."""
    entries = F.map_entries("o")
    lows = F.transform(entries, lambda e: F.struct(F.lower(e.key).alias("key"),
                                                   e.value.alias("value")))
    return bind(objects, _low=F.map_from_entries(last_of_each(lows)))


def script_results(df: DataFrame, body: str, ctx: Context,
                   rules: DataFrame | None = None) -> DataFrame:
    """Objects with unit, contest and choice keys to one fact per mode key."""
    objects = _with_lower(script_objects(df, body, ctx, [UNIT_KEYS, CONTEST_KEYS, CHOICE_KEYS]))
    modes = F.array_compact(F.array(*[
        F.when(F.element_at("_low", k).isNotNull(), F.struct(
            F.lit(k).alias("raw_vote_mode"), F.element_at("_low", k).alias("_count")))
        for k in MODE_KEYS]))
    rows = bind(objects, unit_name=_field(UNIT_KEYS), contest_name=_field(CONTEST_KEYS),
                choice_name=_field(CHOICE_KEYS), party=_field(PARTY_KEYS), _modes=modes)
    rows = rows.filter("unit_name is not null and contest_name is not null "
                       "and choice_name is not null")
    long = rows.select(*CONTEXT, "unit_name", F.col("unit_name").alias("unit_key"),
                       "contest_name", "choice_name", "party", F.inline("_modes"))
    long = long.withColumn("votes", N.lenient_int(F.col("_count"))).filter("votes is not null")
    facts = _facts(long, rules=rules)
    return facts.dropDuplicates(["source_id", "snapshot_sha256", "fetched_at", "jurisdiction_id",
                                 "reporting_unit_name", "contest_name", "choice_name",
                                 "raw_vote_mode", "votes"])


def _flag(value: Column) -> Column:
    low = F.lower(F.trim(value))
    return F.when(low.isin("true", "yes", "1"), True).when(low.isin("false", "no", "0"), False)


def _progress(rows: DataFrame) -> DataFrame:
    base = {"election_id": "_election", "jurisdiction_id": "_jurisdiction",
            "source_id": "_source", "fetched_at": "_fetched", "reporting_regime_id": "_regime",
            "snapshot_sha256": "_snapshot"}
    out = []
    for field in PROGRESS:
        name = base.get(field.name, field.name)
        value = F.col(name) if name in rows.columns else F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*out)


def script_progress(df: DataFrame, body: str, ctx: Context) -> DataFrame:
    """Reporting counts and completion found in script payloads."""
    told = REPORTING_KEYS + EXPECTED_KEYS + COMPLETE_KEYS
    objects = _with_lower(script_objects(df, body, ctx, [told]))
    both = (REPORTING_KEYS + EXPECTED_KEYS + COMPLETE_KEYS + INCREMENTAL_KEYS + CUMULATIVE_KEYS)
    status = F.to_json(F.map_from_entries(F.array_sort(F.filter(
        F.map_entries("o"), lambda e: e.key.isin(both)))))
    rows = bind(objects, reporting_count=N.lenient_int(_field(REPORTING_KEYS)),
                expected_count=N.lenient_int(_field(EXPECTED_KEYS)),
                _complete=_field(COMPLETE_KEYS), reporting_unit_name=_field(UNIT_KEYS),
                _inc=_flag(_field(INCREMENTAL_KEYS)), _cum=_flag(_field(CUMULATIVE_KEYS)),
                raw_status=status)
    rows = rows.filter("reporting_count is not null or expected_count is not null "
                       "or _complete is not null")
    inc, cum = F.coalesce("_inc", F.lit(False)), F.coalesce("_cum", F.lit(False))
    semantics = (F.when(inc & ~cum, "incremental").when(cum & ~inc, "cumulative")
                 .otherwise("unknown"))
    unit = F.col("reporting_unit_name")
    scoped = ids.reporting_unit_id(F.split("_jurisdiction", ":")[1], F.col("_election"),
                                   F.col("_regime"), F.lit("precinct"), unit, unit)
    rows = rows.select(
        *CONTEXT, "reporting_unit_name", "reporting_count", "expected_count", "raw_status",
        F.when(unit.isNotNull(), "reporting_unit").otherwise("source").alias("scope"),
        F.when(unit.isNotNull(), F.when(F.col("_regime").isNotNull(), scoped).otherwise(
            F.concat_ws(":", "_jurisdiction", "reporting_unit_name"))).alias("reporting_unit_id"),
        semantics.alias("update_semantics"), _flag(F.col("_complete")).alias("complete"),
        F.lit("source_reported").alias("basis")).distinct()
    # Both kinds come from one row, so that pages are read once.
    own = ["reporting_count", "expected_count", "complete"]

    def kind(name: str, kept: list[str]) -> Column:
        values = [(F.col(c) if c in kept else F.lit(None).cast(rows.schema[c].dataType)).alias(c)
                  for c in own]
        return F.when(F.coalesce(*kept).isNotNull(), F.struct(F.lit(name).alias("kind"), *values))

    both = F.array_compact(F.array(kind("source_counts", own[:2]), kind("source_complete", own[2:])))
    return _progress(rows.select(*[c for c in rows.columns if c not in own], F.inline(both)))


def mode_tables(df: DataFrame, body: str, ctx: Context, unit: Column | None = None,
                rules: DataFrame | None = None, unit_type: str = "reporting_unit") -> DataFrame:
    """Tables whose header cells name modes (S6): first cell choice, first integer votes."""
    name = F.col("_jurisdiction") if unit is None else unit
    pages = df.select(*[v.alias(k) for k, v in ctx.columns().items()],
                      F.col(body).alias("_html"), *([unit.alias("_unit")] if unit is not None
                                                    else []))
    pages = pages.withColumn("unit_name", F.col("_unit") if unit is not None else name)
    tables = pages.select(*CONTEXT, "unit_name", F.explode(H.elements(F.col("_html"), "table"))
                          .alias("_t"))
    contest = H.attribute(F.regexp_extract("_t", r"(?is)^(<[^>]*>)", 1), "data-contest")
    cut = bind(tables, contest_name=F.coalesce(N.present(contest), F.lit("unknown contest")),
               _rows=F.transform(H.elements(F.col("_t"), "tr"), H.table_cells))
    rows = cut.filter("size(_rows) > 1").select(
        *CONTEXT, "unit_name", "contest_name", F.element_at("_rows", 1).alias("_head"),
        F.explode(F.slice("_rows", 2, F.size("_rows") - 1)).alias("_cells"))
    rows = rows.filter("size(_cells) >= 2 and _cells[0] <> ''")
    cells = rows.select(*CONTEXT, "unit_name", "contest_name",
                        F.element_at("_cells", 1).alias("choice_name"),
                        F.inline(F.arrays_zip(F.col("_head").alias("raw_vote_mode"),
                                              F.col("_cells").alias("_cell"))))
    number = F.regexp_extract(F.coalesce("_cell", F.lit("")), r"(-?\d[\d,]*)", 1)
    cells = cells.filter("raw_vote_mode is not null").withColumn(
        "votes", F.when(number != "", F.replace(number, F.lit(","), F.lit("")).try_cast("long")))
    cells = cells.filter("votes is not null").withColumn("unit_key", F.col("unit_name"))
    facts = _facts(cells, unit_type, native=False, rules=rules, fallback="")
    return facts.filter("vote_mode <> ''")


_UNIT, _HEAD, _CELL = "\x04", "\x03", "\x02"


def _blocks(text: Column, mark: str) -> Column:
    """Parts of a text that start at a mark, without what comes before the first."""
    parts = F.split(text, mark)
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def _lines(block: Column) -> Column:
    """Lines of a block after its heading line."""
    lines = F.split(block, "\n")
    return F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))


def _heading(block: Column) -> Column:
    return F.element_at(F.split(block, "\n"), 1)


def unit_title(html: Column) -> Column:
    """Unit name from the first heading that is not about the election, else the title."""
    def usable(text: Column) -> Column:
        return F.when((text != "") & ~F.lower(text).contains("election"), text)
    return F.coalesce(*[usable(H.first_element_text(html, h)) for h in ("h1", "h2", "h3")],
                      H.first_element_text(html, "title"))


def heading_page(df: DataFrame, body: str, ctx: Context) -> DataFrame:
    """One unit's page with heading rows and four mode columns.

    A marked row, or a single cell without digits, sets the contest and restarts the order.
    """
    h = F.col("_html")
    pages = bind(
        df.select(*[v.alias(k) for k, v in ctx.columns().items()], F.col(body).alias("_html")),
        unit_name=unit_title(h), _text=H.text_of(h))
    rows = F.transform(H.elements(h, "tr"), lambda r: F.struct(
        r.rlike(r"(?i)class\s*=\s*[\"'][^\"']*\bheadertr\b").alias("marked"),
        F.regexp_extract(r, r"(?is)<[^>]*\bheadertr\b[^>]*>(.*?)</t[hdr]\s*>", 1).alias("label"),
        H.table_cells(r).alias("cells")))
    plain = lambda r: (F.size(r.cells) == 1) & ~r.cells[0].rlike(r"-?\d[\d,]*")
    marked = F.transform(rows, lambda r: (
        F.when(r.marked, F.concat(F.lit(_HEAD), H.text_of(r.label)))
        .when(plain(r) & (r.cells[0] != "") & ~F.lower(r.cells[0]).isin(PAGE_NON_CONTESTS),
              F.concat(F.lit(_HEAD), r.cells[0]))
        .when(F.size(r.cells) >= 5, F.array_join(r.cells, _CELL)).otherwise(F.lit(""))))
    pages = bind(pages, _stream=F.array_join(marked, "\n"),
                 source_timestamp=N.report_time(F.col("_text")),
                 registered_voters=N.labeled_int(F.col("_text"), "Registered Voters"),
                 ballots_cast=N.labeled_int(F.col("_text"), "Ballots Cast"))
    keep = [*CONTEXT, "unit_name", "source_timestamp", "registered_voters", "ballots_cast"]
    blocks = pages.select(*keep, F.explode(_blocks(F.col("_stream"), _HEAD)).alias("_b"))
    counted = F.filter(F.transform(_lines(F.col("_b")), lambda l: F.split(l, _CELL)), lambda c: (
        (F.size(c) >= 5) & F.forall(F.slice(c, 2, 4), lambda x: N.first_int(x).isNotNull())))
    rows = blocks.select(*keep, _heading(F.col("_b")).alias("contest_name"),
                         F.posexplode(counted).alias("_i", "_c"))
    modes = F.array(*[F.struct(F.lit(m).alias("vote_mode"), F.lit(raw).alias("raw_vote_mode"),
                               N.first_int(F.col("_c")[i + 1]).alias("votes"))
                      for i, (m, raw) in enumerate(PAGE_MODES)])
    long = rows.select(*keep, "contest_name", F.trim(F.col("_c")[0]).alias("choice_name"),
                       (F.col("_i") + 1).alias("source_order"), F.inline(modes))
    slug = F.regexp_replace(F.regexp_replace(F.lower("unit_name"), "[^a-z0-9]+", "-"),
                            "^-+|-+$", "")
    return _facts(long.withColumn("unit_key", slug), "reporting_unit", native=False)


def page_progress(df: DataFrame, body: str, ctx: Context) -> DataFrame:
    """Unit exists and unit reported, inferred from rows of five or more cells."""
    h = F.col("_html")
    pages = df.select(*[v.alias(k) for k, v in ctx.columns().items()], F.col(body).alias("_html"))
    pages = bind(pages, _name=unit_title(h), _seen=F.exists(
        H.elements(h, "tr"), lambda r: F.size(H.table_cells(r)) >= 5))
    two = F.array(
        F.struct(F.lit("unit_exists").alias("kind"), F.lit(True).alias("reported"),
                 F.col("_name").alias("raw_status")),
        F.struct(F.lit("unit_reported").alias("kind"), F.col("_seen").alias("reported"),
                 F.when(F.col("_seen"), "candidate rows present")
                 .otherwise("no candidate rows observed").alias("raw_status")))
    rows = pages.select(
        *CONTEXT, F.col("_name").alias("reporting_unit_name"),
        F.coalesce(ids.reporting_unit_id(
            F.split("_jurisdiction", ":")[1], F.col("_election"), F.col("_regime"),
            F.lit("reporting_unit"), F.col("_name")), ids.alias_token(F.col("_name")))
        .alias("reporting_unit_id"),
        F.lit("reporting_unit").alias("scope"), F.lit("inferred").alias("basis"),
        F.lit("unknown").alias("update_semantics"), F.inline(two))
    return _progress(rows)


def summary_page(df: DataFrame, url: str, body: str) -> DataFrame:
    """Totals, report time and unit page links of a summary page."""
    from tallyweave.operators.links import resolve_simple
    pages = bind(df, _text=H.text_of(F.col(body)))
    links = F.filter(F.regexp_extract_all(
        body, F.lit(r"(?is)<a\b[^>]*href\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1)),
        lambda u: F.lower(u).contains("precinctreport"))
    labels = {"precincts_total": "Total Precincts", "precincts_counted": "Fully Counted Precincts",
              "precincts_partially_counted": "Partially Counted Precincts",
              "registered_voters": "Registered Voters", "ballots_cast": "Ballots Cast"}
    return pages.select(
        *[c for c in df.columns if c != body],
        F.array_sort(F.array_distinct(F.transform(
            links, lambda u: resolve_simple(u, F.col(url))))).alias("precinct_urls"),
        *[N.labeled_int(F.col("_text"), text, ":?").alias(name) for name, text in labels.items()],
        N.report_time(F.col("_text")).alias("source_timestamp"))


def page_set_results(summaries: DataFrame, pages: DataFrame, ctx: Context, url: str = "url",
                     body: str = "body", fetched: str = "fetched_at") -> tuple[
                         DataFrame, DataFrame, DataFrame]:
    """Facts of all unit pages that a summary links to, by summary (S22, from S10 and S7).

    ``summaries`` has one capture per ``url``; of each page the last capture is read, found by its address
    as the summary's links resolve to it. ``ctx`` is evaluated on pages with the columns ``set_url``,
    ``url``, ``body`` and ``fetched_at``; its source must be ``set_url``. Returns the facts; per set the numbers of linked,
    captured and parsed pages, the totals it states, and whether it is complete; and the linked pages that
    no capture holds. Captures are unique by address, time and bytes.
    """
    heads = summary_page(summaries.select(url, body), url, body)
    links = heads.select(F.col(url).alias("set_url"), F.explode("precinct_urls").alias("url"))
    own = pages.select(F.col(url).alias("url"), F.col(fetched).alias("fetched_at"),
                       F.col(body).alias("body"))
    # Bodies are shuffled once, by address; digests, which do not compress, are made after that.
    newest = W.partitionBy("url").orderBy(F.desc("fetched_at"), F.desc("_digest"))
    last = own.repartition("url").withColumn("_digest", F.sha2("body", 256)).withColumn(
        "_rank", F.rank().over(newest)).filter("_rank = 1").drop("_rank", "_digest")
    found = links.join(own.select("url", F.lit(True).alias("_last")).distinct(), "url", "left")
    held = links.join(last, "url").select("set_url", "url", "fetched_at", "body")
    facts = heading_page(held, "body", ctx)
    digest = F.col("snapshot_sha256")
    short = F.when(digest.rlike("^[0-9a-f]{64}$"), F.unhex(digest)).otherwise(digest.cast("binary"))
    parsed = facts.select(F.col("source_id").alias("set_url"), short.alias("_digest")).filter(
        "_digest is not null").distinct().groupBy("set_url").agg(
        F.count(F.lit(1)).alias("parsed_pages"))
    counts = found.groupBy("set_url").agg(
        F.count(F.lit(1)).alias("linked_pages"),
        F.count("_last").alias("captured_pages"))
    sets = heads.withColumnRenamed(url, "set_url").join(counts, "set_url", "left").join(
        parsed, "set_url", "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("linked_pages", "captured_pages", "parsed_pages")}
    complete = ((n["linked_pages"] > 0) & (n["captured_pages"] == n["linked_pages"])
                & (n["parsed_pages"] == n["linked_pages"])
                & F.coalesce(F.col("precincts_total") == n["linked_pages"], F.lit(False)))
    sets = sets.select("set_url", *[v.alias(c) for c, v in n.items()], "precincts_total",
                       "precincts_counted", "source_timestamp", complete.alias("complete"))
    return facts, sets, found.filter("_last is null").select("set_url", "url")


# Line patterns of text reports.
_LINE_UNIT = r"(?i)^Precinct\s*[:\-]?\s*(.+)$"
_LINE_REGISTERED = r"(?i)Registered\s+Voters\s*[:\-]?\s*([\d,]+)"
_LINE_BALLOTS = r"(?i)(?:Ballots|Voters)\s+Cast\s*[:\-]?\s*([\d,]+)"
_LINE_SKIP = r"(?i)^(Total\s+Votes|Overvotes?|Undervotes?|Times\s+Cast|Cards\s+Cast|Turnout)\b"
_LINE_WRITE_IN = r"(?i)^Write[- ]?In(?:s)?\b"
_LINE_CONTEST = (r"^(?!Precinct\b)(?!Registered\s+Voters\b)(?!Ballots\s+Cast\b)"
                 r"(?!Voters\s+Cast\b)(?!Turnout\b)(?!Total\s+Votes\b)(?!Overvotes?\b)"
                 r"(?!Undervotes?\b)[A-Za-z]")
_LINE_CHOICE = r"^(.+?)\s+([\d,]+)$"


def line_report(df: DataFrame, text: str, ctx: Context) -> DataFrame:
    """Unit, contest and choice lines of a text report.

    A unit line resets contest, turnout and order; a contest line resets the order. The first
    heading-like line of a unit is a contest even when it ends in a number. The text is split at
    units and then at contests, so headings carry forward without a window.
    """
    flat = F.transform(F.split(F.col(text), r"\r\n|\r|\n"),
                       lambda l: F.trim(F.regexp_replace(l, r"\s+", " ")))
    marked = F.transform(F.filter(flat, lambda l: l != ""), lambda l: F.when(
        l.rlike(_LINE_UNIT), F.concat(F.lit(_UNIT), F.regexp_extract(l, _LINE_UNIT, 1)))
        .otherwise(l))
    docs = bind(df.select(*[v.alias(k) for k, v in ctx.columns().items()], F.col(text)),
                _stream=F.array_join(marked, "\n"))
    units = docs.select(*CONTEXT, F.explode(_blocks(F.col("_stream"), _UNIT)).alias("_b"))
    numbered = F.transform(_lines(F.col("_b")), lambda l, i: F.struct(i.alias("i"), l.alias("l")))
    units = bind(units, unit_name=F.trim(_heading(F.col("_b"))), _all=numbered)
    counts = lambda p: F.transform(
        F.filter("_all", lambda x: x.l.rlike(p)), lambda x: F.struct(
            x.i.alias("i"), F.replace(F.regexp_extract(x.l, p, 1), F.lit(","), F.lit(""))
            .try_cast("long").alias("v")))
    turnout = rf"{_LINE_REGISTERED}|{_LINE_BALLOTS}"
    kept = F.filter("_all", lambda x: ~x.l.rlike(turnout) & (
        ~x.l.rlike(_LINE_SKIP) | x.l.rlike(_LINE_WRITE_IN)))
    units = bind(units, _reg=counts(_LINE_REGISTERED),
                 _bal=F.filter(counts(_LINE_BALLOTS), lambda x: x.v.isNotNull()), _kept=kept)
    first = F.array_position(F.transform("_kept", lambda x: x.l.rlike(_LINE_CONTEST)), True)
    units = bind(units, _first=first.cast("int")).filter("_first > 0")
    rest = F.slice("_kept", F.col("_first"), F.size("_kept") - F.col("_first") + 1)
    tagged = F.transform(rest, lambda x, i: F.concat(
        F.when((i == 0) | (~x.l.rlike(_LINE_CHOICE) & x.l.rlike(_LINE_CONTEST)), F.lit(_HEAD))
        .otherwise(F.lit("")), x.l, F.lit(_CELL), x.i.cast("string")))
    blocks = units.select(*CONTEXT, "unit_name", "_reg", "_bal",
                          F.explode(_blocks(F.array_join(tagged, "\n"), _HEAD)).alias("_c"))
    choices = F.filter(F.transform(_lines(F.col("_c")), lambda l: F.struct(
        F.element_at(F.split(l, _CELL), 1).alias("l"),
        F.get(F.split(l, _CELL), 1).try_cast("int").alias("i"))), lambda x: (
            x.l.rlike(_LINE_CHOICE)
            & ~F.trim(F.regexp_extract(x.l, _LINE_CHOICE, 1)).rlike(_LINE_SKIP)))
    rows = blocks.select(
        *CONTEXT, "unit_name", "_reg", "_bal",
        F.element_at(F.split(_heading(F.col("_c")), _CELL), 1).alias("contest_name"),
        F.posexplode(choices).alias("_n", "_l"))
    before = lambda c: F.try_element_at(
        F.filter(c, lambda x: x.i < F.col("_l.i")), F.lit(-1))["v"]
    number = F.replace(F.regexp_extract(F.col("_l.l"), _LINE_CHOICE, 2), F.lit(","), F.lit(""))
    long = rows.select(
        *CONTEXT, "unit_name", F.col("unit_name").alias("unit_key"), "contest_name",
        F.trim(F.regexp_extract(F.col("_l.l"), _LINE_CHOICE, 1)).alias("choice_name"),
        (F.col("_n") + 1).alias("source_order"), number.try_cast("long").alias("votes"),
        before(F.col("_reg")).alias("registered_voters"),
        before(F.col("_bal")).alias("ballots_cast"), F.lit("total").alias("vote_mode"),
        F.lit("total").alias("raw_vote_mode"))
    return _facts(long.filter("votes is not null"))


def detail_table(df: DataFrame, body: str, ctx: Context) -> DataFrame:
    """Table form of the unit and contest report (S8): last cell votes, first cell choice."""
    rows = F.transform(H.elements(F.col("_html"), "tr"), H.table_cells)
    rows = F.filter(rows, lambda c: F.size(c) > 0)
    marked = F.transform(rows, lambda c: (
        F.when((F.size(c) <= 3) & F.array_join(c, " ").rlike(r"(?i)\bprecinct\b"),
               F.concat(F.lit(_UNIT), F.element_at(c, -1)))
        .when(F.size(c) == 1, F.concat(F.lit(_HEAD), F.element_at(c, 1)))
        .otherwise(F.array_join(c, _CELL))))
    pages = bind(df.select(*[v.alias(k) for k, v in ctx.columns().items()],
                           F.col(body).alias("_html")), _stream=F.array_join(marked, "\n"))
    units = pages.select(*CONTEXT, F.explode(_blocks(F.col("_stream"), _UNIT)).alias("_b"))
    name = F.regexp_extract("_b", rf"(?s)^([^\n{_HEAD}]*)", 1)
    contests = units.select(*CONTEXT, name.alias("unit_name"),
                            F.explode(_blocks(F.col("_b"), _HEAD)).alias("_c"))
    cells = F.filter(F.transform(_lines(F.col("_c")), lambda l: F.split(l, _CELL)), lambda c: (
        (F.size(c) >= 2) & F.element_at(c, -1).rlike(r"\d")))
    rows = contests.select(*CONTEXT, "unit_name", F.col("unit_name").alias("unit_key"),
                           _heading(F.col("_c")).alias("contest_name"),
                           F.posexplode(cells).alias("_n", "_r"))
    long = rows.select(*CONTEXT, "unit_name", "unit_key", "contest_name",
                       F.element_at("_r", 1).alias("choice_name"),
                       (F.col("_n") + 1).alias("source_order"),
                       N.digits_or_zero(F.element_at("_r", -1)).alias("votes"),
                       F.lit("total").alias("vote_mode"))
    return _facts(long)


# Report names, turnout words and mode words of text reports.
_REPORT_NAMES = (r"(?i)(statement\s+of\s+votes\s+cast|election\s+summary\s+report|"
                 r"canvass\s+results?\s+report)")
_REPORT_PRECINCTS = (r"(?i)precincts?\s+report(?:ed|ing)\s*[:\-]?\s*(\d+)\s+"
                     r"(?:of|/|out\s+of)\s+(\d+)")
_REPORT_TURNOUT = r"(?i)(registered\s+voters|voters\s+cast|ballots\s+cast|turnout)"
_REPORT_MODES = r"(?i)(election\s+day|absentee|early\s+voting|provisional|mail)"


def report_profile(df: DataFrame, text: str) -> DataFrame:
    """Family, precinct progress, turnout flag and modes of known text reports."""
    t = F.col(text)
    part = lambda i: F.regexp_extract(t, _REPORT_PRECINCTS, i).try_cast("long")
    return df.filter(t.rlike(_REPORT_NAMES)).select(
        *[c for c in df.columns if c != text],
        F.regexp_replace(F.lower(F.regexp_extract(t, _REPORT_NAMES, 1)), r"\s+", "_")
        .alias("family"),
        part(1).alias("precincts_reported"), part(2).alias("precincts_total"),
        t.rlike(_REPORT_TURNOUT).alias("has_turnout"),
        F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(_REPORT_MODES), F.lit(1)),
                                     F.lower)).alias("vote_modes"))


def payload_kind(body: Column) -> Column:
    """Kind of a binary payload by how it starts, for tables by its whole first line.

    Each byte counts as a character: what decides is ASCII, and any bytes can be read so.
    """
    start = F.substring(body, 1, 4)
    text = F.regexp_replace(F.decode(body, "ISO-8859-1"), r"^\s+", "")
    line = F.regexp_extract(text, r"^([^\r\n]*)", 1)
    return (
        F.when(F.hex(start) == "504B0304", "excel")
        .when(text.startswith("{") | text.startswith("["), "json")
        .when(text.startswith("<"), "xml")
        .when(F.size(F.split(line, ",")) >= 3, "csv")
        .otherwise("unknown")
    )


# Columns of district files.
DISTRICT_KEY = ["County", "Office Name", "Office District", "Candidate Name", "Party"]
DISTRICTS = [f"Congressional District {i}" for i in range(1, 9)]


def district_csv(df: DataFrame, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Strict wide district file: rows with a district map and sum, and violations.

    Rows with a violation are in the second table only, all those of a repeated key too. ``keys`` are
    columns that name the file, where there are several.
    """
    keys = keys or []
    trimmed = df.select(*[F.col(f"`{c}`").alias(c.strip()) for c in df.columns])
    required = DISTRICT_KEY + ["County Name"] + DISTRICTS
    missing = sorted(set(required) - set(trimmed.columns))
    if missing:
        raise ValueError(f"unsupported district schema, missing {missing}")
    counts = F.array(*[N.strict_count(F.col(f"`{d}`")) for d in DISTRICTS])
    rows = bind(trimmed, _counts=counts)
    ragged = F.lit(False)
    for c in required:
        ragged = ragged | F.col(f"`{c}`").isNull()
    named = [*keys, *DISTRICT_KEY]
    rows = bind(rows, _rule=F.when(ragged, "malformed_row").when(F.exists("_counts", lambda v: v.isNull()),
                                             "invalid_count"))
    bad = rows.select(*[F.col(f"`{c}`").alias(c) for c in named],
                      F.col("_rule").alias("rule_id")).filter("rule_id is not null")
    twice = trimmed.groupBy(*[F.col(f"`{c}`") for c in named]).agg(
        F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n").withColumn(
        "rule_id", F.lit("duplicate_key"))
    good = rows.filter("_rule is null").join(twice.drop("rule_id"), named, "left_anti")
    out = good.select(
        *keys, F.col("County").alias("county_code"), F.col("`County Name`").alias("county_name"),
        F.col("`Office Name`").alias("contest"), F.col("`Office District`").alias("office_district"),
        F.col("`Candidate Name`").alias("candidate"), F.col("Party").alias("party"),
        F.map_from_arrays(F.array(*[F.lit(d) for d in DISTRICTS]), F.col("_counts"))
        .alias("district_votes"),
        F.aggregate("_counts", F.lit(0).cast("long"), lambda s, v: s + v).alias("district_sum"))
    return out, bad.unionByName(twice)


STATEWIDE_HEADER = ["Name", "Party", "Early Voting", "Election Day", "Mail-In Ballot",
                    "Provisional", "Total", "Percentage"]


def statewide_tables(df: DataFrame, key: list[str], body: str) -> tuple[DataFrame, DataFrame]:
    """Mode tables whose sums must agree in every row and in the totals row.

    Tables may lie in others; a row counts for every table around it. Returns the candidate rows and the
    violations ``(key, table, rule_id)``.
    """
    cut = tables(df, body, key)
    cut = bind(cut, _cells=F.filter("_rows", lambda c: F.size(c) > 0)).drop("_rows")
    cut = cut.withColumnRenamed("_cells", "_rows")
    header = F.array(*[F.lit(c) for c in STATEWIDE_HEADER])
    cut = bind(cut, _at=F.array_position("_rows", header).cast("int")).filter("_at > 0")
    body_rows = F.filter(F.slice("_rows", F.col("_at") + 1, F.size("_rows") - F.col("_at")),
                         lambda c: c != header)
    rows = cut.select(*key, "table", F.posexplode_outer(body_rows).alias("pos", "_c"))
    modes = F.array(*[N.strict_count(F.try_element_at("_c", F.lit(i))) for i in range(3, 7)])
    rows = bind(rows, modes=modes, total=N.strict_count(F.try_element_at("_c", F.lit(7))),
                candidate=F.try_element_at("_c", F.lit(1)),
                party=F.try_element_at("_c", F.lit(2)))
    rows = write_once(rows)  # four results follow; pages are parsed for them once
    mode_sum = F.aggregate("modes", F.lit(0).cast("long"), lambda s, v: s + v)
    is_total = F.col("candidate") == "Totals"
    rule = (
        F.when(F.size("_c") != len(STATEWIDE_HEADER), "malformed_row")
        .when(F.col("total").isNull() | F.exists("modes", lambda v: v.isNull()), "invalid_count")
        .when(mode_sum != F.col("total"), "mode_sum_differs")
        .when(~is_total & ((F.col("candidate") == "") | (F.col("party") == "")),
              "missing_candidate_context")
    )
    row_bad = rows.withColumn("rule_id", rule).filter("rule_id is not null").select(
        *key, "table", "rule_id")
    both = F.struct("modes", "total")
    candidate_total = F.struct(*[
        F.sum(F.when(~is_total, F.col("modes")[i])).alias(f"m{i}") for i in range(4)],
        F.sum(F.when(~is_total, F.col("total"))).alias("t"))
    groups = rows.groupBy(*key, "table").agg(
        F.count_if(~is_total).alias("n"), F.count_if(is_total).alias("totals"),
        F.count_distinct(F.when(~is_total, F.col("party"))).alias("parties"),
        F.max(F.when(is_total, F.col("pos"))).alias("total_pos"),
        F.max(F.when(~is_total, F.col("pos"))).alias("last_pos"),
        candidate_total.alias("sums"), F.max(F.when(is_total, both)).alias("published"))
    differs = F.col("sums.t") != F.col("published.total")
    for i in range(4):
        differs = differs | (F.col(f"sums.m{i}") != F.col("published.modes")[i])
    group_rule = (
        F.when((F.col("n") == 0) | (F.col("totals") == 0), "missing_rows_or_total")
        .when(F.col("totals") > 1, "duplicate_total")
        .when(F.col("last_pos") > F.col("total_pos"), "row_after_total")
        .when(F.col("parties") != 1, "mixed_party")
        .when(differs, "candidate_sums_differ")
    )
    group_bad = groups.withColumn("rule_id", group_rule).filter("rule_id is not null").select(
        *key, "table", "rule_id")
    dup = rows.filter(~is_total).groupBy(*key, "candidate", "party").agg(
        F.count(F.lit(1)).alias("_n"), F.min("table").alias("table")).filter("_n > 1").select(
        *key, "table", F.lit("duplicate_candidate").alias("rule_id"))
    good = rows.filter(~is_total & rule.isNull()).select(
        *key, "table", "candidate", "party", "modes", "total")
    return good, row_bad.unionByName(group_bad).unionByName(dup)


# Parser names, as extension point; each takes (captures, body column, context).
PARSERS = {
    "nested_json": nested_json,
    "nested_xml": nested_xml,
    "script_json": script_results,
    "mode_tables": mode_tables,
    "heading_page": heading_page,
    "line_report": line_report,
    "detail_table": detail_table,
}
