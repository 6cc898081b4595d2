"""Explicit schemas of the canonical tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    fields = []
    for part in text.split(","):
        name, kind = part.strip().split(" ", 1)
        fields.append(T.StructField(name, _KINDS[kind], True))
    return T.StructType(fields)


_KINDS = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
    "doubles": T.ArrayType(T.DoubleType()),
    "map": T.MapType(T.StringType(), T.StringType()),
}

OBSERVATION = _struct(
    "election_id string, jurisdiction_id string, reporting_unit_id string,"
    "reporting_unit_name string, reporting_regime_id string, reporting_unit_raw_name string,"
    "reporting_unit_source_native_id string, contest_id string, contest_name string,"
    "choice_id string, choice_name string, ballot_order int, ballot_order_scope string,"
    "source_order int, party string, votes long, vote_mode string, source_id string,"
    "fetched_at timestamp, source_timestamp timestamp, registered_voters long,"
    "ballots_cast long, precincts_reporting long, precincts_total long, raw_vote_mode string,"
    "vote_mode_mapping_method string, vote_mode_evidence_reference string,"
    "snapshot_sha256 string"
)

PROGRESS = _struct(
    "election_id string, jurisdiction_id string, source_id string, fetched_at timestamp,"
    "reporting_regime_id string, reporting_unit_id string, reporting_unit_name string,"
    "contest_id string, scope string, kind string, basis string, update_semantics string,"
    "reported bool, complete bool, reporting_count long, expected_count long,"
    "expected_components strings, observed_components strings, source_timestamp timestamp,"
    "snapshot_sha256 string, raw_status string"
)

SNAPSHOT = _struct(
    "source_id string, fetched_at timestamp, url string, http_status int, sha256 string,"
    "body_path string, metadata map"
)

IDENTITY_ALIAS = _struct(
    "object_type string, canonical_id string, alias_kind string, alias_value string,"
    "alias_namespace string, status string, confidence double, reconciliation_method string,"
    "evidence_reference string, reviewer string, effective_from date, effective_to date"
)

SOURCE_CAPABILITY = _struct(
    "jurisdiction_id string, authority_id string, source_id string, capability_type string,"
    "source_url string, platform_family string, smallest_observed_unit string,"
    "valid_from date, valid_to date, evidence_snapshot_sha256 string,"
    "verification_status string, assessment_method string, evidence_reference string,"
    "notes string"
)

LOCALITY = _struct(
    "jurisdiction_id string, state string, jurisdiction_level string, canonical_name string,"
    "id_status string, coverage_status string, authority_id string,"
    "external_id_namespace string, external_id string, final_capable bool,"
    "election_night_capable bool, final_evidence_url string, election_night_evidence_url string,"
    "final_source_id string, election_night_source_id string, assessment_method string,"
    "assessment_status string, first_verified_at string, last_verified_at string, notes string"
)

DENOMINATOR = _struct(
    "state string, expected_primary_units long, authority_model string, estimate_status string,"
    "evidence_method string, evidence_url string, effective_from string, effective_to string,"
    "notes string"
)

UNIT_CROSSWALK = _struct(
    "from_reporting_unit_id string, to_reporting_unit_id string, relationship_type string,"
    "evidence_source_id string, evidence_snapshot_sha256 string, weight double,"
    "weight_basis string, effective_from date, effective_to date,"
    "reconciliation_status string, note string"
)

GEO_CROSSWALK = _struct(
    "reporting_unit_id string, geographic_unit_id string, relationship_type string,"
    "evidence_source_id string, evidence_snapshot_sha256 string, effective_from date,"
    "effective_to date, allocation_weight double, weight_basis string,"
    "allocation_coverage string, unmapped_weight double, unmapped_basis string, note string"
)

EXECUTION_EVIDENCE = _struct(
    "state string, result_url string, access_family string, parser string, stage int,"
    "observation_count long, smallest_observed_unit string, vote_modes_preserved bool,"
    "failure_class string, snapshot_sha256 string"
)
