from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from spendmill import load_drifting  # noqa: I001
from spendmill import (
    EVENTS_V1,
    EVENTS_V2,
    clean_events,
    detect_version,
    exact_dedup,
    file_version,
    keep_payload,
    load_events,
    rescue_unknown,
    tag_provenance,
    union_versions,
)
from spendmill.operators.checks import distinct_sample, version_population

HEAD = "event_id,event_time,ingest_time,advertiser_id,currency"


@pytest.fixture()
def files(tmp_path):
    v1 = tmp_path / "events_v1.csv"
    v1.write_text(
        f"{HEAD},spend\n"
        "e1,2024-01-01T10:00:00Z,2024-01-01T11:00:00Z,adv_1,USD,5.0\n"
        "e2,N/A,2024-01-01T11:00:00Z,adv_2,INR,83.0\n"
        "e2,N/A,2024-01-01T11:00:00Z,adv_2,INR,83.0\n"
        "e3,2024-01-01T10:00:00Z,2024-01-01T11:00:00Z,adv_1,USD,-1.0\n"
        "e3,2024-01-01T10:00:00Z,2024-01-01T12:00:00Z,adv_1,USD,4.0\n"
        "e4,2024-01-01T10:00:00Z,2024-01-01T12:00:00Z,adv_1,USD,\n"
    )
    v2 = tmp_path / "events_v2.csv"
    v2.write_text(f"{HEAD},media_cost,viewability\ne5,2024-01-01T10:00:00+05:30,2024-01-01T11:00:00Z,adv_1,USD,7.0,0.5\n")
    return str(v1), str(v2)


def test_csv_versions_merge_by_name_with_provenance(spark, files):
    v1 = tag_provenance(load_events(spark, files[0], EVENTS_V1), "v1", "events_v1.csv")
    v2 = tag_provenance(load_events(spark, files[1], EVENTS_V2), "v2", F.col("_metadata.file_path"))
    both = union_versions(v1, v2)
    assert {f.name for f in both.schema if not f.nullable} >= {"schema_version", "ingested_at"}
    got = {r.schema_version: r.asDict() for r in version_population(both).collect()}
    assert got["v1"] == {"schema_version": "v1", "spend_populated": 5, "media_cost_populated": 0, "viewability_populated": 0}
    assert got["v2"] == {"schema_version": "v2", "spend_populated": 0, "media_cost_populated": 1, "viewability_populated": 1}
    assert both.where("schema_version = 'v2'").first().source_file.endswith("events_v2.csv")


def test_tag_uses_given_time(spark):
    at = F.lit("2024-02-01T00:00:00Z").cast("timestamp")
    row = tag_provenance(spark.range(1), "v1", "f.csv", at).select(F.col("ingested_at").cast("timestamp_ntz")).first()
    assert row[0] == dt.datetime(2024, 2, 1)


def test_three_versions_in_any_order(spark):
    a, b, c = (spark.createDataFrame([(1, 2)], f"id int, {n} int") for n in "xyz")
    assert union_versions(c, a, b).columns == ["id", "z", "x", "y"]
    with pytest.raises(ValueError):
        union_versions()


def test_header_that_disagrees_with_the_schema_fails(spark, files):
    with pytest.raises(Exception, match="header"):
        load_events(spark, files[1], EVENTS_V1).collect()


def test_malformed_line_is_kept(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(f"{HEAD},spend\ne1,2024-01-01T10:00:00Z,not a time,adv_1,USD,abc\n")
    schema = type(EVENTS_V1)(EVENTS_V1.fields).add("_corrupt_record", "string")
    row = load_events(spark, str(path), schema).first()
    assert row.event_id == "e1" and row.spend is None and "abc" in row._corrupt_record


def test_clean_events_drops_every_row_of_a_negative_key(spark, files):
    rows = clean_events(load_events(spark, files[0], EVENTS_V1)).collect()
    assert sorted(r.event_id for r in rows) == ["e1", "e2"]


def test_exact_dedup_keeps_resent_ids(spark, files):
    ids = sorted(r.event_id for r in exact_dedup(load_events(spark, files[0], EVENTS_V1)).collect())
    assert ids == ["e1", "e2", "e3", "e3", "e4"]


def test_version_is_told_from_populated_columns(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, None, 0.4), (3, None, None)], "id int, media_cost double, viewability double")
    assert [r.schema_version for r in detect_version(df).orderBy("id").collect()] == ["v2", "v2", "v1"]
    assert detect_version(df.select("id")).first().schema_version == "v1"
    assert (file_version(df.columns), file_version(["id", "spend"])) == ("v2", "v1")


def test_rescue_and_payload_lose_nothing(spark):
    df = spark.sql("SELECT 'e1' AS event_id, TIMESTAMP '2024-01-01 00:00:00.123456' AS seen, CAST(NULL AS INT) AS extra UNION ALL SELECT 'e2', NULL, NULL")
    rows = {r.event_id: r for r in rescue_unknown(df, ["event_id"]).collect()}
    assert json.loads(rows["e1"]._rescued_data) == {"seen": "2024-01-01T00:00:00.123456Z", "extra": None}
    assert rows["e2"]._rescued_data is None
    assert rescue_unknown(df, df.columns).first()._rescued_data is None
    assert json.loads(keep_payload(df).where("event_id = 'e2'").first()._payload) == {"event_id": "e2", "seen": None, "extra": None}


def test_distinct_sample_is_deterministic(spark):
    df = spark.range(100).select((F.col("id") % 30).alias("k"))
    assert [r.k for r in distinct_sample(df, ["k"], 10).collect()] == list(range(10))


def test_drifting_files_lose_nothing(spark, tmp_path):
    """Two headers in one folder: other order, extra columns, a bad number and a missing column."""
    (tmp_path / "a.csv").write_text(
        "campaign,event_id,event_time,ingest_time,advertiser_id,currency,spend,clicks\n"
        'c1,1,2024-01-01T00:00:00Z,2024-01-01T01:00:00Z,7,USD,1.5,9\n"c,2",2,N/A,2024-01-01T01:00:00Z,7,USD,oops,\n'
    )
    (tmp_path / "b.csv").write_text("event_id,media_cost,viewability,currency\n3,2.5,0.7,INR\n")
    got = {r.event_id: r for r in load_drifting(spark, str(tmp_path), EVENTS_V1).collect()}
    assert set(got) == {"1", "2", "3"}
    assert (got["1"].spend, got["1"].schema_version, got["1"]._corrupt_record) == (1.5, "v1", None)
    assert json.loads(got["1"]._rescued_data) == {"campaign": "c1", "clicks": "9"}
    assert got["2"].spend is None and "oops" in got["2"]._corrupt_record
    assert json.loads(got["2"]._rescued_data) == {"campaign": "c,2", "clicks": None}
    assert (got["3"].spend, got["3"].schema_version, got["3"].currency) == (None, "v2", "INR")
    assert json.loads(got["3"]._rescued_data) == {"media_cost": "2.5", "viewability": "0.7"}
    assert got["3"].source_file.endswith("b.csv")
