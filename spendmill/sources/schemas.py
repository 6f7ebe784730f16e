"""Explicit schemas, so no file is ever scanned to guess types."""

from __future__ import annotations

from pyspark.sql import types as T

_COMMON = [
    T.StructField("event_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("ingest_time", T.TimestampType()),
    T.StructField("advertiser_id", T.StringType()),
    T.StructField("currency", T.StringType()),
]

# The vendor's column names in file versions 1 and 2.
EVENTS_V1 = T.StructType([*_COMMON, T.StructField("spend", T.DoubleType())])
EVENTS_V2 = T.StructType(
    [*_COMMON, T.StructField("media_cost", T.DoubleType()), T.StructField("viewability", T.DoubleType())]
)
#: Every column that any file version may have.
EVENTS_ANY = T.StructType([*EVENTS_V1.fields, *EVENTS_V2.fields[len(_COMMON) :]])
ADVERTISERS = T.StructType(
    [T.StructField("advertiser_id", T.StringType()), T.StructField("advertiser_name", T.StringType())]
)
