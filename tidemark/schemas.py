"""Event schemas, and the short names that producers and feeds use on the wire."""

from __future__ import annotations

from pyspark.sql import types as T

# The wire name of each attribute of an enriched event.
WIRE_NAMES = {
    "browser_version": "_dd_bv",
    "browser": "_dd_bf",
    "device": "_dd_d",
    "device_class": "_dd_dc",
    "os": "_dd_os",
    "os_version": "_dd_osv",
    "city": "_cty",
    "continent": "_con",
    "country": "_cn",
    "region": "_rgn",
    "longitude": "_lon",
    "latitude": "_lat",
    "postal_code": "_tlcn",
}

_TEXT, _NUMBER = T.StringType(), T.LongType()

# The columns of a raw event and of a tweet.
RAW_EVENT = (
    T.StructType()
    .add("si", _TEXT)
    .add("tn", _TEXT)
    .add("or", _TEXT)
    .add("ct", _NUMBER)
    .add("ua", _TEXT)
    .add("ipv4", _TEXT)
    .add("ipv6", _TEXT)
    .add("rf", _TEXT)
    .add("et", _TEXT)
)
TWEET = T.StructType().add("country", _TEXT).add("lang", _TEXT).add("user", _TEXT).add("hashtag", _TEXT).add("ct", _NUMBER).add("text", _TEXT)
