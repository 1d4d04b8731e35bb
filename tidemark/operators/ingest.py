"""Ingest: parse, validate, default and enrich events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import now_millis
from tidemark.schemas import WIRE_NAMES


def parse_events(bodies: DataFrame, schema: T.StructType, body: str = "body") -> DataFrame:
    """One event from each JSON object, or several from each JSON array; what cannot be parsed has a null event."""
    one = F.array(F.from_json(F.col(body), schema))
    many = F.from_json(F.col(body), T.ArrayType(schema))
    is_many = F.ltrim(F.col(body)).startswith("[")
    return bodies.select("*", F.explode_outer(F.when(is_many, many).otherwise(one)).alias("event"))


#: A check of an item: from its JSON text, what is wrong with it, or null.
Validator = Callable[[Column], Column]


def _checked(bodies: DataFrame, mandatory: Sequence[str], body: str, validators: Sequence[Validator] = ()) -> DataFrame:
    keys = F.json_object_keys(F.col(body))
    problem = F.coalesce(*(v(F.col(body)) for v in validators), F.lit(None).cast("string"))
    for tag in reversed(mandatory):
        problem = F.when(~F.array_contains(keys, tag), F.lit(f"{tag} is mandatory")).otherwise(problem)
    return bodies.withColumn("detail", F.when(keys.isNull(), F.lit("not a JSON object")).otherwise(problem))


def accepted(bodies: DataFrame, mandatory: Sequence[str], body: str = "body", validators: Sequence[Validator] = ()) -> DataFrame:
    """Bodies in which every mandatory key is present, its value may be null, and that every validator passes."""
    return _checked(bodies, mandatory, body, validators).filter(F.col("detail").isNull()).drop("detail")


def rejected(bodies: DataFrame, mandatory: Sequence[str], body: str = "body", validators: Sequence[Validator] = ()) -> DataFrame:
    """Bodies that fail, with the first missing key, or else what the first validator says, in ``detail``, and success =
    false."""
    return _checked(bodies, mandatory, body, validators).filter(F.col("detail").isNotNull()).withColumn("success", F.lit(False))


def batch_items(bodies: DataFrame, body: str = "body") -> DataFrame:
    """A row for each item of a JSON array, with its place in it (``item``) and its text as the body; a body that is no
    array is one item of place 0, to be rejected or taken by the same checks."""
    items = F.from_json(F.col(body), T.ArrayType(T.StringType()))
    several = F.ltrim(F.col(body)).startswith("[")
    listed = F.when(several & items.isNotNull(), items).otherwise(F.array(F.col(body)))
    others = [c for c in bodies.columns if c != body]
    return bodies.select(*others, F.posexplode(listed).alias("item", body))


def batch_answers(bodies: DataFrame, key: str, mandatory: Sequence[str], body: str = "body", validators: Sequence[Validator] = ()) -> DataFrame:
    """What a batch request gets back, a row for each ``key``: status 200, or 400 with the failures as a JSON array."""
    items = _checked(batch_items(bodies, body), mandatory, body, validators)
    failure = F.when(F.col("detail").isNotNull(), F.struct("item", F.lit(False).alias("success"), "detail"))
    found = items.groupBy(key).agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list(failure)).alias("failed"))
    status = F.when(F.size("failed") == 0, F.lit(200)).otherwise(F.lit(400))
    return found.select(key, "n_items", status.alias("status"), F.to_json("failed").alias("failures"))


def with_origin(events: DataFrame, **attributes: Column) -> DataFrame:
    """Derived attributes beside the whole original event as one column."""
    return events.select(*(c.alias(n) for n, c in attributes.items()), F.struct("*").alias("originEvent"))


def with_event_time(events: DataFrame, default: Column | None = None) -> DataFrame:
    """Fill a null ct; by default with the clock."""
    return events.withColumn("ct", F.coalesce("ct", now_millis() if default is None else default))


def enriched(events: DataFrame) -> DataFrame:
    """Flatten the structs device and geo beside the columns of the original event, under their wire names."""
    names = {"device.agent_version": "browser_version", "device.agent_family": "browser", "device.agent_name": "device", "device.category": "device_class", "device.os": "os", "device.os_version": "os_version"}
    names |= {"geo.city": "city", "geo.continent": "continent", "geo.country": "country", "geo.region": "region", "geo.longitude": "longitude", "geo.latitude": "latitude", "geo.postal": "postal_code"}
    return events.select(*(F.col(c).alias(WIRE_NAMES[n]) for c, n in names.items()), *(c for c in events.columns if c not in ("device", "geo")))
