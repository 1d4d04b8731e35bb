"""Device attributes of a user agent, by a table of patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns in order of precedence: name, what the agent contains, and where the version is.
OPERATING_SYSTEMS = [
    ("iOS", r"iPhone|iPad|iPod", r"OS (\d+(?:[_.]\d+)*)"),
    ("Android", r"Android", r"Android (\d+(?:\.\d+)*)"),
    ("Windows", r"Windows", r"Windows NT (\d+(?:\.\d+)*)"),
    ("OS X", r"Mac OS X|Macintosh", r"Mac OS X (\d+(?:[_.]\d+)*)"),
    ("Linux", r"Linux|X11", r"(\b)"),
]
AGENTS = [
    ("Robot", "robot", r"(?i)bot\b|crawler|spider", r"(?i)(?:bot|crawler|spider)/(\d+(?:\.\d+)*)"),
    ("Edge", "browser", r"Edge?/|EdgA/", r"Edg[eA]?/(\d+(?:\.\d+)*)"),
    ("Opera", "browser", r"OPR/|Opera", r"(?:OPR|Opera)[/ ](\d+(?:\.\d+)*)"),
    ("Chrome", "browser", r"Chrome/|CriOS/", r"(?:Chrome|CriOS)/(\d+(?:\.\d+)*)"),
    ("Firefox", "browser", r"Firefox/|FxiOS/", r"(?:Firefox|FxiOS)/(\d+(?:\.\d+)*)"),
    ("IE", "browser", r"MSIE |Trident/", r"(?:MSIE |rv:)(\d+(?:\.\d+)*)"),
    ("Safari", "browser", r"Safari/", r"Version/(\d+(?:\.\d+)*)"),
]
CATEGORIES = [("Tablet", r"iPad|Tablet|Android(?!.*Mobile)"), ("Smartphone", r"iPhone|iPod|Mobile"), ("Robot", r"(?i)bot\b|crawler|spider"), ("Personal computer", r"Windows|Macintosh|X11|Linux")]


def _first(agent: Column, table, of) -> Column:
    out = F.lit(None).cast("string")
    for row in reversed(table):
        out = F.when(agent.rlike(row[-2] if len(row) > 2 else row[1]), of(row)).otherwise(out)
    return out


def device_info(agent: Column) -> Column:
    """A struct of device attributes; every field is null if the agent is null or unknown."""
    version = lambda row: F.nullif(F.regexp_extract(agent, row[-1], 1), F.lit(""))
    name, kind = (_first(agent, AGENTS, lambda r, i=i: F.lit(r[i])) for i in (0, 1))
    agent_version = _first(agent, AGENTS, version)
    return F.struct(
        _first(agent, CATEGORIES, lambda r: F.lit(r[0])).alias("category"),
        _first(agent, OPERATING_SYSTEMS, lambda r: F.lit(r[0])).alias("os"),
        F.translate(_first(agent, OPERATING_SYSTEMS, version), "_", ".").alias("os_version"),
        F.concat_ws(" ", name, agent_version).alias("agent_name"),
        kind.alias("agent_type"),
        name.alias("agent_family"),
        agent_version.alias("agent_version"),
    )
