"""Point, range and top-n queries over metric tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("group", "country_group", "top_group", "counters")
MINUTE = 60_000


def _floor(millis: int | None) -> int | None:
    return None if millis is None else millis - millis % MINUTE


@dataclass(frozen=True)
class MetricQuery:
    """A query by name, group, exact time, or half-open time range; start and end are taken down to the minute."""

    kind: str
    name: str | None = None
    group: str | None = None
    time: int | None = None
    start: int | None = None
    end: int | None = None
    limit: int = 10

    @classmethod
    def from_parameters(cls, kind: str, parameters: Mapping[str, str]) -> MetricQuery:
        """From a query string's parameters, whose names are in any case."""
        p = {k.lower(): v for k, v in parameters.items()}
        number = lambda k: int(p[k]) if p.get(k) else None
        return cls(kind, p.get("metricname"), p.get("groupid"), number("metrictime"), _floor(number("starttime")), _floor(number("endtime")), number("maxcount") or 10)

    def condition(self) -> Column | None:
        """The most specific condition that the parameters allow: triple, range, exact time, name, all."""
        name, group, time = F.col("metricname") == self.name, F.col("groupid") == self.group, F.col("metrictime") == self.time
        between = (F.col("metrictime") >= F.lit(self.start)) & (F.col("metrictime") < F.lit(self.end))
        ranged = self.start is not None and self.end is not None
        if self.kind == "group":
            if None not in (self.name, self.group, self.time):
                return name & time & group
            if self.name is not None:
                return name & between if ranged else name & time if self.time is not None else name
            return None
        if self.kind == "country_group":
            if None in (self.name, self.group):
                return None
            return name & group & (between if ranged else time if self.time is not None else F.lit(True))
        if self.name is None:
            raise ValueError(f"a {self.kind} query needs a metric name")
        if self.kind == "counters":
            return name & group if self.group is not None else name
        return name & (between if ranged else time if self.time is not None else F.lit(True))

    def run(self, table: DataFrame) -> DataFrame:
        if self.kind not in KINDS:
            raise ValueError(f"no queries for {self.kind}")
        condition = self.condition()
        rows = table if condition is None else table.filter(condition)
        if self.kind == "top_group":
            return rows.orderBy("metrictime", F.desc("value"), "groupid").limit(self.limit)
        return rows


def with_tags(rows: DataFrame) -> DataFrame:
    """Fold the tag_* columns into one map."""
    tags = [c for c in rows.columns if c.startswith("tag_")]
    folded = F.create_map(*(x for t in tags for x in (F.lit(t), F.col(t)))) if tags else F.create_map().cast("map<string,string>")
    return rows.select(*(c for c in rows.columns if c not in tags), folded.alias("tags"))


def as_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("*")).alias("json"))


def totals(rows: DataFrame, by: str) -> DataFrame:
    """Sum of value by group or tag, largest first."""
    return rows.groupBy(by).agg(F.sum("value").alias("value")).orderBy(F.desc("value"), by)


def trend(rows: DataFrame, group: str) -> DataFrame:
    return rows.filter(F.col("groupid") == group).orderBy("metrictime")
