"""Location of an IPv4 address, by a table of address blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A block table of at most this many rows, once cut, is broadcast; a larger one is joined by shuffle on the same keys.
BROADCAST_ROWS = 200_000


def ip_number(ip: Column) -> Column:
    """The address as a number, or null if it is no IPv4 address."""
    parts = F.split(ip, r"\.")
    number = sum((F.try_element_at(parts, F.lit(i + 1)).try_cast("long") * F.lit(256 ** (3 - i)) for i in range(4)), F.lit(0))
    small = F.forall(parts, lambda p: p.try_cast("int") <= 255)
    return F.when(ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & small, number)


def with_location(events: DataFrame, blocks: DataFrame, ip: str = "ipv4") -> DataFrame:
    """Add ``geo``, the location struct of the block (first, last, location columns) that holds the address.

    A null address gives a struct of nulls, an address in no block a null struct. Blocks are cut at /16 borders, so the
    range join is an equi-join on the upper half of the address. Blocks must not overlap.
    """
    columns = [c for c in blocks.columns if c not in ("first", "last")]
    cut = blocks.select("*", F.explode(F.sequence(F.shiftright("first", 16), F.shiftright("last", 16))).alias("_upper"))
    cut = cut.select("_upper", F.col("first").alias("_first"), F.col("last").alias("_last"), F.struct(*columns).alias("geo"))
    cut = F.broadcast(cut) if cut.count() <= BROADCAST_ROWS else cut
    rows = events.withColumn("_number", ip_number(F.col(ip)))
    inside = (F.shiftright(F.col("_number"), 16) == F.col("_upper")) & F.col("_number").between(F.col("_first"), F.col("_last"))
    out = rows.join(cut, inside, "left")
    empty = F.struct(*(F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in columns))
    return out.withColumn("geo", F.when(F.col(ip).isNull(), empty).otherwise(F.col("geo"))).drop("_number", "_upper", "_first", "_last")
