"""Typed columns from JSON objects, and a rest column that keeps what has no column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a value's type in the JSON may be for a column of each kind, which then holds all
#: of its digits.
FITTING = {"bigint": "^BIGINT$", "double": r"^(DOUBLE|FLOAT|DECIMAL\((1[0-5]|[1-9]),\d+\))$",
           "string": "^STRING$", "boolean": "^BOOLEAN$"}
#: Types that speak for no kind: nulls, and numbers too long for a column.
NEUTRAL = r"^(VOID|DECIMAL\(.*\))$"
EXACT = 2**53


@dataclass(frozen=True)
class Property:
    """A key of the objects that has a column of its own."""

    name: str
    kind: str

    def fits(self, value: Column) -> Column:
        fits = F.schema_of_variant(value).rlike(FITTING[self.kind])
        if self.kind == "double":
            whole = F.try_variant_get(value, "$", "bigint")
            fits = fits | ((F.schema_of_variant(value) == "BIGINT") & whole.between(-EXACT, EXACT))
        return fits

    def value(self, held: Column) -> Column:
        own = held[self.name]
        return F.when(self.fits(own), F.try_variant_get(own, "$", self.kind))


def objects(column: str) -> Column:
    """The object's keys and values; null for a null, malformed or other JSON."""
    return F.from_json(F.col(column), "map<string,variant>")


def discover(df: DataFrame, column: str, min_share: float = 0.01) -> list[Property]:
    """Keys that at least ``min_share`` of the objects have with values of one scalar kind.

    Keys and kinds are counted before the shuffle. Nulls, and numbers that no column can
    hold to the last digit, speak for no kind; whole and other numbers make a double; a
    key with values of several kinds, or with objects or arrays, gets no column. The driver gets the keys above the share, which are at most
    the mean number of keys in an object over ``min_share``.
    """
    held = df.select(objects(column).alias("_map")).where("_map is not null")
    pairs = held.select(F.explode("_map").alias("name", "value"))
    kind = F.schema_of_variant("value")
    named = pairs.select("name", F.when(kind.rlike(FITTING["double"]), "double")
                         .when(kind.rlike(NEUTRAL), "neutral").when(kind.rlike("^(OBJECT|ARRAY)"), "nested").otherwise(F.lower(kind)).alias("kind"))
    counted = named.groupBy("name", "kind").agg(F.count(F.lit(1)).alias("n")).groupBy("name").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_set("kind")).alias("kinds"))
    enough = F.ceil(F.lit(min_share) * F.lit(1.0) * held.agg(F.count(F.lit(1))).scalar())
    out = []
    for row in counted.where(F.col("n") >= enough).orderBy("name").collect():
        kinds = set(row.kinds) - {"neutral"}
        if kinds == {"bigint", "double"}:
            kinds = {"double"}
        if len(kinds) == 1 and (found := kinds.pop()) in FITTING:
            out.append(Property(row.name, found))
    return out


def shred(df: DataFrame, column: str, properties: Sequence[Property], *, prefix: str = "",
          rest: str = "rest", malformed: str = "malformed") -> DataFrame:
    """``df`` without ``column``, with a column per property, ``rest`` and ``malformed``.

    ``rest`` is the object of all other keys, and of the values that do not fit their
    column, nulls included, so nothing is lost; null when nothing is left. ``malformed``
    is the text that is no JSON object. New names must be free in ``df``.
    """
    held = F.col("_map")
    known = {p.name: p for p in properties}

    def left(name: Column, value: Column) -> Column:
        taken = F.lit(False)
        for p in known.values():
            taken = taken | ((name == p.name) & p.fits(value))
        return ~taken

    others = F.map_filter(held, left)
    return df.withColumn("_map", objects(column)).select(
        *(c for c in df.columns if c != column),
        *(p.value(held).alias(f"{prefix}{p.name}") for p in properties),
        F.when(F.size(others) > 0, F.to_json(others)).alias(rest),
        F.when(held.isNull(), F.col(column)).alias(malformed))
