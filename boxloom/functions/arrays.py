"""Arrays, maps and records: bounds, calls with replies, segments, prefixes, lifted keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounds_list(bounds: Column) -> Column:
    """A map name -> (lo, hi) as records in order of name."""
    return F.array_sort(F.transform(F.map_entries(bounds), lambda e: F.struct(e["key"].alias("name"), e["value"]["lo"].alias("lo"), e["value"]["hi"].alias("hi"))))


def bounds_map(records: Column) -> Column:
    return F.map_from_entries(F.transform(records, lambda r: F.struct(r["name"], F.struct(r["lo"].alias("lo"), r["hi"].alias("hi")))))


def answered(calls: Column, replies: Column) -> Column:
    """(call, reply) pairs; what the shorter side lacks is null."""
    return F.transform(F.arrays_zip(calls.alias("c"), replies.alias("r")), lambda z: F.struct(z["c"].alias("call"), z["r"].alias("reply")))


def empty_replies(pairs: Column, name: str) -> Column:
    """Whether any call of that name has an empty reply, or none."""
    return F.exists(pairs, lambda p: (p["call"] == name) & F.coalesce(F.size(p["reply"]) <= 0, F.lit(True)))


def by_prefix(features: Column, prefixes: tuple[str, ...]) -> tuple[Column, Column]:
    """(global, candidate) features of a map, by the beginning of their names."""
    test = lambda k: F.lit(False) if not prefixes else k.rlike(f"^({'|'.join(prefixes)})")
    return F.map_filter(features, lambda k, _: test(k)), F.map_filter(features, lambda k, _: ~test(k))


def merged(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """`rows` with `fields`, which replace columns of the same name."""
    return rows.withColumns(fields)


def lifted(rows: DataFrame, key: str, nested: Column) -> DataFrame:
    """`rows` with `key` from a nested value where it has none of its own."""
    return rows.withColumn(key, F.coalesce(F.col(key), nested) if key in rows.columns else nested)


def joined_segments(segments: Column, header: int) -> Column:
    """Messages of all segments (index, messages) in order; those after the first without their `header` messages."""
    ordered = F.array_sort(segments)
    return F.flatten(F.transform(ordered, lambda s, i: F.when(i == 0, s["messages"]).otherwise(F.slice(s["messages"], header + 1, 1_000_000))))


def prefix(messages: Column, n: Column | int) -> Column:
    return F.slice(messages, 1, n)
