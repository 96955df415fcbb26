"""Filters, joins and audits over conversation and document corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefix_of(ident: Column) -> Column:
    """What stands before the first `__` of a group id, empty without one."""
    return F.when(F.instr(ident, "__") > 0, F.substring_index(ident, "__", 1)).otherwise("")


def task_of(ident: Column) -> Column:
    """What stands before the last `__` of a group id, null without one."""
    return F.when(F.instr(ident, "__") > 0, F.regexp_extract(ident, "(?s)^(.*)__", 1))


def drop_polluted(rows: DataFrame, group: str, polluted: Column) -> DataFrame:
    """All rows of groups in which no row is polluted. A missing group id counts as a group of its own, decided by one aggregate."""
    bad = rows.where(polluted).select(F.col(group).alias("_bad")).distinct()
    named = rows.where(F.col(group).isNotNull()).join(bad, rows[group] == bad["_bad"], "left_anti")
    fine = bad.where("_bad IS NULL").agg((F.count("*") == 0).alias("_fine"))  # one row
    return named.unionByName(rows.where(F.col(group).isNull()).crossJoin(F.broadcast(fine)).where("_fine").drop("_fine"))


def keep_first(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order; unlike dropDuplicates, which keeps any. Partial aggregates on a digest of
    the key find it, so neither long keys nor all rows of a hot key are gathered."""
    digest = F.sha2(F.to_json(F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(key)))), 256)
    first = rows.groupBy(digest.alias("_d")).agg(F.min(F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("_o"))
    return rows.withColumn("_d", digest).withColumn("_o", F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).join(first, ["_d", "_o"], "left_semi").drop("_d", "_o")


def repaired(old: Column, fresh: Column, committed: Column) -> tuple[Column, Column]:
    """(reply, why): the recomputed reply, but the stored one where that is empty or lacks the committed edit."""
    missing = committed.isNotNull() & ~F.array_contains(fresh, committed)
    empty = F.size(fresh) <= 0
    why = F.when(missing, "still_missing").when(empty, "still_empty").when(fresh == old, "identical").otherwise("rewritten")
    return F.when(missing | empty, old).otherwise(fresh), why


def accepted_revision(text: Column, violations: Column, revisions: Column) -> Column:
    """(text, violations) after revisions in order, each taken only if it has strictly fewer violations; the first that has not ends it, as no violation does."""
    start = F.struct(text.alias("text"), violations.alias("violations"), F.lit(True).alias("open"))
    better = lambda a, r: a["open"] & (a["violations"] > 0) & (r["violations"] < a["violations"])
    step = lambda a, r: F.when(better(a, r), F.struct(r["text"].alias("text"), r["violations"].alias("violations"), F.lit(True).alias("open"))).otherwise(
        F.struct(a["text"].alias("text"), a["violations"].alias("violations"), F.lit(False).alias("open"))
    )
    return F.aggregate(revisions, start, step)


def rekey(delta: DataFrame, base: DataFrame, task: str, ident: str, order: list[str]) -> DataFrame:
    """`delta` (with its `task`) with the group id of `base`; the first base row of a task wins, others have none and go."""
    first = base.groupBy(task).agg(F.min_by(ident, F.struct(*order)).alias("base_id"))
    return delta.join(first, task)


def sessions(rows: DataFrame, by: str, order: list[str], starts: Column) -> DataFrame:
    """`rows` with `round`: rows before a start belong to the round that it opens, those after the last to a round of their own."""
    upto = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("round", F.coalesce(F.sum(starts.cast("int")).over(upto), F.lit(0)).cast("int"))


def carried(rows: DataFrame, by: str, order: list[str], value: Column) -> Column:
    """The last value that is not null, up to this row."""
    upto = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(upto)


def containing(texts: DataFrame, ident: str, text: str, passages: DataFrame, item: str, passage: str) -> DataFrame:
    """(ident, item) where a text contains a passage as a whole.

    A passage is looked for only in texts that hold its anchor, the longest of its inner words (the
    outer two may be parts of longer words in the text), so the join is on words and only candidates
    are compared as a whole. Passages of fewer than three words have no anchor and are compared with
    all texts.
    """
    words = lambda c: F.split(F.trim(F.regexp_replace(c, "\\s+", " ")), " ")
    asked = passages.select(item, F.col(passage).alias("_passage")).where(F.length("_passage") > 0).withColumn("_w", words(F.col("_passage")))
    longest = F.array_max(F.transform(F.slice("_w", 2, F.greatest(F.size("_w") - 2, F.lit(0))), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    asked = asked.withColumn("_anchor", longest["w"]).drop("_w")
    own = texts.select(ident, F.col(text).alias("_text"))
    keys = own.select(ident, F.explode(F.array_distinct(words(F.col("_text")))).alias("_anchor"))
    met = keys.join(asked.where("_anchor IS NOT NULL"), "_anchor").select(ident, item, "_passage")
    found = met.join(own, ident).where(F.contains("_text", "_passage")).select(ident, item)
    short = asked.where("_anchor IS NULL").select(item, "_passage")
    return found.unionByName(own.join(short, F.contains("_text", "_passage")).select(ident, item))
