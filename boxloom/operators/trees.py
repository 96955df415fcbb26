"""Search trees as adjacency lists, and searches that expand all instances a level at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rollup(nodes: DataFrame, depth: int) -> DataFrame:
    """Leaves of every node: n_leaf, n_sat, min_depth, sat_ratio, n_children.

    `nodes` has id, parent, level (0 .. depth) and sat (0 or 1). A satisfied node counts as one leaf,
    whatever is below it. One aggregation and one join a level, from the deepest up.
    """
    below = None
    done = []
    for level in range(depth, -1, -1):
        own = nodes.where(F.col("level") == level)
        if below is None:
            tallied = own.select("*", *(F.lit(None).cast("bigint").alias(c) for c in ("k", "leaves", "sats")), F.lit(None).cast("int").alias("near"))
        else:
            sums = below.groupBy("parent").agg(
                F.count("*").alias("k"), F.sum("n_leaf").alias("leaves"), F.sum("n_sat").alias("sats"), F.min("min_depth").alias("near")
            ).withColumnRenamed("parent", "_of")
            tallied = own.join(sums, own["id"] == sums["_of"], "left").drop("_of")
        alone = (F.col("sat") == 1) | F.col("k").isNull()
        rolled = tallied.select(
            "id", "parent", "level", "sat", F.coalesce("k", F.lit(0)).cast("bigint").alias("n_children"),
            F.when(alone, F.lit(1)).otherwise(F.col("leaves")).cast("bigint").alias("n_leaf"),
            F.when(alone, F.col("sat")).otherwise(F.col("sats")).cast("bigint").alias("n_sat"),
            F.when(F.col("sat") == 1, F.col("level")).otherwise(F.col("near")).cast("int").alias("min_depth"),
        )
        done.append(rolled)
        below = rolled
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumn("sat_ratio", F.col("n_sat") / F.col("n_leaf"))


def decisions(nodes: DataFrame, least: int, deepest: int) -> DataFrame:
    """(state, level, n, best): nodes of a `rollup` that are a choice between children.

    A state counts if it is itself a node, no deeper than `deepest`, and has `least` or more children, one of
    which has a `sat_ratio` above 0. Children whose parent is null or no node are of no state.
    """
    states = nodes.where(F.col("level") <= deepest).select(F.col("id").alias("state"), "level")
    sets = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n"), F.max("sat_ratio").alias("best"))
    return states.join(sets.where((F.col("n") >= least) & (F.col("best") > 0)), F.col("parent") == F.col("state")).drop("parent")


def between_within(rows: DataFrame, group: str, value: str, by: list[str]) -> DataFrame:
    """Variance between and within groups, and the intraclass share between / (between + within)."""
    each = rows.groupBy(*by, group).agg(F.count("*").alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    total = each.groupBy(*by).agg(
        F.sum("n").alias("n"), F.count("*").alias("groups"), F.sum("s").alias("s"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("m"), F.sum("q").alias("q")
    )
    ssb, ssw = F.col("m") - F.col("s") * F.col("s") / F.col("n"), F.col("q") - F.col("m")
    return total.select(*by, "n", "groups", ssb.alias("ssb"), ssw.alias("ssw"), F.when(ssb + ssw > 0, ssb / (ssb + ssw)).alias("icc"))


class Search:
    """State-space search over numbers: an instance moves its value by edits towards its box [lo, hi].

    `instances`: id, value, lo, hi. `edits`: edit, delta. All instances step together; a level is one
    join with the edits (every edit is tried at each state; a table of up to `SMALL` of them is broadcast)
    and one or two windows, and solved instances leave the frontier. Lineage is cut by `checkpoint` each level.
    """

    SMALL = 1000

    def __init__(self, edits: DataFrame):
        self.edits = F.broadcast(edits) if edits.limit(self.SMALL + 1).count() <= self.SMALL else edits

    @staticmethod
    def gap(value: Column) -> Column:
        return F.greatest(F.lit(0.0), F.col("lo") - value, value - F.col("hi"))

    def expand(self, frontier: DataFrame) -> DataFrame:
        """All children: values that the path hasn't visited."""
        moved = F.round(F.col("value") + F.col("delta"), 6)
        return (
            frontier.crossJoin(self.edits).withColumn("next", moved).where(~F.array_contains("seen", F.col("next")))
            .select("id", "lo", "hi", F.col("next").alias("value"), self.gap(F.col("next")).alias("gap"), F.concat("path", F.array("edit")).alias("path"),
                    F.concat("seen", F.array("next")).alias("seen"))
        )

    def start(self, instances: DataFrame) -> DataFrame:
        value = F.col("value").cast("double")
        return instances.select("id", "lo", "hi", value.alias("value"), self.gap(value).alias("gap"), F.array().cast("array<string>").alias("path"), F.array(value).alias("seen"))

    def run(self, instances: DataFrame, depth: int, width: int | None, draw: str | None = None) -> DataFrame:
        """(id, value, gap, path, cost) of each instance's best state: greedy for width 1, beam, or exhaustive for None.

        A beam never builds a value again that any of its branches has built before; a greedy path only avoids
        its own values, an exhaustive one those of each path. With `draw`, a seed, the next state is drawn
        by hash instead: a random walk. The best is the smallest gap, then the shortest path, then the path
        itself; `cost` is the number of states that were looked at.
        """
        frontier = self.start(instances)
        order = ["gap", F.size("path"), F.array_join("path", ">")]
        best = F.struct("gap", F.size("path").alias("n"), F.array_join("path", ">").alias("key"), "value", "path").alias("best")
        tallies = frontier.select("id", F.lit(1).cast("bigint").alias("looked"), best)
        built = None
        for _ in range(depth):
            children = self.expand(frontier.where("gap > 0"))
            if width is not None:
                distinct = Window.partitionBy("id", "value").orderBy(*order)
                children = children.withColumn("_nth", F.row_number().over(distinct)).where("_nth = 1").drop("_nth")
            if width is not None and width > 1 and built is not None:
                children = children.join(built, ["id", "value"], "left_anti").select(*children.columns)
            by = [F.md5(F.concat_ws(":", F.lit(draw), "id", F.array_join("path", ">")).cast("binary"))] if draw is not None else order
            nth = F.row_number().over(Window.partitionBy("id").orderBy(*by))
            if draw is not None:
                children = children.withColumn("_nth", nth).where("_nth = 1").drop("_nth")
            children = self.cut(children)
            if width is not None and width > 1:
                made = children.select("id", "value")
                built = made if built is None else built.unionByName(made)
            tally = children.groupBy("id").agg(F.count("*").alias("looked"), F.min(best).alias("best"))
            tallies = tallies.unionByName(tally)
            frontier = children
            if width is not None and draw is None:
                frontier = children.withColumn("_nth", nth).where(F.col("_nth") <= width).drop("_nth")
            frontier = frontier.join(tally.where("best.gap = 0").select("id"), "id", "left_anti").select(*children.columns)
        whole = tallies.groupBy("id").agg(F.sum("looked").alias("cost"), F.min("best").alias("best"))
        return whole.select("id", "best.value", "best.gap", "best.path", "cost")

    def hybrid(self, instances: DataFrame, depth: int, width: int) -> DataFrame:
        """Greedy first, a beam for what that leaves unsolved, the better of the two; costs add up."""
        first = self.cut(self.run(instances, depth, 1))
        failed = instances.join(first.where("gap > 0").select("id"), "id", "left_semi")
        both = first.unionByName(self.run(failed, depth, width))
        best = F.struct("gap", F.size("path").alias("n"), F.array_join("path", ">").alias("key"), "value", "path")
        whole = both.groupBy("id").agg(F.sum("cost").alias("cost"), F.min(best).alias("best"))
        return whole.select("id", "best.value", "best.gap", "best.path", "cost")

    def labels(self, instances: DataFrame, depth: int) -> DataFrame:
        """(id, edit, y_success, y_short, y_greedy) of every first edit of each unsolved instance, by looking ahead.

        y_success: whether some path of `depth` edits that begins with it ends in the box; y_short: the
        fewest edits of such a path; y_greedy: whether the greedy path after it does.
        """
        first = self.cut(self.expand(self.start(instances).where("gap > 0")).select(F.struct("id", F.col("path")[0].alias("edit")).alias("id"), "value", "lo", "hi", F.col("seen")[0].alias("origin")))
        sought = lambda width: self.run(first.drop("origin"), depth - 1, width).select("id", (F.col("gap") == 0).alias("hit"), F.size("path").alias("more"))
        full, greedy = sought(None), sought(1)
        both = full.join(greedy.select("id", F.col("hit").alias("greedy")), "id")
        return both.select("id.id", "id.edit", F.col("hit").alias("y_success"), F.when(F.col("hit"), F.col("more") + 1).alias("y_short"), F.col("greedy").alias("y_greedy"))

    @staticmethod
    def cut(df: DataFrame) -> DataFrame:
        """Checkpoint to the shared folder; a local session without one gets a temporary folder."""
        sc = df.sparkSession.sparkContext
        if not sc.getCheckpointDir():
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            sc.setCheckpointDir(tempfile.mkdtemp(prefix="boxloom-"))
        return df.checkpoint()
