"""Ranking candidate edits: how much closer to a target box does each bring a state?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import box
from ..functions.normal import phi


class Target:
    """A state's properties with their target boxes: name -> (value now, lo, hi, scale). A bound may be None."""

    def __init__(self, props: dict[str, tuple[float, float | None, float | None, float]]):
        self.props = props

    def terms(self, shift: dict[str, Column] | None = None) -> list[tuple[Column, Column, Column, float]]:
        """(value after the shift, lo, hi, scale) of each property."""
        side = lambda b: F.lit(b).cast("double")
        return [(F.lit(v) + shift[p] if shift else F.lit(v), side(lo), side(hi), s) for p, (v, lo, hi, s) in self.props.items()]

    def gap(self, shift: dict[str, Column] | None = None) -> Column:
        return box.norm_gap(self.terms(shift))


def chances(target: Target, delta: dict[str, Column], std: dict[str, Column]) -> list[Column]:
    """For each property the chance that it lands in its box, under normal spread; no spread counts as 1e-6."""
    out = []
    for (v, lo, hi, _), p in zip(target.terms(delta), target.props):
        spread = F.greatest(std[p], F.lit(1e-6))
        upper, lower = F.coalesce(phi((hi - v) / spread), F.lit(1.0)), F.coalesce(phi((lo - v) / spread), F.lit(0.0))
        out.append(F.least(F.greatest(upper - lower, F.lit(0.0)), F.lit(1.0)))
    return out


def objective(target: Target, delta: dict[str, Column], std: dict[str, Column], kind: str, reach: dict[str, float] | None = None) -> Column:
    """Larger is better.

    `gap`: reduction of the normalised gap; `count`: boxes held; `minmax`: gaps as shares of the farthest
    that the population gets outside the box (`reach`, see `farthest`); `worst`: the largest normalised
    gap; `gapstd`: the mean gap at both ends of the interval of one deviation; `prob`: expected number of
    boxes held under normal spread; `joint` and `weakest`: the product and the least of these chances.
    """
    after = target.terms(delta)
    off = [box.distance(v, lo, hi) for v, lo, hi, _ in after]
    scales = [s for *_, s in target.props.values()]
    if kind == "gap":
        return target.gap() - target.gap(delta)
    if kind == "count":
        return box.total([box.inside(v, lo, hi).cast("double") for v, lo, hi, _ in after])
    if kind == "minmax":
        return -box.total([d / F.lit((reach or {})[p]) for d, p in zip(off, target.props)])
    if kind == "worst":
        return -F.greatest(*(d / F.lit(s) for d, s in zip(off, scales)), F.lit(0.0))
    if kind == "gapstd":
        ends = [(box.distance(v + std[p], lo, hi) + box.distance(v - std[p], lo, hi)) / 2 for (v, lo, hi, _), p in zip(after, target.props)]
        return -box.total([d / F.lit(s) for d, s in zip(ends, scales)])
    if kind == "prob":
        return box.total(chances(target, delta, std))
    if kind == "joint":
        return reduce(lambda a, b: a * b, chances(target, delta, std))
    if kind == "weakest":
        return F.least(*chances(target, delta, std), F.lit(1.0))
    raise ValueError(f"unknown objective {kind}")


def farthest(target: Target, population: dict[str, tuple[float, float]]) -> dict[str, float]:
    """How far outside its box each property can get within its population's range."""
    out = {}
    for p, (_, lo, hi, _) in target.props.items():
        low, high = population[p]
        out[p] = max(0.0 if lo is None else lo - low, 0.0 if hi is None else high - hi, 1e-9)
    return out


def eligible(target: Target, delta: dict[str, Column], std: dict[str, Column], kind: str, gate: str = "strict", reach: dict[str, float] | None = None) -> Column:
    """Whether an edit may be returned: the objective must beat that of no edit; with gate `lex`, `count` may also
    stay equal if the gap shrinks."""
    still = {p: F.lit(0.0) for p in target.props}
    value = objective(target, delta, std, kind, reach)
    now = objective(target, still, still, "count" if kind == "prob" else kind, reach)
    if kind == "count":
        better = value > now
        return better | ((value == now) & (objective(target, delta, std, "gap") > 1e-9)) if gate == "lex" else better
    return value > now + 1e-9


def suggested(moves: DataFrame, target: Target, delta: dict[str, Column], std: dict[str, Column], rule: list[str], key: str, k: int, kind: str = "gap",
              gate: str = "strict", tie: str = "key", allowed: Column | None = None, screen: int | None = None, refined: dict[str, Column] | None = None,
              cap: int = 2, seed: str = "0", reach: dict[str, float] | None = None) -> DataFrame:
    """The `k` edits to offer: screened, guarded, refined, ranked again and emitted, each rule's best first.

    Screen: eligible edits by their context-free change, all or the `screen` best. Guard: `allowed`. Refine:
    `refined` has each property's change in the state's own context, null where there is none; the
    objective and the gate are taken again from it. Ties go by `tie`: `gap` (the reduction), `random`
    (a hash of seed and key) or `key`. At most `cap` variants of a rule are kept.
    """
    tied = {"gap": -objective(target, delta, std, "gap"), "random": F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), "key": F.lit(0)}[tie]
    found = moves.where(eligible(target, delta, std, kind, gate, reach))
    if screen is not None:
        found = found.withColumn("_screen", F.round(objective(target, delta, std, kind, reach), 6)).orderBy(F.desc("_screen"), key).limit(screen).drop("_screen")
    if allowed is not None:
        found = found.where(allowed)
    if refined:
        delta = {p: F.coalesce(refined[p], d) if p in refined else d for p, d in delta.items()}
        found = found.where(eligible(target, delta, std, kind, gate, reach))
    scored = found.withColumn("score", F.round(objective(target, delta, std, kind, reach), 6)).withColumn("_tie", tied)
    nth = F.row_number().over(Window.partitionBy(*rule).orderBy(F.desc("score"), "_tie", key))
    best = scored.withColumn("variant", nth).where(F.col("variant") <= cap)
    return best.orderBy("variant", F.desc("score"), "_tie", key).limit(k).drop("_tie")


def top(moves: DataFrame, score: Column, key: str, k: int) -> DataFrame:
    """The `k` best, with ties to the smaller key; one pass of partial heaps, no global sort."""
    return moves.withColumn("score", F.round(score, 6)).orderBy(F.desc("score"), key).limit(k)


def capped(moves: DataFrame, rule: list[str], score: Column, key: str, cap: int, k: int) -> DataFrame:
    """At most `cap` variants of a rule, then the `k` best: of each rule the best first, second variants after."""
    nth = F.row_number().over(Window.partitionBy(*rule).orderBy(F.desc("score"), key))
    ranked = moves.withColumn("score", F.round(score, 6)).withColumn("variant", nth).where(F.col("variant") <= cap)
    return ranked.orderBy("variant", F.desc("score"), key).limit(k)
