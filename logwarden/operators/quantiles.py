"""Exact order statistics and quantiles that never gather a large column in one place.

Spark's ``percentile`` keeps one map entry per distinct value in a single task. Here the
wanted ranks are bracketed with ``percentile_approx`` and the brackets are narrowed by exact
counts until only a small number of values lies between the ends. The sketch only guides the search; the result
comes from counts, so heavy ties and a poor sketch cost passes, never correctness.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import kept

GATHER_ROWS = 50_000  # values of all brackets brought to the driver at most
SKETCH_ACCURACY = 20_000
MAX_ROUNDS = 200


def _as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    value = {c: F.col(c).cast("double") for c in columns}
    return df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in value.items()])


def _counts(values: DataFrame) -> dict[str, int]:
    return values.agg(*[F.count(c).alias(c) for c in values.columns]).first().asDict()


class _Search:
    """One wanted rank (0-based) of one column, between two open ends."""

    def __init__(self, column: str, rank: int, rows: int):
        self.column, self.rank = column, rank
        self.low, self.high = None, None  # open ends; None is unbounded
        self.below, self.inside = 0, rows  # rows <= low, rows strictly between the ends
        self.found: float | None = None

    def between(self) -> Column:
        value = F.col(self.column)
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value > F.lit(self.low))
        if self.high is not None:
            test = test & (value < F.lit(self.high))
        return test

    def probes(self) -> list[float]:
        """Shares of the bracket at which to look: around the wanted rank."""
        at = (self.rank - self.below + 0.5) / self.inside
        slack = 2.0 / SKETCH_ACCURACY
        return [min(max(at + s, 0.0), 1.0) for s in (-slack, 0.0, slack)]

    def narrow(self, points: Sequence[float], tallies: Sequence[tuple[int, int]]) -> None:
        """Use exact (rows < p, rows <= p) inside the bracket for each probe p."""
        start, rows = self.below, self.inside
        end = start + rows
        for point, (less, upto) in zip(points, tallies, strict=True):
            if start + less <= self.rank < start + upto:
                self.found = point
                return
            if start + upto <= self.rank:
                self.low, self.below = point, start + upto
            elif self.rank < start + less:
                self.high, end = point, start + less
                break
        self.inside = end - self.below


def _sketched_points(values: DataFrame, wide: Sequence[_Search]) -> list[list[float]]:
    """Candidate values per search; searches in the same bracket share one sketch."""
    shared: dict[tuple, list[int]] = {}
    for i, s in enumerate(wide):
        shared.setdefault((s.column, s.low, s.high), []).append(i)
    sketches = []
    for n, members in enumerate(shared.values()):
        inner = F.when(wide[members[0]].between(), F.col(wide[members[0]].column))
        probes = [p for i in members for p in wide[i].probes()]
        sketches.append(F.percentile_approx(inner, probes, SKETCH_ACCURACY).alias(f"p{n}"))
    row = values.agg(*sketches).first()
    points: list[list[float]] = [[] for _ in wide]
    for n, members in enumerate(shared.values()):
        for place, i in enumerate(members):
            points[i] = sorted(set(row[f"p{n}"][3 * place:3 * place + 3]))
    return points


def _gather(values: DataFrame, left: Sequence[_Search], gather_rows: int) -> None:
    """Settle the remaining searches from the few values inside their brackets, in one job."""
    if not left:
        return
    if any(s.inside > gather_rows for s in left):
        raise RuntimeError("the rank search did not converge")
    shared: dict[tuple, list[_Search]] = {}
    for s in left:
        shared.setdefault((s.column, s.low, s.high), []).append(s)
    cells = [F.when(members[0].between(), F.struct(F.lit(n).alias("n"), F.col(members[0].column).alias("v")))
             for n, members in enumerate(shared.values())]
    rows = values.select(F.inline(F.array_compact(F.array(*cells)))).toArrow()
    owner, value = rows.column("n").to_numpy(), rows.column("v").to_numpy()
    for n, members in enumerate(shared.values()):
        inside = np.sort(value[owner == n])
        for s in members:
            s.found = float(inside[s.rank - s.below])


def _select_ranks(values: DataFrame, wanted: Mapping[str, Sequence[int]],
                  counts: Mapping[str, int], gather_rows: int) -> dict[tuple[str, int], float]:
    searches = [_Search(c, r, counts[c]) for c, ranks in wanted.items() for r in sorted(set(ranks))]
    for _ in range(MAX_ROUNDS):
        left = [s for s in searches if s.found is None]
        # All brackets together may hold gather_rows values.
        share = gather_rows // max(1, len({(s.column, s.low, s.high) for s in left}))
        wide = [s for s in left if s.inside > max(1, share)]
        if not wide:
            break
        points = _sketched_points(values, wide)
        tallies = []
        for i, (s, ps) in enumerate(zip(wide, points, strict=True)):
            value, inner = F.col(s.column), s.between()
            for j, p in enumerate(ps):
                tallies.append(F.count_if(inner & (value < F.lit(p))).alias(f"l{i}_{j}"))
                tallies.append(F.count_if(inner & (value <= F.lit(p))).alias(f"u{i}_{j}"))
        seen = values.agg(*tallies).first()
        for i, (s, ps) in enumerate(zip(wide, points, strict=True)):
            s.narrow(ps, [(seen[f"l{i}_{j}"], seen[f"u{i}_{j}"]) for j in range(len(ps))])
    _gather(values, [s for s in searches if s.found is None], gather_rows)
    return {(s.column, s.rank): s.found for s in searches}


def ranked_values(df: DataFrame, column: str, ranks: Callable[[int], Sequence[int]],
                  gather_rows: int = GATHER_ROWS) -> tuple[int, dict[int, float]]:
    """Row count and the values at the 0-based ranks that ``ranks(row_count)`` asks for."""
    values = _as_doubles(df, [column])
    counts = _counts(values)
    asked = [r for r in ranks(counts[column]) if 0 <= r < counts[column]]
    found = _select_ranks(values, {column: asked}, counts, gather_rows)
    return counts[column], {rank: value for (_, rank), value in found.items()}


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]],
                    gather_rows: int = GATHER_ROWS) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns in shared passes.

    Nulls and NaN are left out; a column without values gives ``None``.
    """
    # Several passes follow, so whatever makes the columns runs once.
    values = kept(_as_doubles(df, list(wanted)))
    try:
        return _quantiles(values, wanted, gather_rows)
    finally:
        values.unpersist()


def _quantiles(values: DataFrame, wanted: Mapping[str, Sequence[float]], gather_rows: int) -> dict[str, list[float | None]]:
    counts = _counts(values)
    spots = {c: [p * (counts[c] - 1) for p in ps] for c, ps in wanted.items() if counts[c]}
    ranks = {c: [r for s in at for r in (math.floor(s), math.ceil(s))] for c, at in spots.items()}
    found = _select_ranks(values, ranks, counts, gather_rows)

    def read(column: str, spot: float) -> float:
        low, high = found[column, math.floor(spot)], found[column, math.ceil(spot)]
        return low if low == high else low + (high - low) * (spot - math.floor(spot))

    return {c: [read(c, s) for s in spots[c]] if c in spots else [None] * len(ps)
            for c, ps in wanted.items()}


def quantile(df: DataFrame, column: str, p: float, **limits: int) -> float:
    """One exact quantile; an empty column is an error."""
    value = exact_quantiles(df, {column: [p]}, **limits)[column][0]
    if value is None:
        raise ValueError(f"no values in column {column}")
    return value


def contamination_cut(df: DataFrame, score: str, contamination: float, **limits: int) -> float:
    """The score above which the ``contamination`` share of rows lies."""
    return quantile(df, score, 1.0 - contamination, **limits)
