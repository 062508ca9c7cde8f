"""Exact quantiles of columns without sending a column to one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
buffer; for a whole-table quantile that buffer is the whole column.  Here a
bounded sketch proposes a bracket of values around every wanted rank of every
column, one counting aggregate measures all brackets, and brackets are narrowed
the same way until the sketch's ends meet the rank or few rows are left inside;
those few are read by ordinary top-k sorts.  Each round handles all columns and
ranks in the same two passes, whatever the size of the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a bracket that are sorted rather than narrowed further.
BAND_ROWS = 100_000
SKETCH_ACCURACY = 10_000


@dataclass
class _Search:
    """One wanted rank of one column: the open interval (lo, hi) it lies in, the rows at or
    below ``lo``, and the rows inside."""

    column: str
    rank: int
    lo: float | None
    hi: float | None
    below: int
    size: int
    value: float | None = None

    def inside(self):
        x = F.col("x")
        cond = F.col("column_name") == self.column
        if self.lo is not None:
            cond = cond & (x > F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (x < F.lit(self.hi))
        return cond


def _neighbours(searches: list[_Search]) -> list[list[_Search]]:
    """Searches of one interval whose ranks are the same or next to each other: they share bracket ends."""
    out: list[list[_Search]] = []
    for s in sorted(searches, key=lambda s: s.rank):
        if out and s.rank - out[-1][-1].rank <= 1:
            out[-1].append(s)
        else:
            out.append([s])
    return out


def _narrow(long: DataFrame, searches: list[_Search], accuracy: int) -> None:
    """One round for all open searches: a sketch pass for bracket ends, a counting pass for their ranks.

    An interval that several searches lie in is sketched once.
    """
    eps = 1.0 / accuracy
    intervals: dict[tuple, list[_Search]] = {}
    for s in searches:
        intervals.setdefault((s.column, s.lo, s.hi), []).append(s)
    groups = [_neighbours(same) for same in intervals.values()]
    sketches = []
    for i, parts in enumerate(groups):
        ends = []
        for part in parts:
            place = lambda s: (s.rank - s.below) / s.size
            ends += [max(0.0, place(part[0]) - 2 * eps), min(1.0, place(part[-1]) + 2 * eps)]
        sketches.append(F.percentile_approx(F.when(parts[0][0].inside(), F.col("x")), ends, accuracy).alias(f"q{i}"))
    brackets = long.agg(*sketches).first()
    counts, wanted = [], []
    for i, parts in enumerate(groups):
        x = F.when(parts[0][0].inside(), F.col("x"))
        for j, part in enumerate(parts):
            a, b = brackets[f"q{i}"][2 * j:2 * j + 2]
            k = len(wanted)
            wanted.append((part, a, b))
            counts += [F.count(F.when(x < a, 1)).alias(f"la{k}"), F.count(F.when(x <= a, 1)).alias(f"ua{k}"),
                       F.count(F.when(x < b, 1)).alias(f"lb{k}"), F.count(F.when(x <= b, 1)).alias(f"ub{k}")]
    found = long.agg(*counts).first()
    for k, (part, a, b) in enumerate(wanted):
        below_a, upto_a, below_b, upto_b = (found[f"{name}{k}"] for name in ("la", "ua", "lb", "ub"))
        for s in part:
            r = s.rank - s.below
            if r < below_a:
                s.hi, s.size = a, below_a
            elif r < upto_a:
                s.value = a
            elif r < below_b:
                s.lo, s.hi, s.below, s.size = a, b, s.below + upto_a, below_b - upto_a
            elif r < upto_b:
                s.value = b
            else:
                s.lo, s.below, s.size = b, s.below + upto_b, s.size - upto_b


def _read(long: DataFrame, searches: list[_Search]) -> None:
    """Values of searches whose bracket is small: one top-k read a bracket, shared by equal brackets."""
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault((s.column, s.lo, s.hi), []).append(s)
    for same in groups.values():
        # from the nearer end; the rows before the wanted ones are skipped where they are sorted
        ranks = sorted(s.rank - s.below for s in same)
        up = ranks[-1] + 1 <= same[0].size - ranks[0]
        n = ranks[-1] + 1 if up else same[0].size - ranks[0]
        skip = ranks[0] if up else same[0].size - 1 - ranks[-1]
        order = F.col("x").asc() if up else F.col("x").desc()
        rows = long.where(same[0].inside()).select("x").orderBy(order).limit(n).offset(skip).collect()
        for s in same:
            r = s.rank - s.below
            s.value = rows[(r if up else same[0].size - 1 - r) - skip]["x"]


def values_at_ranks(long: DataFrame, ranks: dict[str, list[int]], counts: dict[str, int],
                    band_rows: int = BAND_ROWS, accuracy: int = SKETCH_ACCURACY) -> dict[str, dict[int, float]]:
    """Values at 0-based ascending ranks per column of (column_name, x) rows without nulls."""
    searches = [_Search(c, r, None, None, 0, counts[c]) for c, rs in ranks.items() for r in rs]
    while True:
        open_ = [s for s in searches if s.value is None and s.size > band_rows]
        if not open_:
            break
        _narrow(long, open_, accuracy)
    _read(long, [s for s in searches if s.value is None])
    out: dict[str, dict[int, float]] = {c: {} for c in ranks}
    for s in searches:
        out[s.column][s.rank] = s.value
    return out


def value_at_ranks(values: DataFrame, ranks: list[int], n: int,
                   band_rows: int = BAND_ROWS, accuracy: int = SKETCH_ACCURACY) -> dict[int, float]:
    """Values at 0-based ascending ``ranks`` of column ``x`` (``n`` rows)."""
    long = values.select(F.lit("x").alias("column_name"), "x")
    return values_at_ranks(long, {"x": ranks}, {"x": n}, band_rows, accuracy)["x"]


def exact_quantiles_by_column(df: DataFrame, columns: list[str], probs: list[float],
                              band_rows: int = BAND_ROWS) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles (the pandas / SQL quantile_cont definition) of several columns.

    The columns are unpivoted to (column_name, x); one aggregate counts them all.
    """
    stack = "stack({}, {}) as (column_name, x)".format(
        len(columns), ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns))
    long = df.selectExpr(stack).where(F.col("x").isNotNull() & ~F.isnan("x"))
    counts = {r["column_name"]: r["n"] for r in long.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    spots = {c: [p * (counts[c] - 1) for p in probs] for c in columns if counts.get(c)}
    ranks = {c: sorted({int(math.floor(s)) for s in sp} | {int(math.ceil(s)) for s in sp}) for c, sp in spots.items()}
    got = values_at_ranks(long, ranks, counts, band_rows)
    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = [None] * len(probs) if c not in spots else [
            got[c][math.floor(s)] + (got[c][math.ceil(s)] - got[c][math.floor(s)]) * (s - math.floor(s)) for s in spots[c]]
    return out


def exact_quantiles(df: DataFrame, column: str, probs: list[float], band_rows: int = BAND_ROWS) -> list[float | None]:
    return exact_quantiles_by_column(df, [column], probs, band_rows)[column]


def exact_quantile(df: DataFrame, column: str, p: float) -> float | None:
    return exact_quantiles(df, column, [p])[0]
