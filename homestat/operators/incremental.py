"""Reports that a new batch updates without the history being read again.

A report's state is a small table of mergeable parts: per key the row count, and sums, counts,
minima and maxima of its measures; for medians also how often each value stands under a key.
States of disjoint batches merge by one aggregate, in any order, and a report is finished from a
merged state. Medians are exact (``ranking.lower_quantile``), where ``Report.over`` uses a sketch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.operators.ranking import lower_quantile
from homestat.operators.views import Report
from homestat.streaming.published import Snapshots

#: What of a column a measure is finished from.
PARTS = {"avg": ("sum", "n"), "min": ("min",), "max": ("max",), "median": ()}
_MAKE = {"sum": F.sum, "n": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "n": F.sum, "min": F.min, "max": F.max}


def _parts(report: Report) -> list[tuple[str, str]]:
    """(part, column) pairs that the measures need, each once."""
    return list(dict.fromkeys((part, c) for _, how, c, _ in report.measures for part in PARTS[how]))


def _medians(report: Report) -> list[str]:
    return list(dict.fromkeys(c for _, how, c, _ in report.measures if how == "median"))


def partial(report: Report, rows: DataFrame) -> DataFrame:
    """The state of one batch: rows with no ``_column`` are keys' parts, the others value counts.

    Each median column reads ``rows`` once more: hand in a written table.
    """
    rows = report.counted(rows)
    state = rows.groupBy(*report.keys).agg(
        F.count(F.lit(1)).alias("_n"), *[_MAKE[part](c).alias(f"{part}_{c}") for part, c in _parts(report)])
    state = state.select(*report.keys, F.lit(None).cast("string").alias("_column"), F.lit(None).cast("double").alias("_value"),
                         "_n", *[f"{part}_{c}" for part, c in _parts(report)])
    for c in _medians(report):
        values = rows.where(F.col(c).isNotNull()).groupBy(*report.keys, F.col(c).cast("double").alias("_value")) \
            .agg(F.count(F.lit(1)).alias("_n")).withColumn("_column", F.lit(c))
        state = state.unionByName(values, allowMissingColumns=True)
    return state


def merged(report: Report, states: DataFrame) -> DataFrame:
    """States of disjoint batches, stacked, as one state."""
    return states.groupBy(*report.keys, "_column", "_value").agg(
        F.sum("_n").alias("_n"), *[_MERGE[part](f"{part}_{c}").alias(f"{part}_{c}") for part, c in _parts(report)])


def finish(report: Report, state: DataFrame) -> DataFrame:
    """The report's rows from a merged state, as ``Report.over`` gives them."""
    out = state.where(F.col("_column").isNull()).drop("_column", "_value")
    for i, c in enumerate(_medians(report)):
        found = lower_quantile(state.where(F.col("_column") == c), list(report.keys), "_value", "_n", f"median_{c}")
        found = found.select(*[F.col(k).alias(f"_of{i}_{j}") for j, k in enumerate(report.keys)], f"median_{c}")
        same = F.lit(True)
        for j, k in enumerate(report.keys):
            same = same & out[k].eqNullSafe(found[f"_of{i}_{j}"])
        out = out.join(found, same, "left")
    value = {"avg": lambda c: F.col(f"sum_{c}") / F.nullif(F.col(f"n_{c}"), F.lit(0))}
    measures = [F.round(value.get(how, lambda c, how=how: F.col(f"{how}_{c}"))(c), digits).alias(name)
                for name, how, c, digits in report.measures]
    return report.ordered(out.select(*report.keys, F.col("_n").alias(report.count), *measures))


def exact(report: Report, rows: DataFrame) -> DataFrame:
    """The report over a whole table with exact medians, whatever the size of a group."""
    return finish(report, partial(report, rows))


@dataclass
class ReportState:
    """A report's state in a shared folder, updated batch by batch.

    Versions grow; a version at or below the newest one was taken in before and changes nothing, so
    a batch may be handed in again after a failure. Readers see whole versions only.
    """

    spark: SparkSession
    path: str
    report: Report

    @property
    def table(self) -> Snapshots:
        return Snapshots(self.spark, self.path)

    def add(self, rows: DataFrame, version: int) -> bool:
        """Take in a batch of rows that no earlier batch held; False if it was taken in before."""
        done = self.table.versions()
        if done and version <= done[-1]:
            return False
        state = partial(self.report, rows)
        old = self.table.read()
        if old is not None:
            state = merged(self.report, old.unionByName(state))
        return self.table.write(state, version)

    def result(self) -> DataFrame | None:
        """The report over all batches; None before the first."""
        state = self.table.read()
        return None if state is None else finish(self.report, state)
