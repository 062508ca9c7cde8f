"""Places in a global order, without one task that sees the whole order.

Rows are sorted over range partitions and written once with their partition and their place in it.
Sizes of partitions (or of a group's share of them) are summed up, and a row's place in the whole
order, or a group's wanted rank, follows from its partition's sum.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homestat.session import materialize

#: monotonically_increasing_id numbers the rows of a partition in its lower 33 bits.
PLACE_BITS = (1 << 33) - 1


def ranged(df: DataFrame, order: list[str | Column], name: str = "ranged") -> DataFrame:
    """``df`` sorted over range partitions and written, with ``_part`` and ``_place`` (from 0 in its part)."""
    placed = df.orderBy(*order).withColumns({
        "_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS))})
    return materialize(placed, name)


def global_rank(df: DataFrame, order: list[str | Column], name: str = "rank") -> DataFrame:
    """``df`` plus its rows' places (from 0) in ``order``, which must leave no ties.

    The driver gets one number a range partition.
    """
    rows = ranged(df, order)
    sizes = sorted((r["_part"], r["n"]) for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    sums = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_part int, _before long")
    return rows.join(F.broadcast(sums), "_part").select(*df.columns, (F.col("_before") + F.col("_place")).alias(name))


def lower_quantile(counts: DataFrame, keys: list[str], value: str, weight: str, name: str, p: float = 0.5) -> DataFrame:
    """(keys, ``name``): each group's exact lower quantile of values that stand ``weight`` times.

    The value at place ceil(p * n) of the n values in order (p = 0: the first), nulls left out; a
    group without values has no row. NaN is larger than any number, and null keys are a group.
    Equal values are added up before the sort, a group of any size is spread over range partitions,
    and only the one share of it that holds the wanted place is read again.
    """
    known = counts.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    rows = ranged(known, [*keys, value])
    in_order = Window.partitionBy(*keys).orderBy("_part")
    shares = rows.groupBy("_part", *keys).agg(F.sum("_w").alias("_held")).select(
        "_part", *keys, "_held", (F.sum("_held").over(in_order) - F.col("_held")).alias("_before"),
        F.sum("_held").over(Window.partitionBy(*keys)).alias("_all"))
    wanted = shares.withColumn("_rank", F.greatest(F.ceil(F.col("_all") * F.lit(p)), F.lit(1)) - 1) \
        .where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_held"))) \
        .select(F.col("_part").alias("_share"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_before", "_rank")
    same = F.col("_part") == F.col("_share")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    upto = F.col("_before") + F.sum("_w").over(
        Window.partitionBy("_part", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = rows.join(wanted, same).withColumn("_upto", upto)
    return found.where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_w") <= F.col("_rank"))) \
        .select(*keys, F.col(value).alias(name))
