"""Places and sums before each row of a part, in order, for parts of any size.

A window over a part would put it into one task. Here the rows are dealt out by range of part and order, so a part that holds
most rows is spread over many tasks; each task numbers its rows, and one small row per task and part carries the counts on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import settle

#: bits of an id that number the rows of one task
_LOCAL = 33


def alike(pairs: list[tuple[Column, Column]]) -> Column:
    """All pairs equal, a missing value being equal to another."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in pairs])


def placed(rows: DataFrame, part: list[str], order: list[str], value: str | None = None) -> DataFrame:
    """``rows`` with ``row``, a number of its own for each row, rising in the order of ``part`` and ``order``; ``place``, how many rows of the
    part come before; and with ``value``, ``before``, the sum of that column over them.

    Missing parts and order values come first and equal each other; a missing value counts as zero. Rows that tie in ``order`` come in any
    one order, so ``order`` should tell different rows apart. Input columns called like the new ones give way to them. The
    ranges are cut for the rows as they are, and written once: a later scan finds the same numbers.
    """
    rows = rows.drop("row", "place", "before")
    keys = [*[F.col(f"`{c}`") for c in [*part, *order]], F.col("_tie")]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = settle(ranged.drop("_tie").withColumn("row", F.monotonically_increasing_id()), "ranged").withColumn("_run", F.shiftright("row", _LOCAL))

    own = [F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(part)]
    names = [f"_p{i}" for i in range(len(part))]
    amount = F.coalesce(F.col(f"`{value}`"), F.lit(0)) if value else F.lit(0)
    totals = ranged.select(*own, F.col("_run").alias("_r"), "row", amount.alias("_v")).groupBy(*names, "_r").agg(
        F.count(F.lit(1)).alias("_n"), F.min("row").alias("_first"), F.sum("_v").alias("_sum")
    )
    earlier = Window.partitionBy(*names).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = settle(
        totals.select(*names, "_r", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carry")),
        "range_totals",
    )
    if value:
        inside = Window.partitionBy(*[f"`{c}`" for c in part], "_run").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
        ranged = ranged.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    same = alike([(F.col("_run"), F.col("_r")), *[(F.col(f"`{c}`"), F.col(n)) for c, n in zip(part, names, strict=True)]])
    sums = [(F.col("_inside") + F.col("_carry")).alias("before")] if value else []
    return ranged.join(totals, same).select(*[F.col(f"`{c}`") for c in rows.columns], "row", (F.col("row") + F.col("_shift")).alias("place"), *sums)
