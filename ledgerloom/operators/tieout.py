"""Tie-outs: two totals of the same thing, side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.masks import within_tolerance


def tie_out(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_measure: str,
    right_measure: str | None = None,
    tolerance=1,
) -> DataFrame:
    """Full outer join of two keyed totals. A key missing on one side stays visible: its amount and
    the difference are NULL and ``ok`` is false."""
    right_measure = right_measure or left_measure
    l = left.select(*[F.col(k).alias(f"_l{i}") for i, k in enumerate(keys)], F.col(left_measure).alias("left_amount"))
    r = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], F.col(right_measure).alias("right_amount"))
    cond = reduce(lambda a, b: a & b, [F.col(f"_l{i}") == F.col(f"_r{i}") for i in range(len(keys))])
    diff = F.col("left_amount") - F.col("right_amount")
    return l.join(r, cond, "full_outer").select(
        *[F.coalesce(F.col(f"_l{i}"), F.col(f"_r{i}")).alias(k) for i, k in enumerate(keys)],
        "left_amount",
        "right_amount",
        diff.alias("diff"),
        within_tolerance(F.col("left_amount"), F.col("right_amount"), tolerance).alias("ok"),
    )


def check_status(tied: DataFrame, item: str, tolerance=1) -> DataFrame:
    """One status row per check: differences beyond the tolerance are counted, not failed on."""
    off = F.count_if(F.abs(F.col("diff")) > F.lit(tolerance))
    return tied.agg(
        F.lit(item).alias("validation_item"),
        F.when(off > 0, F.lit("有差異")).otherwise(F.lit("通過")).alias("status"),
        off.alias("n_off"),
        F.count_if(F.col("diff").isNull()).alias("n_unmatched"),
    )


def status_report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def difference_summary(checked: DataFrame, diff: str, pct: str | None = None, tolerance: float = 0.01) -> DataFrame:
    """Rows, exact matches, differences, largest and mean size, rows beyond the tolerance."""
    d = F.col(diff)
    # a missing difference is not an exact match
    aggs: list[Column] = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(d == 0).alias("n_equal"),
        F.count_if(F.coalesce(d != 0, F.lit(True))).alias("n_different"),
        F.max(F.abs(d)).alias("max_abs_diff"),
        F.avg(F.abs(d)).alias("mean_abs_diff"),
    ]
    if pct:
        aggs.append(F.count_if(F.abs(F.col(pct)) > F.lit(tolerance * 100)).alias("n_over_tolerance"))
    return checked.agg(*aggs)
