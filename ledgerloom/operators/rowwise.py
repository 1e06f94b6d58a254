"""Operators that depend on row order, built so that no single group has to fit in one task.

A window over a whole file or account would put all its rows in one task. Here the rows are dealt out by range of part and sequence:
the window runs inside a range, one small row per range and part carries the state across, and an equi-join hands it back.
Ranges hold alike many rows whatever the values of the sequence and however the rows are spread over the parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import name
from ledgerloom.session import settle


def in_ranges(df: DataFrame, part: list[str], seq: str, ranges: int | None = None) -> DataFrame:
    """``df`` with ``_key``, the part and the range of each row, as one struct that groups, sorts and joins alike, missing parts included.

    There are ``ranges`` of them, or as many as Spark makes of its shuffle partitions. The bounds come from a sample of the rows, so
    the rows are written once with their range: what is read from them later finds the same ranges, and the facts are read once.
    """
    keys = [F.col(name(c)) for c in [*part, seq]]
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *keys)
    parts = [F.col(name(p)).alias(f"p{i}") for i, p in enumerate(part)]
    return settle(dealt.withColumn("_range", F.spark_partition_id()), "ranges").select(*[name(c) for c in df.columns], F.struct(*parts, F.col("_range").alias("b")).alias("_key"))


def _range_window(seq: str):
    return Window.partitionBy("_key").orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier_ranges(part: list[str]):
    """The rows of a part here are its ranges, one each: no more than there are partitions, whatever the size of the part."""
    parts = [F.col(f"_key.p{i}") for i in range(len(part))] or [F.lit(1)]
    return Window.partitionBy(*parts).orderBy("_key.b").rowsBetween(Window.unboundedPreceding, -1)


def forward_fill(df: DataFrame, cols: list[str], part: list[str], seq: str, ranges: int | None = None) -> DataFrame:
    """Fill missing values of ``cols`` with the last value seen before, in ``seq`` order per ``part``.

    ``seq`` must be unique inside ``part``; its steps do not matter.
    """
    keyed = in_ranges(df, part, seq, ranges)
    filled = keyed.withColumns({c: F.last(c, ignorenulls=True).over(_range_window(seq)) for c in cols})
    last_in_range = keyed.groupBy("_key").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(f"_last_{i}") for i, c in enumerate(cols)]
    )
    carry = last_in_range.select(
        F.col("_key").alias("_carry_key"),
        *[F.last(f"_last_{i}", ignorenulls=True).over(_earlier_ranges(part)).alias(f"_carry_{i}")
          for i in range(len(cols))],
    )
    position = {c: i for i, c in enumerate(cols)}
    return filled.join(carry, F.col("_key") == F.col("_carry_key"), "left").select(
        *[F.coalesce(F.col(c), F.col(f"_carry_{position[c]}")).alias(c) if c in position else F.col(c)
          for c in df.columns]
    )


def running_total(df: DataFrame, value: str, part: list[str], seq: str, out: str, ranges: int | None = None) -> DataFrame:
    """Running sum of ``value`` in ``seq`` order per ``part``; exact for decimals."""
    keyed = in_ranges(df, part, seq, ranges)
    local = keyed.withColumn("_local", F.sum(F.coalesce(F.col(value), F.lit(0))).over(_range_window(seq)))
    carry = keyed.groupBy("_key").agg(F.sum(value).alias("_sum")).select(
        F.col("_key").alias("_carry_key"), F.sum("_sum").over(_earlier_ranges(part)).alias("_carry")
    )
    return local.join(carry, F.col("_key") == F.col("_carry_key"), "left").select(
        *df.columns, (F.col("_local") + F.coalesce(F.col("_carry"), F.lit(0))).alias(out)
    )


def running_balance(
    daily: DataFrame, movement: str, order: str, part: list[str] | None = None, opening=0, out: str = "running_balance"
) -> DataFrame:
    """Opening amount plus cumulative movement over rows already summed to one per day.

    One row per account and day keeps the window small whatever the size of the facts behind it;
    for raw facts use :func:`running_total`.
    """
    keys = [F.col(p) for p in part] if part else [F.lit(1)]
    win = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = opening if isinstance(opening, Column) else F.lit(opening)
    return daily.withColumn(out, F.coalesce(start, F.lit(0)) + F.sum(F.coalesce(F.col(movement), F.lit(0))).over(win))


def rows_before_marker(df: DataFrame, marker: Column, part: list[str], seq: str) -> DataFrame:
    """Rows of each ``part`` that come before its first marker row; without a marker, all rows.

    The stops, one row per part, are written first, so that the rows need not be shuffled by part.
    """
    first = settle(
        df.where(F.coalesce(marker, F.lit(False)))
        .groupBy(*part)
        .agg(F.min(seq).alias("_stop"))
        .select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(part)], "_stop"),
        "marker_stops",
    )
    same = F.lit(True)
    for i, p in enumerate(part):
        same = same & F.col(p).eqNullSafe(F.col(f"_p{i}"))
    return (
        df.join(first, same, "left")
        .where(F.col("_stop").isNull() | (F.col(seq) < F.col("_stop")))
        .select(*df.columns)
    )


def last_record(df: DataFrame, value: str, seq: str, by: list[str] | None = None) -> DataFrame:
    """Value of the row with the highest ``seq``, which must be unique.

    ``max_by`` of a number aggregates by hash; the maximum of a struct would sort every row first.
    """
    return df.groupBy(*(by or [])).agg(F.max_by(value, seq).alias(value))


def last_before(df: DataFrame, value: str, date: str, limit, seq: str | None = None) -> DataFrame:
    """One row with the last ``value`` dated before ``limit``, zero if there is none."""
    best = F.max_by(value, F.struct(date, seq) if seq else date)
    return df.where(F.col(date) < F.lit(limit)).agg(F.coalesce(best, F.lit(0)).alias(value))


def share_of_subtotal(
    df: DataFrame, part: str, label: str, subtotal_label: str, value: str, seq: str, out: str, places: int = 4
) -> DataFrame:
    """``value`` over the subtotal row of its ``part``; zero where ``part`` has no subtotal row."""
    total = (
        df.where(F.col(label) == subtotal_label)
        .groupBy(part)
        .agg(F.min_by(value, seq).alias("_subtotal"), F.lit(True).alias("_has"))
    )
    share = F.bround(F.try_divide(F.col(value), F.col("_subtotal")), places)
    return (
        df.join(total, part, "left")
        .withColumn(out, F.when(F.col("_has"), share).otherwise(F.lit(0)))
        .drop("_subtotal", "_has")
    )
