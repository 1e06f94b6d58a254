"""Equi-joins of the reconciliation. No join is hinted: Spark picks broadcast by measured size."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def merge(
    left: DataFrame,
    right: DataFrame,
    on: list[str] | None = None,
    left_on: list[str] | None = None,
    right_on: list[str] | None = None,
    how: str = "left",
    suffixes: tuple[str, str] = ("", "_aux"),
) -> DataFrame:
    """Join two tables where missing keys match each other and clashing names get suffixes."""
    lkeys, rkeys = (on, on) if on else (left_on, right_on)
    if not lkeys or not rkeys or len(lkeys) != len(rkeys):
        raise ValueError("give on, or left_on and right_on of the same length")
    shared = set(on or ())
    clash = (set(left.columns) & set(right.columns)) - shared
    lcols = {c: (c + suffixes[0] if c in clash else c) for c in left.columns}
    rcols = {c: (c + suffixes[1] if c in clash else c) for c in right.columns}
    l = left.select(*[F.col(c).alias(f"_l_{i}") for i, c in enumerate(left.columns)])
    r = right.select(*[F.col(c).alias(f"_r_{i}") for i, c in enumerate(right.columns)])
    lpos = {c: F.col(f"_l_{i}") for i, c in enumerate(left.columns)}
    rpos = {c: F.col(f"_r_{i}") for i, c in enumerate(right.columns)}
    cond = reduce(lambda a, b: a & b, [lpos[a].eqNullSafe(rpos[b]) for a, b in zip(lkeys, rkeys)])
    how = {"outer": "full_outer"}.get(how, how)
    out: list[Column] = []
    for c in left.columns:
        col = F.coalesce(lpos[c], rpos[c]) if c in shared and how in ("right", "full_outer") else lpos[c]
        out.append(col.alias(lcols[c]))
    out += [rpos[c].alias(rcols[c]) for c in right.columns if c not in shared]
    return l.join(r, cond, how).select(*out)


def date_spine(spark: SparkSession, beg: dt.date, end: dt.date, name: str = "Date") -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(beg), F.lit(end))).alias(name))


def fill_spine(
    df: DataFrame, beg: dt.date, end: dt.date, name: str = "Date", zeros: list[str] | None = None
) -> DataFrame:
    """Every day of the range; numbers of days without data become zero."""
    spine = date_spine(df.sparkSession, beg, end, name)
    numeric = ("decimal", "double", "float", "int", "bigint", "smallint", "tinyint")
    zeros = zeros if zeros is not None else [c for c, t in df.dtypes if t.split("(")[0] in numeric]
    joined = spine.join(df, name, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeros}) if zeros else joined


def sparse_to_spine(
    df: DataFrame, date: str, amount: str, seq: str, beg: dt.date, end: dt.date, out: str = "amount"
) -> DataFrame:
    """Date-to-amount map laid on every day of a range; the last entry of a date wins, gaps are zero."""
    last = df.groupBy(F.col(date).alias("Date")).agg(F.max_by(amount, seq).alias(out))
    return fill_spine(last, beg, end, "Date", [out])


def literal_amounts(spark: SparkSession, amounts: dict, beg: dt.date, end: dt.date, out: str = "amount") -> DataFrame:
    """Daily amounts given in the settings, zero on all other days."""
    day = F.col("Date")
    value = F.lit(None).cast("decimal(18,2)")
    for text, amount in amounts.items():
        value = F.when(day == F.lit(dt.date.fromisoformat(text)), F.lit(amount).cast("decimal(18,2)")).otherwise(value)
    return date_spine(spark, beg, end).withColumn(out, F.coalesce(value, F.lit(0).cast("decimal(18,2)")))


def union_tagged(tables: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """UNION ALL by column name with the table name as a column."""
    parts = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_of_parts(df: DataFrame, by: list[str], only: dict[str, Column], tag: str = "source") -> DataFrame:
    """Tables that lie as parts of one dataset, under one another: one scan, whatever their number. ``by`` are the columns that tell them
    apart and make up their name; ``only`` has the columns that not all of them have, with the condition under which they do."""
    cells = [F.when(only[c], F.col(c)).alias(c) if c in only else F.col(c) for c in df.columns]
    return df.select(*cells, F.concat_ws("_", *by).alias(tag))


def add_aggregates(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Add two keyed aggregates; a key missing on one side counts as zero. One shuffle, no join."""
    both = left.select(*keys, *measures).unionByName(right.select(*keys, *measures))
    return both.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str) -> DataFrame:
    """Add ``value`` of a small keyed table; unknown keys give NULL."""
    side = dim.select(F.col(dim_key).alias("_dk"), F.col(value).alias(out))
    return df.join(side, F.col(key) == F.col("_dk"), "left").drop("_dk")


def align_on_key(left: DataFrame, right: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Put columns of ``right`` beside ``left`` by key; what does not line up shows as NULL."""
    side = right.select(*keys, *[F.col(src).alias(dst) for dst, src in columns.items()])
    return left.join(side, keys, "left")
