"""Pivots with margins, unpivots, totals. Results stay long until the last step of a report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import array, literal, name, one_of


def long_margins(df: DataFrame, rows: list[str], col: str, value: str, margin: str = "Grand Total") -> DataFrame:
    """(rows, col, value): sums of every cell, row, column and of all, for any number of columns.

    Facts are summed once to cells; margins come from these by grouping sets. A key that is summed over shows ``margin`` (all
    but the first row key show an empty text). Rows with a missing key are left out; an empty table gives no rows.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*rows, col]])
    cells = df.where(present).groupBy(*rows, col).agg(F.sum(value).alias("_cell"))
    keys = [F.col(k) for k in rows]
    sums = cells.groupingSets([[*keys, F.col(col)], keys, [F.col(col)], []], *keys, F.col(col)).agg(
        F.sum("_cell").alias("_sum"), F.count(F.lit(1)).alias("_n"), *[F.grouping(k).alias(f"_g{i}") for i, k in enumerate([*rows, col])]
    ).where("_n > 0")
    shown = [margin, *[""] * (len(rows) - 1), margin]
    labels = [F.when(F.col(f"_g{i}") != 0, shown[i]).otherwise(F.col(k).cast("string")).alias(k) for i, k in enumerate([*rows, col])]
    return sums.select(*labels, F.col("_sum").alias(value))


def pivot_with_margins(
    df: DataFrame,
    rows: list[str],
    col: str,
    value: str,
    col_values: list,
    margin: str = "Grand Total",
    fill=0,
    post=None,
    col_names: dict | None = None,
) -> DataFrame:
    """Sum of ``value`` by row keys and the pivot columns named in ``col_values``, with a total column over all values and a total
    row. ``long_margins`` has the same sums for values that are not known beforehand.

    Facts are summed once to (rows, col); margins come from that small table by grouping sets, told
    apart by ``grouping_id`` and not by NULL. Rows with a missing key are left out of cells and
    margins alike. ``post`` is applied to finished cells, margins included.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*rows, col]])
    base = df.where(present).groupBy(*rows, col).agg(F.sum(value).alias("_cell"))
    values = col_values
    names = col_names or {}

    cells = [F.expr(f"sum(CASE WHEN {name(col)} = {literal(v)} THEN _cell END) AS _v{i}") for i, v in enumerate(values)]
    keys = [F.col(k) for k in rows]
    wide = base.groupingSets([keys, []], *keys).agg(
        *cells, F.sum("_cell").alias("_all"), F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("_n")
    ).where("_n > 0")

    def finish(c: str) -> Column:
        out = F.col(c) if fill is None else F.expr(f"coalesce({c}, {literal(fill)})")
        return post(out) if post else out

    is_total = F.col("_g") != 0
    labels = [
        F.when(is_total, F.lit(margin if i == 0 else "")).otherwise(F.col(k).cast("string")).alias(k)
        for i, k in enumerate(rows)
    ]
    return wide.select(
        *labels,
        *[finish(f"_v{i}").alias(str(names.get(v, v))) for i, v in enumerate(values)],
        finish("_all").alias(margin),
    )


def complete_grid(df: DataFrame, keys: dict[str, list]) -> DataFrame:
    """Every combination of the listed key values; combinations without data get NULL measures.

    The lists are settings, so the grid is tiny and the other rows fall out of the result.
    """
    grid = df.sparkSession.range(1)
    for key, values in keys.items():
        grid = grid.withColumn(key, F.expr(f"explode({array(values)})"))
    return grid.drop("id").join(df, list(keys), "left")


def wide_to_long(
    df: DataFrame, ids: list[str], groups: dict[str, dict[str, str]], key: str, measures: list[str], zero=0, dtype: str | None = None
) -> DataFrame:
    """One row per input row and group. ``groups`` maps a group to its column per measure; columns
    that do not exist give ``zero``. Values keep their digits: a measure has the common type of its columns, or ``dtype``."""
    have = set(df.columns)
    rows = []
    for label, columns in groups.items():
        cells = [name(columns[m]) if columns.get(m) in have else literal(zero) for m in measures]
        typed = [f"CAST({c} AS {dtype})" if dtype else c for c in cells]
        rows.append("named_struct(" + ", ".join(f"{literal(n)}, {c}" for n, c in zip([key, *measures], [literal(label), *typed])) + ")")
    return df.selectExpr(*[name(c) for c in ids], f"inline(array({', '.join(rows)}))")


def unpivot_columns(df: DataFrame, ids: list[str], columns: list[str], key: str, value: str, dtype: str | None = None) -> DataFrame:
    """Listed columns to rows; columns that do not exist are skipped. Values have the common type of the columns, or ``dtype``."""
    have = set(df.columns)
    cells = [(c, f"CAST({name(c)} AS {dtype})" if dtype else name(c)) for c in columns if c in have]
    rows = [f"named_struct({literal(key)}, {literal(c)}, {literal(value)}, {cell})" for c, cell in cells]
    return df.selectExpr(*[name(c) for c in ids], f"inline(array({', '.join(rows)}))")


def row_total(cols: list[str]) -> Column:
    """Sum across columns of a row, missing values skipped."""
    return F.expr(" + ".join(["0", *[f"coalesce({name(c)}, 0)" for c in cols]]))


def append_total(df: DataFrame, label_col: str, label: str, measures: list[str]) -> DataFrame:
    """A total row below the rows of a small table; the label column becomes text."""
    labelled = df.withColumn(label_col, F.col(label_col).cast("string"))
    total = df.agg(*[F.sum(m).alias(m) for m in measures]).withColumn(label_col, F.lit(label))
    return labelled.unionByName(total, allowMissingColumns=True)


def add_subtotal(df: DataFrame, label_col: str, label: str, by: list[str], measures: list[str]) -> DataFrame:
    """Subtotal rows over ``label_col`` within ``by``, missing amounts skipped, by one grouping-set pass."""
    keys = [F.col(label_col), *[F.col(b) for b in by]]
    return (
        df.groupingSets([keys, keys[1:]], *keys)
        .agg(*[F.sum(m).alias(m) for m in measures], F.grouping(label_col).alias("_g"))
        .withColumn(label_col, F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(label_col)))
        .drop("_g")
    )


def order_by_list(df: DataFrame, key: str, order: list, drop_unlisted: bool = True, unknown: int = 999) -> DataFrame:
    """Rows in the order of a given list; unlisted rows are dropped or sorted last."""
    kept = df.where(one_of(key, order)) if drop_unlisted else df
    return kept.orderBy(order_position(key, order, unknown), key)


def order_position(key: str, order: list, unknown: int = 999) -> Column:
    """Sort position of a value in a given list."""
    return F.expr(f"coalesce(nullif(array_position({array(order)}, {name(key)}), 0), {unknown})")
