"""Data quality: missing values, duplicates, failed casts, breakers, table reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import has_any_char, strip_chars
from ledgerloom.functions.text import literal, name
from ledgerloom.operators.literals import literal_table
from ledgerloom.operators.shaping import (
    ColumnSpec, MissingColumnsError, SchemaConfig, apply_defaults, cast_columns, cast_expr, drop_empty_rows, map_columns,
    missing_required,
)
from ledgerloom.session import settle


class BreakerError(ValueError):
    """The share of missing values of some column is above the threshold."""

    def __init__(self, ratios: dict[str, float], threshold: float):
        super().__init__(f"missing values above {threshold:.0%}: " + ", ".join(f"{c} {r:.1%}" for c, r in ratios.items()))
        self.ratios = ratios
        self.threshold = threshold


@dataclass(frozen=True)
class BreakerResult:
    ok: bool
    ratios: dict[str, float]
    tripped: dict[str, float]
    threshold: float


def _per_column(counted: DataFrame, columns: list[str], fields: dict[str, str]) -> DataFrame:
    """One aggregate row with ``<field>_<i>`` columns to one row per column."""
    rows = [", ".join([literal(c), *[f"{f}_{i}" for f in fields]]) for i, c in enumerate(columns)]
    names = ", ".join(["`column`", *[name(n) for n in fields.values()]])
    return counted.selectExpr("n_rows", f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, in one pass."""
    columns = columns or df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.expr(f"count_if({name(c)} IS NULL) AS n_{i}") for i, c in enumerate(columns)],
    )
    return _per_column(counted, columns, {"n": "null_count"})


def null_summary(df: DataFrame, threshold: float = 0.3, columns: list[str] | None = None) -> DataFrame:
    """Count and share of missing values per column; an empty table has share zero."""
    share = F.coalesce(F.try_divide(F.col("null_count").cast("double"), F.col("n_rows").cast("double")), F.lit(0.0))
    return (
        null_counts(df, columns)
        .withColumn("null_ratio", share)
        .withColumn("exceeds_threshold", F.col("null_ratio") > F.lit(threshold))
        .drop("n_rows")
    )


def breaker_columns(df: DataFrame, specs: list[ColumnSpec] | None = None, columns: list[str] | None = None) -> list[str]:
    """Target columns of the specifications, else the listed columns, else all but lineage columns."""
    if specs:
        return [s.target for s in specs if s.target in df.columns]
    if columns:
        return [c for c in columns if c in df.columns]
    return [c for c in df.columns if not c.startswith("_")]


def breaker(
    df: DataFrame, threshold: float = 0.3, specs: list[ColumnSpec] | None = None, columns: list[str] | None = None
) -> BreakerResult:
    """Verdict from one aggregate; a share above (not at) the threshold trips it."""
    checked = breaker_columns(df, specs, columns)
    if not checked:
        return BreakerResult(True, {}, {}, threshold)
    ratios = {r["column"]: r["null_ratio"] for r in null_summary(df, threshold, checked).collect()}
    tripped = {c: r for c, r in ratios.items() if r > threshold}
    return BreakerResult(not tripped, ratios, tripped, threshold)


def require_breaker(df: DataFrame, threshold: float = 0.3, specs=None, columns=None) -> BreakerResult:
    result = breaker(df, threshold, specs, columns)
    if not result.ok:
        raise BreakerError(result.tripped, threshold)
    return result


def watch_nulls(df: DataFrame, columns: list[str], label: str = "null_watch") -> tuple[DataFrame, Observation]:
    """Count missing values while the table is being written: no pass of its own."""
    seen = Observation(label)
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("n_rows"), *[F.expr(f"count_if({name(c)} IS NULL) AS {name(c)}") for c in columns]
    )
    return watched, seen


def judge_watch(seen: Observation, threshold: float) -> BreakerResult:
    """Verdict over an observation, once its action has run."""
    counts = dict(seen.get)
    rows = counts.pop("n_rows")
    ratios = {c: (n / rows if rows else 0.0) for c, n in counts.items()}
    tripped = {c: r for c, r in ratios.items() if r > threshold}
    return BreakerResult(not tripped, ratios, tripped, threshold)


def cast_failures(df: DataFrame, specs: list[ColumnSpec]) -> DataFrame:
    """Per column: missing after the cast, and those of them that held a value before."""
    present = [s for s in specs if s.target in df.columns and s.dtype != "VARCHAR"]
    both = df.select(
        *[F.col(name(s.target)).isNotNull().alias(f"b_{i}") for i, s in enumerate(present)],
        *[cast_expr(F.col(name(s.target)), s).isNull().alias(f"a_{i}") for i, s in enumerate(present)],
    )
    counted = both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.expr(f"count_if(a_{i}) AS n_{i}") for i in range(len(present))],
        *[F.expr(f"count_if(a_{i} AND b_{i}) AS f_{i}") for i in range(len(present))],
    )
    return _per_column(counted, [s.target for s in present], {"n": "null_after", "f": "failed"})


def silver(df: DataFrame, schema: SchemaConfig, validate: bool = False) -> DataFrame:
    """Map, default, cast, drop empty rows: one lazy chain. ``validate`` adds the breaker (one job)."""
    mapped = apply_defaults(map_columns(df, schema.columns, schema.preserve_unmapped), schema.columns)
    out = cast_columns(mapped, schema.columns)
    if schema.filter_empty_rows:
        out = drop_empty_rows(out, [s.target for s in schema.columns])
    if validate:
        require_breaker(out, schema.null_threshold, schema.columns)
    return out


def silver_dry_run(df: DataFrame, schema: SchemaConfig) -> dict:
    """What a silver pass would say, without making its table."""
    missing = missing_required(df.columns, schema.columns)
    try:
        mapped = map_columns(df, schema.columns, preserve_unmapped=True)
        result = breaker(cast_columns(mapped, schema.columns), schema.null_threshold, schema.columns)
    except MissingColumnsError:
        result = None
    return {"valid": not missing and (result is None or result.ok), "missing": missing, "breaker": result}


def write_silver(df: DataFrame, schema: SchemaConfig, path: str) -> BreakerResult:
    """Write the silver table to a fresh path, counting missing values on the way: one pass in all.

    A tripped breaker is an error; the caller publishes the path only when none was raised.
    """
    out = silver(df, schema)
    watched, seen = watch_nulls(out, breaker_columns(out, schema.columns))
    watched.write.parquet(path)
    verdict = judge_watch(seen, schema.null_threshold)
    if not verdict.ok:
        raise BreakerError(verdict.tripped, schema.null_threshold)
    return verdict


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.where("duplicate_count > 1").orderBy(F.desc("duplicate_count"), *keys)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of groups of fully equal rows."""
    groups = df.groupBy(*[F.col(name(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return groups.agg(F.count(F.lit(1)).alias("duplicate_groups"))


def value_frequency(df: DataFrame, column: str, limit: int = 20, unique: bool = True) -> DataFrame:
    """The most frequent values of a column, or just some of its values."""
    present = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    if not unique:
        return present.limit(limit)
    counted = present.groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), "value").limit(limit)


def heavy_values(df: DataFrame, column: str, limit: int = 20, candidates: int = 1000) -> DataFrame:
    """The same result as ``value_frequency``, without a shuffle of all values where a few stand out.

    A first pass keeps a summary of ``candidates`` counters per task, merged in the driver's one row: every value that makes up more than one
    in ``candidates`` of the rows is among them, and others may be. A second pass counts exactly the values of the summary. Any value outside
    has at most rows / candidates occurrences, so if more than that is the least count of the ``limit`` values found, they are the right ones;
    if not (many different values, none of them frequent), all values are counted.
    """
    present = df.where(F.col(name(column)).isNotNull()).select(F.col(name(column)).alias("value"))
    held = present.freqItems(["value"], 1.0 / candidates).select(F.explode("value_freqItems").alias("_item"))
    # at most as many rows as counters: written, so that its size is known and the summary is made once
    held = settle(held.distinct(), "heavy_values")
    counted = settle(present.join(held, F.col("value") == F.col("_item"), "left_semi").groupBy("value").agg(F.count(F.lit(1)).alias("count")), "heavy_counts")
    best = counted.orderBy(F.desc("count"), "value").limit(limit)
    n_found, least = best.agg(F.count(F.lit(1)), F.min("count")).first()
    if n_found == limit and least * candidates > present.count():
        return best
    return value_frequency(df, column, limit)


def validate_table(
    df: DataFrame, required: list[str] | None = None, unique: list[str] | None = None, not_null: list[str] | None = None,
    validators: dict[str, Column] | None = None,
) -> DataFrame:
    """Report rows (rule, item, severity, failures, ok).

    A missing column and missing values are errors, repeated values a warning. A validator is a
    condition that must hold on every row; a row where it is unknown fails it. The table is read once, whatever the number of rules.
    """
    have = set(df.columns)
    found = literal_table(
        df.sparkSession,
        [("required", c, "error", 0 if c in have else 1) for c in required or []],
        "rule string, item string, severity string, failures bigint",
    )
    n_rows = F.count(F.lit(1))
    counts = {("not_null", c, "error"): F.count_if(F.col(name(c)).isNull()) for c in not_null or [] if c in have}
    counts.update({("validator", label, "error"): F.count_if(~F.coalesce(cond, F.lit(False))) for label, cond in (validators or {}).items()})
    # rows beyond the first of each value, missing ones being one more value. Spark works all distinct counts out together: rows are
    # expanded to one key per column, and equal keys are merged before and after one shuffle
    counts.update({
        ("unique", c, "warning"): n_rows - F.count_distinct(F.col(name(c))) - F.when(F.count_if(F.col(name(c)).isNull()) > 0, 1).otherwise(0)
        for c in unique or [] if c in have
    })
    if counts:
        counted = df.agg(*[c.cast("bigint").alias(f"f_{i}") for i, c in enumerate(counts.values())])
        rows = ", ".join(f"{literal(rule)}, {literal(item)}, {literal(severity)}, f_{i}" for i, (rule, item, severity) in enumerate(counts))
        found = found.unionByName(counted.selectExpr(f"stack({len(counts)}, {rows}) AS (rule, item, severity, failures)"))
    return found.withColumn("ok", F.col("failures") == 0)


def integrity_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, missing values and type per column, and groups of equal rows, as (section, item, value), from one scan."""
    types = literal_table(df.sparkSession, [("type", c, t) for c, t in df.dtypes], "section string, item string, value string")
    # equal rows first, then everything from their counts: the table is read once
    groups = df.groupBy(*[F.col(name(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    total = lambda n: F.coalesce(F.sum(n), F.lit(0))
    counted = groups.agg(
        total(F.col("_n")).alias("n_rows"), F.count_if(F.col("_n") > 1).alias("n_equal"),
        *[total(F.when(F.col(name(c)).isNull(), F.col("_n"))).alias(f"n_{i}") for i, c in enumerate(df.columns)],
    )
    rows = [f"'rows', {literal(table)}, string(n_rows)", f"'duplicates', {literal(table)}, string(n_equal)"]
    rows += [f"'nulls', {literal(c)}, string(n_{i})" for i, c in enumerate(df.columns)]
    return counted.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (section, item, value)").unionByName(types)


def custom_checks(df: DataFrame, checks: dict[str, str]) -> dict[str, DataFrame]:
    """Named SQL checks; ``{table_name}`` stands for the table."""
    return {label: df.sparkSession.sql(sql, table_name=df) for label, sql in checks.items()}


def table_info(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column count per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(label).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))
        for label, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def dirty_report(df: DataFrame, column: str, chars: list[str] | None = None) -> DataFrame:
    """How many values hold a character to strip, before and after stripping."""
    col = F.col(name(column))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(has_any_char(col, chars)).alias("dirty_count"),
        F.count_if(has_any_char(strip_chars(col, chars), chars)).alias("remaining_dirty"),
    )


def clean_preview(df: DataFrame, column: str, chars: list[str] | None = None, limit: int = 10) -> DataFrame:
    col = F.col(name(column))
    shown = df.where(has_any_char(col, chars)).select(col.alias("original_value"), strip_chars(col, chars).alias("cleaned_value"))
    return shown.limit(limit)


def clean_numeric(df: DataFrame, column: str, chars: list[str] | None = None) -> DataFrame:
    return df.withColumn(column, strip_chars(F.col(name(column)), chars))


def failing_values(df: DataFrame, rules: dict[str, tuple[Column, Column]], samples: int = 5) -> DataFrame:
    """Per rule (value, condition under which it fails): failing values, different ones among them, and the least ``samples`` of these as text with
    how often each occurs, as (item, invalid_count, distinct_count, samples).

    All rules share one pass: rows give a pair for each rule they break, and equal pairs are merged before they are shuffled. The counts and the
    samples both come from that shuffle, which Spark runs once; samples are cut to the least few in every task before they meet.
    """
    broken = F.array(*[F.struct(F.lit(i).alias("i"), value.cast("string").alias("value"), F.coalesce(bad, F.lit(False)).alias("bad")) for i, (value, bad) in enumerate(rules.values())])
    pairs = df.select(F.explode(F.filter(broken, lambda x: x["bad"])).alias("x")).groupBy("x.i", "x.value").agg(F.count(F.lit(1)).alias("n"))
    totals = pairs.groupBy("i").agg(F.sum("n").alias("invalid_count"), F.count(F.lit(1)).alias("distinct_count"))
    least = pairs.withColumn("_r", F.row_number().over(Window.partitionBy("i").orderBy("value"))).where(F.col("_r") <= samples)
    least = least.groupBy(F.col("i").alias("_i")).agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("samples"))
    items = literal_table(df.sparkSession, [(i, label) for i, label in enumerate(rules)], "_item int, item string")
    found = items.join(totals, F.col("_item") == F.col("i"), "left").join(least, F.col("_item") == F.col("_i"), "left")
    none = F.expr("cast(array() as array<struct<value:string,n:bigint>>)")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return found.select("item", count("invalid_count"), count("distinct_count"), F.coalesce("samples", none).alias("samples"))


def lost_by_type(df: DataFrame, types: dict[str, str], samples: int = 5) -> DataFrame:
    """``failing_values`` of all columns that are to change their type: values that the new type cannot hold."""
    col = lambda c: F.col(name(c))
    return failing_values(df, {c: (col(c), col(c).isNotNull() & col(c).try_cast(t).isNull()) for c, t in types.items()}, samples)


def lost_by_cast(df: DataFrame, specs: list[ColumnSpec], samples: int = 5) -> DataFrame:
    """``failing_values`` of the casts of specifications."""
    present = [s for s in specs if s.target in df.columns and s.dtype != "VARCHAR"]
    col = lambda s: F.col(name(s.target))
    return failing_values(df, {s.target: (col(s), col(s).isNotNull() & cast_expr(col(s), s).isNull()) for s in present}, samples)


def unconvertible(df: DataFrame, column: str, dtype: str, samples: int = 5) -> DataFrame:
    """One row: values that do not convert, with the least few of them."""
    return lost_by_type(df, {column: dtype}, samples).select(F.transform("samples", lambda x: x["value"]).alias("samples"), "invalid_count")


def convert_column(df: DataFrame, column: str, dtype: str, validate: bool = True) -> DataFrame:
    """Change a column type; with ``validate`` every value must convert (one job)."""
    if validate:
        row = unconvertible(df, column, dtype).first()
        if row["invalid_count"]:
            raise ValueError(f"{row['invalid_count']} values of {column} do not convert to {dtype}: {row['samples']}")
    return df.withColumn(column, F.col(name(column)).try_cast(dtype))


def clean_and_convert(
    df: DataFrame, column: str, dtype: str, chars: list[str] | None = None, blank_as_null: bool = True
) -> DataFrame:
    """Strip characters, blanks to NULL, change the type: all of it or an error."""
    cleaned = clean_numeric(df, column, chars)
    if blank_as_null:
        col = F.col(name(column))
        cleaned = cleaned.withColumn(column, F.when(F.trim(col) != "", col))
    return convert_column(cleaned, column, dtype)
