"""Trust-account matrix: claimed and fee by term and bank, kept long until the report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import known_or, recode
from ledgerloom.operators.pivots import add_subtotal, complete_grid, order_by_list
from ledgerloom.operators.tieout import tie_out
from ledgerloom.reference_data import (
    BANK_NAMES, INSTALMENT_TYPES, MATRIX_BANKS, PLUG_BANKS, SUBTOTAL, TRANSACTION_TYPES,
)
from ledgerloom.session import settle, settle_all

MEASURES = ["total_claimed", "total_service_fee"]


def trust_matrix(totals: dict[str, DataFrame], summary: DataFrame) -> DataFrame:
    """Rows (transaction_type, bank) with both measures, subtotal rows included.

    For two banks the non-instalment claim is what is left of the statement total.
    """
    parts = [
        df.select("transaction_type", *[F.col(m).cast("decimal(24,4)").alias(m) for m in MEASURES])
        .where(F.coalesce(F.col("transaction_type") != "adj", F.lit(True)))
        .withColumn("bank", F.lit(BANK_NAMES[bank]))
        for bank, df in totals.items()
    ]
    cells = (
        reduce(DataFrame.unionByName, parts)
        .groupBy(known_or(F.col("transaction_type"), INSTALMENT_TYPES, "normal").alias("transaction_type"), "bank")
        .agg(*[F.sum(m).cast("decimal(24,4)").alias(m) for m in MEASURES])
    )
    grid = complete_grid(cells, {"transaction_type": TRANSACTION_TYPES, "bank": MATRIX_BANKS})
    # the grid has one row per term and bank, so this window holds a handful of rows
    terms = F.sum(F.when(F.col("transaction_type") != "normal", F.col("total_claimed"))).over(Window.partitionBy("bank"))
    statement = summary.groupBy(recode(F.col("bank"), BANK_NAMES).alias("bank")).agg(F.sum("trust_amount").alias("_trust"))
    plug = (F.col("transaction_type") == "normal") & F.col("bank").isin(*PLUG_BANKS)
    plugged = (
        grid.withColumn("_terms", F.coalesce(terms, F.lit(0)))
        .join(statement, "bank", "left")
        .withColumn(
            "total_claimed",
            F.when(plug, F.col("_trust") - F.col("_terms")).otherwise(F.col("total_claimed")).cast("decimal(24,4)"),
        )
        .select("transaction_type", "bank", *MEASURES)
    )
    return add_subtotal(plugged, "transaction_type", SUBTOTAL, ["bank"], MEASURES)


def trust_validation(matrix: DataFrame, summary: DataFrame, tolerance=1) -> DataFrame:
    """Subtotals against the statement summary, by measure and bank."""
    left = matrix.where(F.col("transaction_type") == SUBTOTAL).unpivot(["bank"], MEASURES, "metric", "left_total")
    by_bank = summary.groupBy(recode(F.col("bank"), BANK_NAMES).alias("bank")).agg(
        F.sum(F.when(F.col("bank") == "taishi", F.col("claimed")).otherwise(F.col("trust_amount")))
        .cast("decimal(24,4)").alias("total_claimed"),
        F.sum("fee_total").cast("decimal(24,4)").alias("total_service_fee"),
    )
    right = by_bank.unpivot(["bank"], MEASURES, "metric", "right_total")
    return tie_out(left, right, ["metric", "bank"], "left_total", "right_total", tolerance)


def trust_wide(matrix: DataFrame, claimed_only: bool = False) -> DataFrame:
    """Report form: one row per term, columns ``bank_metric``, missing cells zero, rows in term order."""
    metrics = MEASURES[:1] if claimed_only else MEASURES
    cells = [F.expr(f"coalesce(sum(CASE WHEN bank = '{b}' THEN {m} END), 0) AS `{b}_{m}`") for m in metrics for b in MATRIX_BANKS]
    return order_by_list(matrix.groupBy("transaction_type").agg(*cells), "transaction_type", [*TRANSACTION_TYPES, SUBTOTAL])


def matrix_from_wide(wide: DataFrame) -> DataFrame:
    """Back from ``bank_metric`` columns to (transaction_type, bank, metric, amount)."""
    names = [c for c in wide.columns if c.endswith(tuple(f"_{m}" for m in MEASURES))]
    long = wide.unpivot(["transaction_type"], [F.col(f"`{c}`") for c in names], "flat", "amount")
    metric = F.regexp_extract("flat", "(total_claimed|total_service_fee)$", 1)
    return long.select(
        "transaction_type", F.regexp_replace("flat", "_(total_claimed|total_service_fee)$", "").alias("bank"),
        metric.alias("metric"), "amount",
    )


def settled_matrix(totals: dict[str, DataFrame], summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written matrix and statement summary. The totals of the banks are independent and run side by side."""
    settled = settle_all({**totals, "escrow_summary": summary})
    statement = settled.pop("escrow_summary")
    return settle(trust_matrix(settled, statement), "trust_account_fee"), statement


def trust_workpaper(totals: dict[str, DataFrame], summary: DataFrame) -> dict[str, DataFrame]:
    """Matrix, report form and tie-out."""
    matrix, statement = settled_matrix(totals, summary)
    return {
        "trust_account_fee": matrix,
        "trust_account_fee_wide": trust_wide(matrix),
        "trust_account_validation": trust_validation(matrix, statement),
    }
