"""Bank summary checked against the invoices of the period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.masks import has_text
from ledgerloom.params import ReconParams
from ledgerloom.plans.statements import bank_summary, ordered_summary, period_measures

FEE_TEXT = "手續費"


def invoice_summary(invoices: DataFrame, p: ReconParams) -> DataFrame:
    """Net, tax and gross by category and fee flag; dates come with or without dashes.

    The months of the period as text, in both forms, are compared with the column as it is: that condition reaches the scan, which skips
    other months where invoices lie by date. The parsed day decides.
    """
    text = F.col("invoice_date")
    day = F.try_to_date(F.replace(text, F.lit("-"), F.lit("")), "yyyyMMdd")
    dashed, plain = (text.between(p.beg.strftime(f), p.end.strftime(f) + "~") for f in ("%Y-%m", "%Y%m"))
    return (
        invoices.where((dashed | plain) & day.between(F.lit(p.beg), F.lit(p.end)))
        .groupBy("category", has_text(F.col("invoice_description"), FEE_TEXT).alias("is_handling_fee"))
        .agg(
            F.sum("amount_excl_tax").alias("total_amount_excl_tax"),
            F.sum("tax_amount").alias("total_tax_amount"),
            F.sum("amount_incl_tax").alias("total_amount_incl_tax"),
        )
    )


def with_invoices(summary: DataFrame, invoices: DataFrame) -> DataFrame:
    """Fee invoices beside the summary. The ub statements hold no invoice fee: it comes from here."""
    fee = invoices.where("is_handling_fee").select(
        F.col("category").alias("name"), "total_tax_amount", "total_amount_incl_tax"
    )
    gross = F.col("total_amount_incl_tax")
    invoice_fee = F.when(F.col("bank") == "ub", gross).otherwise(F.col("invoice_fee").cast("decimal(28,2)"))
    checked = F.when(F.col("bank") == "taishi", F.col("fee_current")).otherwise(F.col("invoice_fee"))
    return (
        summary.join(fee, "name", "left")
        .withColumn("invoice_fee", invoice_fee)
        .withColumn("invoice_diff", checked - gross)
    )


def escrow_summary(statements: DataFrame, invoices: DataFrame, p: ReconParams) -> DataFrame:
    """Summary of all enabled banks with their invoice check, in display order."""
    summary = bank_summary(period_measures(statements, p, whole_table=False))
    out = with_invoices(summary, invoice_summary(invoices, p))
    return ordered_summary(out).withColumn("bank", F.split_part("name", F.lit("_"), F.lit(1)))
