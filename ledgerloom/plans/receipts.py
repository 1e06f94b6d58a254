"""Finance receipt report: wide daily text to long rows and pivots with margins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import recode, to_date
from ledgerloom.functions.text import name
from ledgerloom.operators.joins import fill_spine
from ledgerloom.operators.pivots import pivot_with_margins, wide_to_long
from ledgerloom.operators.shaping import rename_by_position
from ledgerloom.operators.tieout import check_status, status_report, tie_out
from ledgerloom.params import ReconParams
from ledgerloom.reference_data import RECEIPT_BANKS, RECEIPT_COLUMNS, RECEIPT_METRICS, SUBTOTAL
from ledgerloom.session import settle

AMOUNT = "decimal(24,4)"
TOTAL = "Grand Total"


def clean_receipts(raw: DataFrame, names: list[str] | None = None, date: str = "Date") -> DataFrame:
    """Name columns by position, read amounts (unreadable ones are zero), drop rows without a date."""
    renamed = rename_by_position(raw, names or RECEIPT_COLUMNS)
    read = [to_date(F.col(c)).alias(c) if c == date else
            F.expr(f"coalesce(try_cast({name(c)} AS {AMOUNT}), CAST(0 AS {AMOUNT})) AS {name(c)}") for c in renamed.columns]
    return renamed.select(*read).where(F.col(date).isNotNull())


def receipts_long(clean: DataFrame, p: ReconParams, banks: dict[str, str] | None = None) -> DataFrame:
    """One row per day of the period and bank."""
    banks = banks or RECEIPT_BANKS
    full = fill_spine(clean, p.beg, p.end)
    groups = {code: {m: f"{code}_{m}" for m in RECEIPT_METRICS} for code in banks}
    long = wide_to_long(full, ["Date"], groups, "Bank", RECEIPT_METRICS)
    return long.withColumn("Bank_Name", recode(F.col("Bank"), banks))


def receipt_pivot(long: DataFrame, metric: str, p: ReconParams, absolute: bool = False) -> DataFrame:
    """Day by bank with margins; ``absolute`` takes the size of finished cells, margins included."""
    inside = long.where(F.col("Date").between(F.lit(p.beg), F.lit(p.end)))
    return pivot_with_margins(inside, ["Date"], "Bank", metric, list(RECEIPT_BANKS), TOTAL, 0, F.abs if absolute else None)


def receipt_report(raw: DataFrame, p: ReconParams) -> dict[str, DataFrame]:
    long = settle(receipts_long(clean_receipts(raw), p), "frr_long_format")
    return {
        "frr_long_format": long,
        "frr_handling_fee": receipt_pivot(long, "Handling_Fee", p, absolute=True),
        "frr_remittance_fee": receipt_pivot(long, "Remittance_Fee", p),
        "frr_net_billing": receipt_pivot(long, "Net_Billing", p),
    }


def receipt_totals(pivot: DataFrame, total: str) -> DataFrame:
    """The margin row of a receipt pivot as (bank, total), banks by display name."""
    codes = list(RECEIPT_BANKS)
    row = pivot.where(F.col("Date") == TOTAL).select(*codes)
    return row.unpivot([], codes, "bank_code", total).select(
        recode(F.col("bank_code"), RECEIPT_BANKS).alias("bank"), "bank_code", total
    )


def tie_to_receipts(matrix: DataFrame, metric: str, pivot: DataFrame, tolerance=1) -> DataFrame:
    """Trust subtotals of one measure against the finance report, by bank."""
    subtotal = matrix.where(F.col("transaction_type") == SUBTOTAL).select("bank", F.col(metric).alias("left_total"))
    return tie_out(subtotal, receipt_totals(pivot, "right_total"), ["bank"], "left_total", "right_total", tolerance)


def daily_check(matrix: DataFrame, pivots: dict[str, DataFrame], tolerance=1) -> dict[str, DataFrame]:
    """Both tie-outs and one status row for each; differences warn and do not stop."""
    fee = tie_to_receipts(matrix, "total_service_fee", pivots["frr_handling_fee"], tolerance)
    billing = tie_to_receipts(matrix, "total_claimed", pivots["frr_net_billing"], tolerance)
    return {
        "validate_frr_handling_fee": fee,
        "validate_frr_net_billing": billing,
        "validation_summary": status_report(
            [check_status(fee, "FRR 手續費", tolerance), check_status(billing, "FRR 請款", tolerance)]
        ),
    }
