"""Bank-balance report: daily movements, workpaper, running balance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import align_on_key
from ledgerloom.operators.pivots import append_total, row_total
from ledgerloom.operators.rowwise import last_before, running_balance
from ledgerloom.operators.shaping import check_column_order, column_range
from ledgerloom.params import ReconParams
from ledgerloom.plans.receipts import TOTAL
from ledgerloom.session import settle

MOVEMENTS = (
    "Inbound", "Unsuccessful_ACH", "Outbound", "spl", "interest", "interbank", "offline_transfer", "withdraw_service_fee",
)


@dataclass(frozen=True)
class BalanceLayout:
    """Headers of the report. Ranges go by column order, the rest by name."""

    inbound: tuple[str, str]
    ach: tuple[str, str]
    outbound: tuple[str, ...]
    date: str = "Date"
    inbound_extra: tuple[str, ...] = ()
    spl: str = "spl"
    interest: str = "interest"
    interbank: str = "interbank"
    offline_transfer: str = "offline_transfer"
    service_fee: str = "service_fee"
    balance: str = "balance_1"
    expected_inbound: tuple[str, ...] = ()
    expected_outbound: tuple[str, ...] = ()


def layout_report(raw: DataFrame, layout: BalanceLayout) -> DataFrame:
    """Are the expected columns there, each group in one run? The last inbound column may move."""
    return check_column_order(
        raw, {"inbound": (list(layout.expected_inbound), True), "outbound": (list(layout.expected_outbound), False)}
    )


def daily_balances(raw: DataFrame, layout: BalanceLayout, p: ReconParams) -> DataFrame:
    """Sums by column group for each day of the period; columns that are absent count as zero."""
    have = raw.columns
    one = lambda c: row_total([c] if c in have else [])
    sums = {
        "Inbound": row_total(column_range(have, *layout.inbound, list(layout.inbound_extra))),
        "Unsuccessful_ACH": row_total(column_range(have, *layout.ach)),
        "Outbound": row_total([c for c in layout.outbound if c in have]),
        "spl": one(layout.spl),
        "interest": one(layout.interest),
        "interbank": one(layout.interbank),
        "offline_transfer": one(layout.offline_transfer),
        "withdraw_service_fee": one(layout.service_fee),
        "balance": one(layout.balance),
    }
    day = F.col(layout.date)
    return raw.where(day.between(F.lit(p.beg), F.lit(p.end))).select(
        day.alias("Date"), *[c.cast("decimal(28,4)").alias(n) for n, c in sums.items()]
    )


def with_receipt_fees(daily: DataFrame, handling: DataFrame, remittance: DataFrame) -> DataFrame:
    """Daily fee totals of the finance report beside the movements, joined on the day."""
    keyed = daily.withColumn("_day", F.col("Date").cast("string"))
    for pivot, name in ((remittance, "remittance_fee"), (handling, "handing_fee")):
        side = pivot.where(F.col("Date") != TOTAL).select(F.col("Date").alias("_day"), F.col(TOTAL).alias("_total"))
        keyed = align_on_key(keyed, side, ["_day"], {name: "_total"})
    return keyed.drop("_day")


def daily_workpaper(daily: DataFrame) -> DataFrame:
    """Five daily measures; inbound takes in the withdrawn service fee and own transfers."""
    amount = lambda c: F.coalesce(F.col(c), F.lit(0))
    return daily.select(
        "Date",
        F.col("remittance_fee"),
        (amount("Inbound") + amount("withdraw_service_fee") + amount("spl")).alias("Inbound"),
        "Unsuccessful_ACH",
        "Outbound",
        "handing_fee",
    )


def workpaper_with_total(workpaper: DataFrame) -> DataFrame:
    return append_total(
        workpaper, "Date", "Total", ["remittance_fee", "Inbound", "Unsuccessful_ACH", "Outbound", "handing_fee"]
    )


def opening_balance(raw: DataFrame, layout: BalanceLayout, p: ReconParams) -> DataFrame:
    """The balance of the last day before the period, zero if there is none."""
    return last_before(raw, layout.balance, layout.date, p.beg)


def with_running_balance(daily: DataFrame, opening: DataFrame, movement_cols: tuple[str, ...] = MOVEMENTS) -> DataFrame:
    """Daily movement and running balance. By default offline transfers count inside inbound and on
    their own again, as the report does; leave them out of ``movement_cols`` to count them once."""
    moved = daily.withColumn("daily_movement", row_total([c for c in movement_cols if c in daily.columns]))
    return running_balance(moved, "daily_movement", "Date", opening=opening.scalar())


def balance_report(raw: DataFrame, receipts: dict[str, DataFrame], layout: BalanceLayout, p: ReconParams) -> dict[str, DataFrame]:
    fees = receipts["frr_handling_fee"], receipts["frr_remittance_fee"]
    daily = settle(with_receipt_fees(daily_balances(raw, layout, p), *fees), "dfr_result")
    workpaper = daily_workpaper(daily)
    return {
        "dfr_columns": layout_report(raw, layout),
        "dfr_result": daily,
        "dfr_daily": workpaper,
        "dfr_wp": workpaper_with_total(workpaper),
        "dfr_with_balance": with_running_balance(daily, opening_balance(raw, layout, p)),
    }
