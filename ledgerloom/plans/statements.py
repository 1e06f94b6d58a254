"""Bank statements: one pass of conditional sums covers the rules of all banks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.masks import has_text, in_month, in_period, is_one_of, truth
from ledgerloom.operators.literals import literal_table
from ledgerloom.operators.pivots import order_by_list
from ledgerloom.params import ReconParams
from ledgerloom.reference_data import (
    CARD_STORE_TEXT, REFUND_STORE, REQUIRED_DATES, STATEMENT_ORDER, STATEMENT_TABLES, TARGET_STORES,
)

SUM_TYPE = "decimal(28,4)"


def loaded_rows(statements: DataFrame, p: ReconParams) -> DataFrame:
    """Rows of enabled banks whose required dates are present."""
    rule = F.lit(False)
    for bank in p.enabled_banks:
        cond = F.col("bank") == F.lit(bank)
        for date in REQUIRED_DATES.get(bank, ()):
            cond = cond & F.col(date).isNotNull()
        rule = rule | cond
    return statements.where(F.col("bank").isin(*p.enabled_banks)).where(rule)


def _near_periods(p: ReconParams) -> Column:
    """Rows that any period rule can touch; plain comparisons, so the scan can skip files."""
    low = min(p.last_beg, p.month_beg)
    high = max(p.end, p.next_month_beg)
    in_range = lambda c: F.col(c).between(F.lit(low), F.lit(high))
    return in_range("disbursement_date") | in_range("request_date")


# What each measure sums, by bank: (condition, amount column).
PERIOD_SUMS = {
    "claimed": {
        "cub": ("paid", "request_amount"),
        "ctbc": ("settled", "request_amount"),
        "nccc": ("paid", "request_amount"),
        "ub": ("paid_card_sale", "request_amount"),
        "taishi": ("paid", "request_amount"),
    },
    "returned_signed": {"cub": ("paid", "return_amount")},
    "carry_in": {
        "ctbc": ("unpaid_before", "request_amount"),
        "nccc": ("paid_not_asked", "request_amount"),
        "ub": ("late", "request_amount"),
    },
    "adjustment": {"ctbc": ("settled", "adjustment_amount")},
    "store_claimed": {"ub": ("target_store", "request_amount")},
    "net_paid": {"taishi": ("paid", "disbursement_amount")},
    "fee_base": {
        "cub": ("paid", "handling_fee"),
        "ctbc": ("settled", "handling_fee"),
        "nccc": ("paid", "handling_fee"),
        "ub": ("paid_main_store", "handling_fee"),
        "taishi": ("paid", "invoice_amount"),
    },
    "fee_extra": {"ctbc": ("settled", "adjustment_handling_fee")},
    "prior_fee": {
        "ctbc": ("unpaid_before", "handling_fee"),
        "nccc": ("late", "handling_fee"),
        "ub": ("late", "handling_fee"),
    },
    "fee_adjustment": {"ub": ("asked_refund", "handling_fee"), "taishi": ("zero_paid", "invoice_amount")},
    "tax_adjustment": {"taishi": ("zero_paid", "tax_amount")},
    "asked_claimed": {"ctbc": ("asked_month", "request_amount"), "nccc": ("asked", "request_amount")},
    "asked_fee": {"ctbc": ("asked_month", "invoice_amount"), "nccc": ("asked", "handling_fee")},
}


def _conditions(p: ReconParams) -> dict[str, Column]:
    """Every condition of the rules, worked out once per row."""
    paid_date, asked_date, store = F.col("disbursement_date"), F.col("request_date"), F.col("store_name")
    paid = in_period(paid_date, p.beg, p.end)
    asked = in_period(asked_date, p.beg, p.end)
    asked_before = in_period(asked_date, p.last_beg, p.last_end)
    paid_month, asked_month = in_month(paid_date, p.beg), in_month(asked_date, p.beg)
    return {
        "paid": paid,
        "asked": asked,
        "asked_month": asked_month,
        "settled": paid_month & asked_month,
        "unpaid_before": asked_before & ~in_period(paid_date, p.last_beg, p.last_end),
        "paid_not_asked": paid & ~asked,
        "late": paid & asked_before,
        "zero_paid": paid & truth(F.col("disbursement_amount") == 0),
        "target_store": paid_month & is_one_of(store, TARGET_STORES),
        "paid_card_sale": paid & asked & has_text(store, CARD_STORE_TEXT),
        "paid_main_store": paid & truth(store == F.lit(p.main_store)),
        "asked_refund": asked & truth(store == F.lit(REFUND_STORE)),
    }


def period_sums(statements: DataFrame, p: ReconParams) -> DataFrame:
    """The conditional sums by bank and category, cut to whole units: one scan, one partial aggregation."""
    amounts = sorted({amount for rules in PERIOD_SUMS.values() for _, amount in rules.values()})
    near = loaded_rows(statements, p).where(_near_periods(p))
    flagged = near.select("bank", "category", *amounts, *[c.alias(f"is_{n}") for n, c in _conditions(p).items()])

    def total(measure: str, rules: dict[str, tuple[str, str]]) -> Column:
        cases = " ".join(f"WHEN bank = '{b}' AND is_{cond} THEN {amount}" for b, (cond, amount) in rules.items())
        return F.expr(f"CAST(coalesce(CAST(sum(CASE {cases} END) AS {SUM_TYPE}), 0) AS BIGINT) AS {measure}")

    return flagged.groupBy("bank", "category").agg(*[total(m, rules) for m, rules in PERIOD_SUMS.items()])


def statement_profile(statements: DataFrame, p: ReconParams) -> DataFrame:
    """Row count and last record per table, over the whole table but only four narrow columns."""
    last = F.max_by("request_amount", "seq")
    return (
        loaded_rows(statements, p)
        .groupBy("bank", "category")
        .agg(F.count(F.lit(1)).alias("n_rows"), last.cast(SUM_TYPE).cast("bigint").alias("last_claimed"))
    )


def period_measures(statements: DataFrame, p: ReconParams, whole_table: bool = True) -> DataFrame:
    """One row of measures per bank and category.

    Row counts and the last record need the whole table; without them (``whole_table`` off) only the
    files near the period are read.
    """
    spark = statements.sparkSession
    tables = literal_table(spark, [t for t in STATEMENT_TABLES if t[0] in p.enabled_banks], "bank string, category string")
    base = statement_profile(statements, p) if whole_table else tables.selectExpr(
        "*", "CAST(NULL AS BIGINT) AS n_rows", "CAST(NULL AS BIGINT) AS last_claimed"
    )
    sums = period_sums(statements, p)
    filled = base.join(sums, ["bank", "category"], "left").na.fill(0, list(PERIOD_SUMS))
    return filled.selectExpr(
        "bank",
        "category",
        "n_rows",
        "claimed",
        "abs(returned_signed) AS returned",
        "carry_in",
        "adjustment",
        "CASE bank WHEN 'cub' THEN claimed - abs(returned_signed) WHEN 'ctbc' THEN claimed + carry_in + adjustment "
        "WHEN 'ub' THEN store_claimed WHEN 'taishi' THEN net_paid ELSE claimed END AS trust_amount",
        "CASE bank WHEN 'ctbc' THEN fee_base + fee_extra WHEN 'taishi' THEN fee_base - fee_adjustment ELSE fee_base END AS fee",
        "prior_fee",
        "fee_adjustment",
        "tax_adjustment",
        "CASE bank WHEN 'cub' THEN claimed - abs(returned_signed) WHEN 'ub' THEN last_claimed "
        "WHEN 'taishi' THEN fee_base - fee_adjustment ELSE asked_claimed END AS invoice_claimed",
        "CASE bank WHEN 'cub' THEN fee_base WHEN 'ub' THEN 0 WHEN 'taishi' THEN NULL ELSE asked_fee END AS invoice_fee",
    )


def statement_name(bank: Column, category: Column) -> Column:
    """Display name: banks with a single table go by their code."""
    return F.when(bank.isin("nccc", "taishi"), bank).otherwise(F.concat_ws("_", bank, category))


def bank_summary(measures: DataFrame) -> DataFrame:
    """Totals by the rule of each bank; columns a bank does not have stay NULL."""
    return measures.select(statement_name(F.col("bank"), F.col("category")).alias("name"), "*").selectExpr(
        "name",
        "bank",
        "claimed",
        "trust_amount",
        "CASE bank WHEN 'ub' THEN fee - prior_fee ELSE fee END AS fee_current",
        "CASE bank WHEN 'ctbc' THEN adjustment ELSE fee_adjustment END AS adjustment",
        "CASE bank WHEN 'cub' THEN returned END AS returned",
        "CASE WHEN bank IN ('ctbc', 'nccc', 'ub') THEN carry_in END AS carry_in",
        "CASE WHEN bank IN ('cub', 'ctbc', 'nccc', 'ub') THEN prior_fee END AS prior_fee",
        "CASE WHEN bank IN ('cub', 'ctbc') THEN fee + prior_fee WHEN bank = 'ub' THEN fee - fee_adjustment ELSE fee END AS fee_total",
        "CASE bank WHEN 'taishi' THEN tax_adjustment END AS tax_adjustment",
        "CASE WHEN bank IN ('cub', 'ctbc', 'nccc') THEN invoice_claimed END AS invoice_claimed",
        "CASE WHEN bank IN ('cub', 'ctbc', 'nccc') THEN invoice_fee END AS invoice_fee",
    )


def ordered_summary(summary: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rows in the given order; tables that are not in the list are left out."""
    return order_by_list(summary, "name", order or STATEMENT_ORDER)


def store_subtotals(statements: DataFrame, p: ReconParams) -> DataFrame:
    """Totals of the target stores in the current month, by table."""
    month = (F.col("disbursement_date") >= F.lit(p.month_beg)) & (F.col("disbursement_date") < F.lit(p.next_month_beg))
    return (
        loaded_rows(statements, p)
        .where((F.col("bank") == "ub") & month & F.col("store_name").isin(*TARGET_STORES))
        .groupBy("category", "store_name")
        .agg(
            F.sum("request_amount").alias("total_claimed"),
            F.sum("handling_fee").alias("total_service_fee"),
            F.sum("local_handling_fee").alias("total_local_service_fee"),
            F.sum("disbursement_amount").alias("total_paid"),
        )
    )


def container_checks(measures: DataFrame) -> DataFrame:
    """Sanity of each measure row: data present, signs, the store rule against its own parts."""
    return measures.select(
        "bank",
        "category",
        "n_rows",
        (F.col("n_rows") > 0).alias("has_rows"),
        (F.col("claimed") < 0).alias("negative_claimed"),
        (F.col("fee") < 0).alias("negative_fee"),
        (F.col("fee") + F.col("prior_fee") - F.abs(F.when(F.col("bank") == "ctbc", F.col("adjustment"))
            .otherwise(F.col("fee_adjustment")))).alias("total_service_fee"),
        F.when(F.col("bank") == "ub", F.col("claimed") + F.col("carry_in") - F.col("trust_amount")).alias("store_diff"),
    )
