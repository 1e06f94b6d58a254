"""Instalment reports: row-ordered extracts to totals by term."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.masks import has_text
from ledgerloom.functions.scalars import half_even, recode
from ledgerloom.operators.pivots import complete_grid
from ledgerloom.operators.rowwise import forward_fill, rows_before_marker
from ledgerloom.params import ReconParams
from ledgerloom.reference_data import TERM_LABELS
from ledgerloom.session import settle

MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class PlainLayout:
    """Columns of a report whose keys stand only on the first row of a group."""

    term: str = "分期數"
    amount: str = "金額"
    fee: str = "手續費"
    row_kind: str = "交易類別"
    skip_kinds: tuple[str, ...] = ("小計",)
    fill: tuple[str, ...] = ("請款月", "分期數", "請款商店代號", "請款商店名稱")
    part: tuple[str, ...] = ("file_no",)
    seq: str = "seq"


def rate_lookup(matrix: DataFrame, index: str = "index", skip: tuple[str, ...] = ("level_0",), rate_type: str = "decimal(15,8)") -> DataFrame:
    """Rate matrix (rows = term, columns = bank) to (bank, term, rate); blank cells drop out.

    Whole-number terms are padded to two digits. A cell that is no number keeps its text, as does one that ``rate_type`` cannot hold.
    """
    banks = [c for c in matrix.columns if c not in (index, *skip)]
    long = matrix.select(F.col(index).cast("string").alias("term"), *[F.col(b).cast("string") for b in banks]).unpivot(
        ["term"], banks, "bank", "rate_text"
    )
    digits = F.col("term").rlike("^[0-9]+$")
    number = F.col("term").try_cast("int").cast("string")
    padded = F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)
    return long.where(F.trim("rate_text") != "").select(
        "bank",
        F.when(digits, padded).otherwise(F.col("term")).alias("term"),
        F.trim("rate_text").try_cast(rate_type).alias("rate"),
        "rate_text",
    )


def plain_totals(report: DataFrame, layout: PlainLayout = PlainLayout(), by: tuple[str, ...] = ()) -> DataFrame:
    """Claimed and fee by term. Subtotal rows go first, then the keys are filled forward.

    Only the term is filled: the other keys do not reach the totals.
    """
    kind = F.col(layout.row_kind)
    rows = report.where(kind.isNotNull() & ~kind.isin(*layout.skip_kinds))
    if layout.term in layout.fill:
        slim = rows.select(*dict.fromkeys([*by, *layout.part, layout.seq, layout.term, layout.amount, layout.fee]))
        rows = forward_fill(slim, [layout.term], [*dict.fromkeys([*by, *layout.part])], layout.seq)
    return (
        rows.where(F.col(layout.term).isNotNull())
        .groupBy(*by, F.col(layout.term).alias("transaction_type"))
        .agg(
            F.sum(F.col(layout.amount).cast(MONEY)).alias("total_claimed"),
            F.sum(F.col(layout.fee).cast(MONEY)).alias("total_service_fee"),
        )
    )


def label_terms(totals: DataFrame) -> DataFrame:
    """Two-digit terms to their labels; other terms become NULL."""
    return totals.withColumn("transaction_type", recode(F.col("transaction_type"), TERM_LABELS, keep=False))


def sheet_totals(sheets: DataFrame, statements: DataFrame, p: ReconParams, sheet_pattern: str = r"\d{4}") -> DataFrame:
    """Sheets named by request date, kept where a statement row of that date was paid in the period.

    Instalment rows count under their term, adjustments under 3期 as well. The non-instalment total
    takes own-bank rows (no card), other domestic cards and adjustments, never the TOTAL row; the
    adjustments are repeated as ``adj`` for information.
    """
    # a few hundred dates at most, written so that their size is known
    dates = settle(
        statements.where((F.col("bank") == "ctbc") & F.col("disbursement_date").between(F.lit(p.beg), F.lit(p.end)))
        .select("category", F.date_format("request_date", "MMdd").alias("md"))
        .distinct(),
        "paid_dates",
    )
    split = F.col("source").contains("分")
    rows = (
        sheets.where(F.col("source").rlike(sheet_pattern))
        .withColumn("category", F.when(split, F.lit("installment")).otherwise(F.lit("noninstallment")))
        .withColumn("md", F.when(split, F.replace("source", F.lit("分-"), F.lit(""))).otherwise(F.col("source")))
        .join(dates, ["category", "md"], "left_semi")
    )
    inst = F.col("category") == "installment"
    card = F.col("card")
    term = F.when(F.col("term").isin(3, 6, 12, 24), F.concat(F.col("term").cast("string"), F.lit("期")))
    own = card.isNull() | card.isin("非本行國內", "帳務調整")
    first = F.when(inst, term).when(own, F.lit("normal"))
    second = F.when(inst, F.when(has_text(F.col("product"), "調"), F.lit("3期"))).when(card == "帳務調整", F.lit("adj"))
    totals = (
        rows.select("amount", "fee", F.explode(F.array_compact(F.array(first, second))).alias("transaction_type"))
        .groupBy("transaction_type")
        .agg(F.sum("amount").alias("total_claimed"), F.sum("fee").alias("total_service_fee"))
    )
    grid = complete_grid(totals, {"transaction_type": ["3期", "6期", "12期", "24期", "normal", "adj"]})
    return grid.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in ("total_claimed", "total_service_fee")})


def rated_totals(report: DataFrame, rates: DataFrame, bank: str = "ub") -> DataFrame:
    """Totals by term with the fee computed from the rate table next to the reported fee."""
    totals = (
        report.where(F.col("store_name").isNotNull() & F.col("kind").isNotNull())
        .groupBy("term")
        .agg(
            F.sum(F.col("amount").cast("bigint")).alias("total_claimed"),
            F.sum(F.col("fee").cast("bigint")).alias("total_service_fee"),
        )
    )
    rate = rates.where(F.col("bank") == bank).select("term", F.col("rate").alias("service_fee_rate"))
    joined = totals.join(rate, "term", "left")
    computed = half_even(F.col("total_claimed").cast(MONEY) * F.col("service_fee_rate"), 2)
    return label_terms(joined.withColumnRenamed("term", "transaction_type")).withColumn(
        "calculated_service_fee", computed
    )


def card_totals(report: DataFrame, rates: DataFrame) -> DataFrame:
    """Two sheets, general cards and vouchers: amount rows above the count marker, fee by rate per row."""
    above = rows_before_marker(report, F.col("card") == "總筆數", ["sheet", "file_no"], "seq")
    keyed = forward_fill(above, ["transaction_type", "count_and_amount"], ["sheet", "file_no"], "seq")
    rows = (
        keyed.withColumn("transaction_type", F.replace("transaction_type", F.lit(" "), F.lit("")))
        .where(~F.col("transaction_type").contains("小計") & (F.col("count_and_amount") == "金額"))
        .withColumn("amount", F.col("subtotal").cast("bigint").cast(MONEY))
        .withColumn("rate_bank", F.when(F.col("sheet") == "voucher", F.lit("taishi_voucher")).otherwise(F.lit("taishi")))
    )
    rate = rates.select(F.col("bank").alias("rate_bank"), F.col("term").alias("transaction_type"), "rate")
    priced = rows.join(rate, ["rate_bank", "transaction_type"], "left").withColumn(
        "service_fee", half_even(F.col("amount") * F.col("rate"), 2)
    )
    # adding the two sheets by term, a term missing in one counting as zero, is one sum over both
    return sum_by_term(priced.withColumnsRenamed({"amount": "total_claimed", "service_fee": "total_service_fee"}))


def sum_by_term(rows: DataFrame) -> DataFrame:
    """Totals by term over rows of several reports; missing amounts count as zero."""
    return rows.groupBy("transaction_type").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in ("total_claimed", "total_service_fee")]
    )


def instalment_totals(
    plain: DataFrame, sheets: DataFrame, rated: DataFrame, cards: DataFrame, matrix: DataFrame,
    statements: DataFrame, p: ReconParams, plain_layout: PlainLayout, listed_layout: PlainLayout, index: str = "index",
) -> dict[str, DataFrame]:
    """Totals by term for each bank, keyed by bank code."""
    rates = rate_lookup(matrix, index)
    report = F.col("report")
    both = plain_totals(plain.where(report.isin("cub_individual", "cub_nonindividual")), plain_layout, ("report",))
    return {
        "ub": rated_totals(rated, rates),
        "cub": sum_by_term(both),
        "nccc": label_terms(plain_totals(plain.where(report == "nccc"), listed_layout)),
        "taishi": card_totals(cards, rates),
        "ctbc": sheet_totals(sheets, statements, p),
    }
