"""Commission and acquiring fees, worked on the long trust matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import half_even, ratio
from ledgerloom.functions.text import literal, map_of
from ledgerloom.operators.pivots import complete_grid, order_position
from ledgerloom.operators.rowwise import share_of_subtotal
from ledgerloom.params import ReconParams
from ledgerloom.plans.receipts import tie_to_receipts
from ledgerloom.plans.trust import MEASURES, trust_wide
from ledgerloom.reference_data import (
    INSTALMENT_TYPES, MATRIX_BANKS, PAYMENT_BANKS, PAYMENT_ROWS, PLUG_BANKS, SUBTOTAL, TRANSACTION_TYPES,
)
from ledgerloom.session import settle

AMOUNT = "decimal(24,4)"
ALL_ROWS = [*TRANSACTION_TYPES, SUBTOTAL]


def zero_filled(matrix: DataFrame) -> DataFrame:
    return matrix.withColumns({m: F.coalesce(F.col(m), F.lit(0)).cast(AMOUNT) for m in MEASURES})


def _add_to_cells(matrix: DataFrame, measure: str, amounts: dict, own_row) -> DataFrame:
    """Add an amount per bank to one row of that bank and to its subtotal."""
    extra = F.lit(0).cast(AMOUNT)
    for bank, amount in amounts.items():
        hit = (F.col("bank") == bank) & F.col("transaction_type").isin(own_row(bank), SUBTOTAL)
        extra = F.when(hit, F.lit(amount).cast(AMOUNT)).otherwise(extra)
    return matrix.withColumn(measure, (F.col(measure) + extra).cast(AMOUNT)) if amounts else matrix


def apply_claimed_adjustments(matrix: DataFrame, amounts: dict) -> DataFrame:
    """Adjust claims of a bank: its normal row (NCCC: 3期) and its subtotal."""
    return _add_to_cells(matrix, "total_claimed", amounts, lambda bank: "3期" if bank == "NCCC" else "normal")


def apply_fee_rounding(matrix: DataFrame, amounts: dict) -> DataFrame:
    """Put the rounding tail of a fee on the normal row and the subtotal; zero changes nothing."""
    return _add_to_cells(matrix, "total_service_fee", {b: a for b, a in amounts.items() if a}, lambda bank: "normal")


def commission_by_term(matrix: DataFrame, p: ReconParams, count_subtotal_twice: bool = False) -> DataFrame:
    """Claimed per bank, row total, rate, commission and commission with tax, by term.

    The subtotal row shows the sum of the term commissions. ``count_subtotal_twice`` adds the
    subtotal row's own commission to that sum.
    """
    claims = [f"CAST(coalesce(sum(CASE WHEN bank = '{b}' THEN total_claimed END), 0) AS {AMOUNT}) AS `{b}_total_claimed`"
              for b in MATRIX_BANKS]
    rows = matrix.groupBy("transaction_type").agg(
        *[F.expr(c) for c in claims],
        F.coalesce(F.sum("total_claimed"), F.lit(0)).cast(AMOUNT).alias("subtotal"),
    )
    rates = ", ".join(f"{literal(k)}, CAST({v} AS DECIMAL(9,6))" for k, v in p.charge_rates.items())
    rate = F.expr(f"coalesce(try_element_at(map({rates}), transaction_type), CAST(0 AS DECIMAL(9,6)))")
    own = half_even(F.col("subtotal") * F.col("charge_rate"), 0)
    is_total = F.col("transaction_type") == SUBTOTAL
    # at most six rows by now: one per term
    summed = F.sum(F.when(is_total & F.lit(not count_subtotal_twice), F.lit(0)).otherwise(F.col("_own"))).over(
        Window.partitionBy(F.lit(1))
    )
    priced = rows.withColumn("charge_rate", rate).withColumn("_own", own).withColumn(
        "commission_fee", F.when(is_total, summed).otherwise(F.col("_own"))
    )
    return with_tax(priced.drop("_own"), p, "commission_fee", "spe_charge_with_tax")


def with_tax(df: DataFrame, p: ReconParams, fee: str, out: str) -> DataFrame:
    """Fee including tax, in whole units, halves to even."""
    factor = F.lit(1 + p.tax_rate).cast("decimal(9,6)")
    return df.withColumn(out, half_even(F.col(fee).cast(AMOUNT) * factor, 0))


def plug_summary(matrix: DataFrame, validation: DataFrame) -> DataFrame:
    """Fees of two banks from the tie-out: subtotal as tied, normal as what the terms leave."""
    tied = validation.where((F.col("metric") == "total_service_fee") & F.col("bank").isin(*PLUG_BANKS)).select(
        "bank", F.col("right_amount").alias("_tied")
    )
    terms = matrix.where(F.col("transaction_type").isin(*INSTALMENT_TYPES)).groupBy("bank").agg(
        F.sum("total_service_fee").alias("_terms")
    )
    kind, known = F.col("transaction_type"), F.col("_tied").isNotNull()
    fee = (
        F.when(known & (kind == SUBTOTAL), F.col("_tied"))
        .when(known & (kind == "normal"), F.col("_tied") - F.col("_terms"))
        .otherwise(F.col("total_service_fee"))
    )
    return (
        matrix.join(tied, "bank", "left").join(terms, "bank", "left")
        .withColumn("total_service_fee", fee.cast(AMOUNT))
        .select("transaction_type", "bank", *MEASURES)
    )


def summary_long(wide: DataFrame, end_date: str) -> DataFrame:
    """``bank_metric`` columns to rows (bank, amt_type) stamped with the period."""
    names = [c for c in wide.columns if c != "transaction_type"]
    long = wide.unpivot(["transaction_type"], [F.col(f"`{c}`") for c in names], "flat", "amount")
    flat = F.replace(F.replace("flat", F.lit("_total"), F.lit("")), F.lit("service"), F.lit("acquiring"))
    parts = F.split(flat, "_")
    return long.select(
        "transaction_type", "amount", parts[0].alias("bank"), parts[1].alias("amt_type"), F.lit(end_date).alias("period")
    )


def with_charge_rate(long: DataFrame) -> DataFrame:
    """Acquiring over claimed of the normal row, on the normal acquiring rows of each bank."""
    amount = lambda kind: F.max(F.when(F.col("amt_type") == kind, F.col("amount"))).cast("double")
    rates = long.where(F.col("transaction_type") == "normal").groupBy("bank").agg(
        F.bround(F.try_divide(amount("acquiring"), amount("claimed")), 4).alias("charge_rate")
    )
    shown = (F.col("transaction_type") == "normal") & (F.col("amt_type") == "acquiring")
    return long.join(rates, "bank", "left").withColumn("charge_rate", F.when(shown, F.col("charge_rate")))


def payment_report(long: DataFrame, end_date: str) -> DataFrame:
    """Report of one period: a row per term, subtotal, OCP (rates) and Percentage (bank shares).

    One grouping-set pass gives the term rows and the subtotal; the two rate rows are read off the
    subtotal row.
    """
    of_period = long.where((F.col("period") == end_date) & F.col("transaction_type").isin(*TRANSACTION_TYPES))
    n = range(len(MATRIX_BANKS))
    first, whole = [], []
    for i, b in enumerate(MATRIX_BANKS):
        for kind, value in (("claimed", "amount"), ("acquiring", "amount"), ("rate", "charge_rate")):
            of_kind = "acquiring" if kind == "rate" else kind
            first.append(f"max(CASE WHEN bank = '{b}' AND amt_type = '{of_kind}' THEN {value} END) AS {kind}_{i}")
            whole.append(f"max({kind}_{i}) AS {kind}_{i}" if kind == "rate"
                         else f"CAST(sum(coalesce({kind}_{i}, 0)) AS DOUBLE) AS {kind}_{i}")
    cells = of_period.groupBy("transaction_type").agg(*[F.expr(e) for e in first])
    terms = complete_grid(cells, {"transaction_type": TRANSACTION_TYPES})
    key = F.col("transaction_type")
    rows = terms.groupingSets([[key], []], key).agg(*[F.expr(e) for e in whole], F.grouping("transaction_type").alias("is_total"))
    rows = rows.selectExpr("*", " + ".join(f"claimed_{i}" for i in n) + " AS claimed", " + ".join(f"acquiring_{i}" for i in n) + " AS acquiring")

    none = "CAST(NULL AS DOUBLE)"
    overall = "CASE WHEN claimed > 0 THEN acquiring / claimed END"
    label = f"coalesce(try_element_at({map_of(PAYMENT_ROWS)}, transaction_type), '{SUBTOTAL}')"

    def line(label: str, claimed: list[str], acquiring: list[str], *rest: str) -> str:
        fields = {"transaction_type": label}
        for i, b in enumerate(MATRIX_BANKS):
            fields[PAYMENT_BANKS[b]] = claimed[i]
            fields[f"{PAYMENT_BANKS[b]} Acquiring fee"] = acquiring[i]
        fields.update(zip(("Rebate from Cathay", "Total Transaction", "Total Acquiring Fee", "rate_charge"), rest))
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    amounts = line(label, [f"claimed_{i}" for i in n], [f"acquiring_{i}" for i in n],
                   "0.0D", "claimed", "acquiring", "try_divide(acquiring, claimed)")
    ocp = line("'OCP'", [none] * len(n), [f"rate_{i}" for i in n], none, none, overall, none)
    share = line("'Percentage'", [f"CASE WHEN claimed > 0 THEN claimed_{i} / claimed END" for i in n], [none] * len(n),
                 none, none, none, none)
    return rows.selectExpr(f"inline(CASE WHEN is_total = 0 THEN array({amounts}) ELSE array({amounts}, {ocp}, {share}) END)")


def net_card_revenue(fees: DataFrame, commissions: DataFrame, p: ReconParams) -> DataFrame:
    """Commission with tax less acquiring fees and a fixed deduction, by month, from the subtotal rows."""
    acquiring = (
        fees.where((F.col("amt_type") == "acquiring") & (F.col("transaction_type") == SUBTOTAL))
        .groupBy("period", "transaction_type")
        .agg(F.sum("amount").alias("amount"))
        .withColumn("period", F.substring("period", 1, 7))
    )
    charged = with_tax(
        commissions.where(F.col("transaction_type") == SUBTOTAL)
        .select("transaction_type", "commission_fee", F.substring("end_date", 1, 7).alias("period")),
        p, "commission_fee", "commission_fee_inc_tax",
    )
    net = F.col("commission_fee_inc_tax") - F.col("amount") - F.lit(p.revenue_deduction).cast(AMOUNT)
    return acquiring.join(charged, ["period", "transaction_type"], "inner").select("period", net.alias("cc_net_revenue"))


def commission_share(commissions: DataFrame, p: ReconParams, seq: str = "seq") -> DataFrame:
    """Commission of each term over the subtotal row of its period, to four places."""
    slim = commissions.withColumn("_fee", F.col("commission_fee").cast("double"))
    shared = share_of_subtotal(slim, "end_date", "transaction_type", SUBTOTAL, "_fee", seq, "percentage")
    return with_tax(shared, p, "commission_fee", "commission_fee_inc_tax").select(
        "transaction_type", "commission_fee", "commission_fee_inc_tax", "charge_rate", "end_date", "percentage"
    )


def fee_ratio(fees: DataFrame) -> DataFrame:
    """Acquiring over claimed by period and term, back to one row per amount type, newest period first."""
    amount = lambda kind: F.coalesce(F.sum(F.when(F.col("amt_type") == kind, F.col("amount"))), F.lit(0))
    sums = fees.groupBy("period", "transaction_type").agg(
        amount("claimed").alias("claimed"), amount("acquiring").alias("acquiring")
    )
    share = F.bround(ratio(F.col("acquiring").cast("double"), F.col("claimed").cast("double"), 0), 4)
    long = sums.withColumn("percentage", share).unpivot(
        ["transaction_type", "period", "percentage"], ["claimed", "acquiring"], "amt_type", "amount"
    )
    return long.select("transaction_type", "amt_type", "amount", "period", "percentage").orderBy(
        F.desc("period"), order_position("transaction_type", ALL_ROWS), F.desc("amt_type")
    )


def fee_pipeline(
    matrix: DataFrame, validation: DataFrame, net_billing: DataFrame, fees: DataFrame, commissions: DataFrame, p: ReconParams
) -> dict[str, DataFrame]:
    """All fee results of a period from the trust matrix, its tie-out, the receipts and the histories."""
    end_date = p.end.isoformat()
    adjusted = apply_claimed_adjustments(zero_filled(matrix), p.claimed_adjustments)
    commission = commission_by_term(adjusted, p)
    summary = settle(plug_summary(apply_fee_rounding(adjusted, p.fee_rounding), validation), "apcc_summary")
    wide = trust_wide(summary)
    long = with_charge_rate(summary_long(wide, end_date))
    return {
        "apcc_acquiring_charge": commission,
        "apcc_acquiring_charge_DW": commission.drop("spe_charge_with_tax").withColumn("end_date", F.lit(end_date)),
        "apcc_validate_frr": tie_to_receipts(adjusted, "total_claimed", net_billing, p.tolerance),
        "apcc_summary": wide,
        "apcc_summary_long": long,
        "payment_report": payment_report(long, end_date),
        "net_cc_rev": net_card_revenue(fees, commissions, p),
        "spe_charge_proportion": commission_share(commissions, p),
        "acquiring_proportion": fee_ratio(fees),
    }
