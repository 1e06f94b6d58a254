"""Queries: instalment reports, trust matrix, receipts and their tie-outs."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions.scalars import recode
from ledgerloom.operators.joins import add_aggregates
from ledgerloom.operators.literals import literal_table
from ledgerloom.operators.rowwise import forward_fill, rows_before_marker
from ledgerloom.operators.tieout import difference_summary
from ledgerloom.plans import instalments as inst
from ledgerloom.plans import receipts as rc
from ledgerloom.plans import trust as tr
from ledgerloom.plans.statements import bank_summary, period_measures
from ledgerloom.reference_data import RECEIPT_BANKS, SUBTOTAL
from ledgerloom.registry.core import register
from ledgerloom.registry.q_statements import CTES as STATEMENT_CTES
from ledgerloom.registry.q_statements import PAID
from ledgerloom.registry.views import DAILY, PERIOD
from ledgerloom.registry.views import PERIOD as P
from ledgerloom.registry.views import view

KEYED = inst.PlainLayout(term="term", amount="amount", fee="fee", row_kind="kind", fill=("term",))
LISTED = inst.PlainLayout(term="row_term", amount="amount", fee="fee", row_kind="row_term",
                          skip_kinds=("小計", "合計", "總計"), fill=())

MONEY = "DECIMAL(18,2)"
TERM = "CASE {0} WHEN '03' THEN '3期' WHEN '06' THEN '6期' WHEN '12' THEN '12期' WHEN '24' THEN '24期' END"
OUT = ("CAST(total_claimed AS DOUBLE) AS total_claimed, CAST(total_service_fee AS DOUBLE) AS total_service_fee")
FILL = "OVER (PARTITION BY {0} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

_RECEIPT_AT = {"TSPG": (1, 2, 3, None, 4), "CTBC": (5, 6, 7, None, 8), "NCCC": (9, 10, 11, None, 12),
               "CUB": (13, 14, 15, 16, 17), "UBOT": (18, 19, 21, 20, 22)}


def _receipt_branch(code: str) -> str:
    names = ["Net_Billing", "Handling_Fee", "Adjustment", "Remittance_Fee", "Net_Disbursement"]
    cols = [f"COALESCE(TRY_CAST(c{at} AS DECIMAL(24,4)), 0) AS {n}" if at else f"0 AS {n}"
            for n, at in zip(names, _RECEIPT_AT[code])]
    return (f"SELECT d AS Date, '{code}' AS Bank, '{RECEIPT_BANKS[code]}' AS Bank_Name, {', '.join(cols)} "
            f"FROM {{o_spine}} LEFT JOIN {{receipt_raw}} ON TRY_CAST(c0 AS DATE) = d")


def _pivot(metric: str, post: str = "") -> str:
    cells = ", ".join(f"CAST({post}(COALESCE(SUM({metric}) FILTER (WHERE Bank = '{b}'), 0)) AS DOUBLE) AS \"{b}\"" for b in RECEIPT_BANKS)
    whole = f'CAST({post}(SUM({metric})) AS DOUBLE) AS "Grand Total"'
    return (f"SELECT CAST(Date AS STRING) AS Date, {cells}, {whole} FROM {{o_receipt_long}} GROUP BY Date "
            f"UNION ALL SELECT 'Grand Total' AS Date, {cells}, {whole} FROM {{o_receipt_long}}")


def _tie(metric: str, source: str, post: str = "") -> str:
    return f"""
SELECT COALESCE(m.bank, r.bank) AS bank, CAST(m.{metric} AS DOUBLE) AS left_amount, CAST(r.total AS DOUBLE) AS right_amount,
  CAST(m.{metric} - r.total AS DOUBLE) AS diff, COALESCE(abs(m.{metric} - r.total) <= 1, FALSE) AS ok
FROM (SELECT * FROM {{o_matrix}} WHERE transaction_type = '小計') m
FULL OUTER JOIN (SELECT Bank_Name AS bank, {post}(SUM({source})) AS total FROM {{o_receipt_long}} GROUP BY 1) r ON m.bank = r.bank"""


CTES = {
    **STATEMENT_CTES,
    "o_plain": f"""
SELECT report, transaction_type, SUM(CAST(amount AS {MONEY})) AS total_claimed, SUM(CAST(fee AS {MONEY})) AS total_service_fee FROM (
  SELECT report, last_value(term IGNORE NULLS) {FILL.format('report, file_no')} AS transaction_type, amount, fee
  FROM {{plain_report}} WHERE kind IS NOT NULL AND kind <> '小計') t WHERE transaction_type IS NOT NULL GROUP BY 1, 2""",
    "o_cub": """SELECT transaction_type, SUM(total_claimed) AS total_claimed, SUM(total_service_fee) AS total_service_fee
FROM {o_plain} WHERE report <> 'nccc' GROUP BY 1""",
    "o_nccc": f"""
SELECT {TERM.format('row_term')} AS transaction_type, row_term, SUM(CAST(amount AS {MONEY})) AS total_claimed,
  SUM(CAST(fee AS {MONEY})) AS total_service_fee
FROM {{plain_report}} WHERE report = 'nccc' AND row_term IS NOT NULL AND row_term NOT IN ('小計', '合計', '總計') GROUP BY 1, 2""",
    "o_sheet_rows": f"""
SELECT s.*, s.source LIKE '%分%' AS inst FROM {{sheet_report}} s
WHERE regexp_matches(s.source, '\\d{{{{4}}}}') AND EXISTS (SELECT 1 FROM {{statements}} x WHERE x.bank = 'ctbc' AND x.{PAID}
  AND x.category = CASE WHEN s.source LIKE '%分%' THEN 'installment' ELSE 'noninstallment' END
  AND strftime(x.request_date, '%m%d') = REPLACE(s.source, '分-', ''))""",
    "o_ctbc": """
SELECT transaction_type, COALESCE(SUM(amount), 0) AS total_claimed, COALESCE(SUM(fee), 0) AS total_service_fee FROM (
  SELECT t.transaction_type, r.amount, r.fee FROM (VALUES ('3期', 3), ('6期', 6), ('12期', 12), ('24期', 24)) t(transaction_type, n)
    LEFT JOIN {o_sheet_rows} r ON r.inst AND r.term = t.n
  UNION ALL SELECT '3期', amount, fee FROM {o_sheet_rows} WHERE inst AND product LIKE '%調%'
  UNION ALL SELECT t.transaction_type, r.amount, r.fee FROM (VALUES ('normal')) t(transaction_type)
    LEFT JOIN {o_sheet_rows} r ON NOT r.inst AND (r.card IS NULL OR r.card IN ('非本行國內', '帳務調整'))
  UNION ALL SELECT t.transaction_type, r.amount, r.fee FROM (VALUES ('adj')) t(transaction_type)
    LEFT JOIN {o_sheet_rows} r ON NOT r.inst AND r.card = '帳務調整') u GROUP BY 1""",
    "o_rates": """
SELECT bank, CASE WHEN regexp_matches(idx, '^[0-9]+$') AND length(idx) < 2 THEN '0' || idx ELSE idx END AS term,
  TRY_CAST(trim(rate_text) AS DECIMAL(9,6)) AS rate, rate_text FROM (
  SELECT idx, 'ub' AS bank, ub AS rate_text FROM {rate_matrix} UNION ALL SELECT idx, 'taishi', taishi FROM {rate_matrix}
  UNION ALL SELECT idx, 'taishi_voucher', taishi_voucher FROM {rate_matrix}) t
WHERE rate_text IS NOT NULL AND trim(rate_text) <> ''""",
    "o_ub": f"""
SELECT {TERM.format('r.term')} AS transaction_type, total_claimed, total_service_fee, rate AS service_fee_rate,
  round_even(CAST(total_claimed AS DECIMAL(24,4)) * rate, 2) AS calculated_service_fee
FROM (SELECT term, SUM(CAST(amount AS BIGINT)) AS total_claimed, SUM(CAST(fee AS BIGINT)) AS total_service_fee
  FROM {{rated_report}} WHERE store_name IS NOT NULL AND kind IS NOT NULL GROUP BY 1) r
LEFT JOIN (SELECT * FROM {{o_rates}} WHERE bank = 'ub') x ON x.term = r.term""",
    "o_card_rows": f"""
SELECT sheet, REPLACE(last_value(transaction_type IGNORE NULLS) {FILL.format('sheet, file_no')}, ' ', '') AS transaction_type,
  last_value(count_and_amount IGNORE NULLS) {FILL.format('sheet, file_no')} AS kind, CAST(subtotal AS BIGINT) AS amount
FROM {{card_report}} c WHERE NOT EXISTS (SELECT 1 FROM {{card_report}} m WHERE m.sheet = c.sheet AND m.file_no = c.file_no
  AND m.card = '總筆數' AND m.seq <= c.seq)""",
    "o_taishi": """
SELECT transaction_type, CAST(SUM(amount) AS DECIMAL(24,4)) AS total_claimed, COALESCE(SUM(fee), 0) AS total_service_fee FROM (
  SELECT r.transaction_type, r.amount, round_even(CAST(r.amount AS DECIMAL(24,2)) * x.rate, 2) AS fee
  FROM {o_card_rows} r LEFT JOIN {o_rates} x ON x.bank = CASE r.sheet WHEN 'voucher' THEN 'taishi_voucher' ELSE 'taishi' END
    AND x.term = r.transaction_type
  WHERE r.transaction_type NOT LIKE '%小計%' AND r.kind = '金額') t GROUP BY 1""",
    "o_cells": """
SELECT CASE WHEN transaction_type IN ('3期', '6期', '12期', '24期') THEN transaction_type ELSE 'normal' END AS transaction_type, bank,
  SUM(CAST(total_claimed AS DECIMAL(28,4))) AS total_claimed, SUM(CAST(total_service_fee AS DECIMAL(28,4))) AS total_service_fee FROM (
  SELECT transaction_type, total_claimed, total_service_fee, '聯邦' AS bank FROM {o_ub}
  UNION ALL SELECT transaction_type, total_claimed, total_service_fee, '國泰' FROM {o_cub}
  UNION ALL SELECT transaction_type, total_claimed, total_service_fee, 'NCCC' FROM {o_nccc}
  UNION ALL SELECT transaction_type, total_claimed, total_service_fee, '台新' FROM {o_taishi}
  UNION ALL SELECT transaction_type, total_claimed, total_service_fee, 'CTBC' FROM {o_ctbc} WHERE transaction_type <> 'adj') t
GROUP BY 1, 2""",
    "o_grid": """
SELECT t.transaction_type, b.bank, c.total_claimed, c.total_service_fee
FROM (VALUES ('normal'), ('3期'), ('6期'), ('12期'), ('24期')) t(transaction_type)
CROSS JOIN (VALUES ('台新'), ('NCCC'), ('國泰'), ('CTBC'), ('聯邦')) b(bank)
LEFT JOIN {o_cells} c ON c.transaction_type = t.transaction_type AND c.bank = b.bank""",
    "o_plugged": """
SELECT g.transaction_type, g.bank, CASE WHEN g.transaction_type = 'normal' AND g.bank IN ('國泰', '聯邦')
    THEN (SELECT SUM(trust_amount) FROM {o_summary} s WHERE s.bank = CASE g.bank WHEN '國泰' THEN 'cub' ELSE 'ub' END)
       - (SELECT COALESCE(SUM(x.total_claimed), 0) FROM {o_grid} x WHERE x.bank = g.bank AND x.transaction_type <> 'normal')
    ELSE g.total_claimed END AS total_claimed, g.total_service_fee FROM {o_grid} g""",
    "o_matrix": """
SELECT * FROM {o_plugged} UNION ALL
SELECT '小計', bank, SUM(total_claimed), SUM(total_service_fee) FROM {o_plugged} GROUP BY bank""",
    "o_validation": """
SELECT 'total_claimed' AS metric, m.bank, m.total_claimed AS left_amount, s.v AS right_amount FROM {o_matrix} m
JOIN (SELECT CASE bank WHEN 'taishi' THEN '台新' WHEN 'nccc' THEN 'NCCC' WHEN 'cub' THEN '國泰' WHEN 'ctbc' THEN 'CTBC' ELSE '聯邦' END AS bank,
  SUM(CASE WHEN bank = 'taishi' THEN claimed ELSE trust_amount END) AS v FROM {o_summary} GROUP BY 1) s ON s.bank = m.bank
WHERE m.transaction_type = '小計'
UNION ALL SELECT 'total_service_fee', m.bank, m.total_service_fee, s.v FROM {o_matrix} m
JOIN (SELECT CASE bank WHEN 'taishi' THEN '台新' WHEN 'nccc' THEN 'NCCC' WHEN 'cub' THEN '國泰' WHEN 'ctbc' THEN 'CTBC' ELSE '聯邦' END AS bank,
  SUM(fee_total) AS v FROM {o_summary} GROUP BY 1) s ON s.bank = m.bank WHERE m.transaction_type = '小計'""",
    "o_spine": f"SELECT CAST(g AS DATE) AS d FROM generate_series(DATE '{DAILY.beg}', DATE '{DAILY.end}', INTERVAL 1 DAY) t(g)",
    "o_receipt_long": " UNION ALL ".join(_receipt_branch(c) for c in RECEIPT_BANKS),
}


def totals_by_bank(spark, sf):
    v = lambda n: view(spark, sf, n)
    return inst.instalment_totals(v("plain_report"), v("sheet_report"), v("rated_report"), v("card_report"), v("rate_matrix"),
                                  v("statements"), P, KEYED, LISTED, "idx")


def summary_of(spark, sf):
    return bank_summary(period_measures(view(spark, sf, "statements"), P, whole_table=False))


def matrix_of(spark, sf):
    return tr.settled_matrix(totals_by_bank(spark, sf), summary_of(spark, sf))[0]


def receipt_report_of(spark, sf):
    return rc.receipt_report(view(spark, sf, "receipt_raw"), DAILY)


@register("instalment_plain", "A10 W3 P11", f"SELECT report, transaction_type, {OUT} FROM {{o_plain}}", CTES)
def instalment_plain(spark, sf):
    return inst.plain_totals(view(spark, sf, "plain_report"), KEYED, ("report",))


@register("instalment_listed", "A10 P19", f"SELECT transaction_type, {OUT} FROM {{o_nccc}}", CTES)
def instalment_listed(spark, sf):
    rows = view(spark, sf, "plain_report").where("report = 'nccc'")
    return inst.label_terms(inst.plain_totals(rows, LISTED))


@register("instalment_two_reports", "A10 J5", f"SELECT transaction_type, {OUT} FROM {{o_cub}}", CTES)
def instalment_two_reports(spark, sf):
    rows = view(spark, sf, "plain_report")
    one = lambda name: inst.plain_totals(rows.where(F.col("report") == name), KEYED)
    return add_aggregates(one("cub_individual"), one("cub_nonindividual"), ["transaction_type"], ["total_claimed", "total_service_fee"])


@register("instalment_sheets", "A11 J8 F10 P11", f"SELECT transaction_type, {OUT} FROM {{o_ctbc}}", CTES)
def instalment_sheets(spark, sf):
    return inst.sheet_totals(view(spark, sf, "sheet_report"), view(spark, sf, "statements"), P)


@register("instalment_rated", "A12 J10 F9", f"""SELECT transaction_type, CAST(total_claimed AS BIGINT) AS total_claimed,
  CAST(total_service_fee AS BIGINT) AS total_service_fee, CAST(service_fee_rate AS DOUBLE) AS service_fee_rate,
  CAST(calculated_service_fee AS DOUBLE) AS calculated_service_fee FROM {{o_ub}}""", CTES)
def instalment_rated(spark, sf):
    return inst.rated_totals(view(spark, sf, "rated_report"), inst.rate_lookup(view(spark, sf, "rate_matrix"), "idx"))


@register("instalment_cards", "A13 P12 W3 J10 J5", f"SELECT transaction_type, {OUT} FROM {{o_taishi}}", CTES)
def instalment_cards(spark, sf):
    return inst.card_totals(view(spark, sf, "card_report"), inst.rate_lookup(view(spark, sf, "rate_matrix"), "idx"))


@register("rate_matrix", "S13 S14", "SELECT bank, term, CAST(rate AS DOUBLE) AS rate, rate_text FROM {o_rates}", CTES)
def rate_matrix(spark, sf):
    return inst.rate_lookup(view(spark, sf, "rate_matrix"), "idx")


@register("ffill_keys", "W3", f"""
SELECT file_no, seq, last_value(claim_month IGNORE NULLS) {FILL.format('file_no')} AS claim_month,
  last_value(term IGNORE NULLS) {FILL.format('file_no')} AS term, last_value(store_code IGNORE NULLS) {FILL.format('file_no')} AS store_code
FROM {{plain_report}}""")
def ffill_keys(spark, sf):
    rows = view(spark, sf, "plain_report").select("file_no", "seq", "claim_month", "term", "store_code")
    return forward_fill(rows, ["claim_month", "term", "store_code"], ["file_no"], "seq")


@register("rows_before_marker", "P12", """
SELECT sheet, file_no, seq FROM {card_report} c WHERE seq < COALESCE((SELECT MIN(seq) FROM {card_report} m WHERE m.sheet = c.sheet
  AND m.file_no = c.file_no AND m.card = '總筆數'), 9223372036854775807)""")
def before_marker(spark, sf):
    rows = view(spark, sf, "card_report")
    return rows_before_marker(rows, F.col("card") == "總筆數", ["sheet", "file_no"], "seq").select("sheet", "file_no", "seq")


@register("trust_matrix", "A14 A15 O3 P19", f"SELECT transaction_type, bank, {OUT} FROM {{o_matrix}}", CTES)
def trust_matrix(spark, sf):
    return matrix_of(spark, sf)


_WIDE = ", ".join(f"CAST(COALESCE(SUM({m}) FILTER (WHERE bank = '{b}'), 0) AS DOUBLE) AS \"{b}_{m}\""
                  for m in ("total_claimed", "total_service_fee") for b in ("台新", "NCCC", "國泰", "CTBC", "聯邦"))


@register("trust_wide", "P16 O3 D2", f"SELECT transaction_type, {_WIDE} FROM {{o_matrix}} GROUP BY 1", CTES)
def trust_wide(spark, sf):
    return tr.trust_workpaper(totals_by_bank(spark, sf), summary_of(spark, sf))["trust_account_fee_wide"]


@register("matrix_from_wide", "P16", """
SELECT transaction_type, bank, metric, CAST(COALESCE(amount, 0) AS DOUBLE) AS amount FROM (
  SELECT transaction_type, bank, 'total_claimed' AS metric, total_claimed AS amount FROM {o_matrix}
  UNION ALL SELECT transaction_type, bank, 'total_service_fee', total_service_fee FROM {o_matrix}) t""", CTES)
def matrix_from_wide(spark, sf):
    return tr.matrix_from_wide(tr.trust_wide(matrix_of(spark, sf)))


@register("trust_validation", "J7 D2 Q6", """
SELECT metric, bank, CAST(left_amount AS DOUBLE) AS left_amount, CAST(right_amount AS DOUBLE) AS right_amount,
  CAST(left_amount - right_amount AS DOUBLE) AS diff, COALESCE(abs(left_amount - right_amount) <= 1, FALSE) AS ok
FROM {o_validation}""", CTES)
def trust_validation(spark, sf):
    return tr.trust_workpaper(totals_by_bank(spark, sf), summary_of(spark, sf))["trust_account_validation"]


@register("receipt_long", "P13 R1 J2 D3", """
SELECT CAST(Date AS STRING) AS Date, Bank, Bank_Name, CAST(Net_Billing AS DOUBLE) AS Net_Billing, CAST(Handling_Fee AS DOUBLE) AS Handling_Fee,
  CAST(Adjustment AS DOUBLE) AS Adjustment, CAST(Remittance_Fee AS DOUBLE) AS Remittance_Fee,
  CAST(Net_Disbursement AS DOUBLE) AS Net_Disbursement FROM {o_receipt_long}""", CTES)
def receipt_long(spark, sf):
    return receipt_report_of(spark, sf)["frr_long_format"]


@register("margin_pivot_abs", "A16 D3", _pivot("Handling_Fee", "abs"), CTES)
def margin_pivot_abs(spark, sf):
    return receipt_report_of(spark, sf)["frr_handling_fee"]


@register("margin_pivot_remittance", "A16 D3", _pivot("Remittance_Fee"), CTES)
def margin_pivot_remittance(spark, sf):
    return receipt_report_of(spark, sf)["frr_remittance_fee"]


@register("margin_pivot_billing", "A16 D3", _pivot("Net_Billing"), CTES)
def margin_pivot_billing(spark, sf):
    return receipt_report_of(spark, sf)["frr_net_billing"]


@register("margin_pivot_events", "A16", """
SELECT CASE WHEN GROUPING(d) = 1 THEN 'Grand Total' ELSE CAST(d AS STRING) END AS d,
  CAST(COALESCE(SUM(v) FILTER (WHERE e = 'click'), 0) AS DOUBLE) AS click, CAST(COALESCE(SUM(v) FILTER (WHERE e = 'error'), 0) AS DOUBLE) AS error,
  CAST(COALESCE(SUM(v) FILTER (WHERE e = 'purchase'), 0) AS DOUBLE) AS purchase, CAST(COALESCE(SUM(v) FILTER (WHERE e = 'signup'), 0) AS DOUBLE) AS signup,
  CAST(COALESCE(SUM(v) FILTER (WHERE e = 'view'), 0) AS DOUBLE) AS view, CAST(SUM(v) AS DOUBLE) AS "Grand Total"
FROM {daily} GROUP BY GROUPING SETS ((d), ())""")
def margin_pivot_events(spark, sf):
    from ledgerloom.operators.pivots import pivot_with_margins

    return pivot_with_margins(view(spark, sf, "daily"), ["d"], "e", "v", ["click", "error", "purchase", "signup", "view"])


@register("margin_long_parts", "A16", """
SELECT CASE WHEN GROUPING(r) = 1 THEN 'Grand Total' ELSE r END AS r, CASE WHEN GROUPING(c) = 1 THEN 'Grand Total' ELSE CAST(c AS STRING) END AS c, CAST(SUM(v) AS BIGINT) AS v
FROM (SELECT l_returnflag AS r, l_orderkey AS c, CAST(l_quantity AS BIGINT) AS v FROM lineitem) GROUP BY GROUPING SETS ((r, c), (r), (c), ())""")
def margin_long_parts(spark, sf):
    from ledgerloom.operators.pivots import long_margins

    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_returnflag").alias("r"), F.col("l_orderkey").alias("c"), F.col("l_quantity").cast("long").alias("v"))
    return long_margins(rows, ["r"], "c", "v")


@register("tie_out_fee", "J6", _tie("total_service_fee", "Handling_Fee", "abs"), CTES)
def tie_out_fee(spark, sf):
    return rc.daily_check(matrix_of(spark, sf), receipt_report_of(spark, sf))["validate_frr_handling_fee"]


@register("tie_out_billing", "J6", _tie("total_claimed", "Net_Billing"), CTES)
def tie_out_billing(spark, sf):
    return rc.daily_check(matrix_of(spark, sf), receipt_report_of(spark, sf))["validate_frr_net_billing"]


def _status(item: str, metric: str, source: str, post: str = "") -> str:
    body = _tie(metric, source, post)
    return (f"SELECT '{item}' AS validation_item, CASE WHEN COUNT(*) FILTER (WHERE abs(diff) > 1) > 0 THEN '有差異' ELSE '通過' END AS status, "
            f"COUNT(*) FILTER (WHERE abs(diff) > 1) AS n_off, COUNT(*) FILTER (WHERE diff IS NULL) AS n_unmatched FROM ({body}) t")


@register("daily_check_report", "Q10 Q6", _status("FRR 手續費", "total_service_fee", "Handling_Fee", "abs") + " UNION ALL "
          + _status("FRR 請款", "total_claimed", "Net_Billing"), CTES)
def daily_check_report(spark, sf):
    return rc.daily_check(matrix_of(spark, sf), receipt_report_of(spark, sf))["validation_summary"]


# A year of statements against receipts of the same statements: one bank equal, one half a unit and one seven units off, and one
# that goes by another name on each side.
YEAR = replace(PERIOD, beg=dt.date(1995, 1, 1), end=dt.date(1995, 12, 31))
_EXTRA = {"NCCC": "7", "CTBC": "0.5"}
_CODES = {"taishi": "TSPG", "nccc": "NCCC", "cub": "CUB", "ctbc": "CTBC", "ub": "UBOT"}
_YEAR_CTES = {
    "o_year": """
SELECT bank, SUM(request_amount) AS claimed, SUM(handling_fee) AS fee FROM {statements}
WHERE disbursement_date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' GROUP BY 1""",
    "o_year_ties": """
SELECT item, bank, SUM(l) AS l, SUM(r) AS r FROM (
  SELECT 'billing' AS item, CASE bank WHEN 'taishi' THEN '台新' WHEN 'nccc' THEN 'NCCC' WHEN 'cub' THEN '國泰' WHEN 'ctbc' THEN 'CTBC' ELSE 'UB' END AS bank, claimed AS l, NULL AS r FROM {o_year}
  UNION ALL SELECT 'fee', CASE bank WHEN 'taishi' THEN '台新' WHEN 'nccc' THEN 'NCCC' WHEN 'cub' THEN '國泰' WHEN 'ctbc' THEN 'CTBC' ELSE 'UB' END, fee, NULL FROM {o_year}
  UNION ALL SELECT 'billing', CASE bank WHEN 'taishi' THEN '台新' WHEN 'nccc' THEN 'NCCC' WHEN 'cub' THEN '國泰' WHEN 'ctbc' THEN 'CTBC' ELSE '聯邦' END, NULL,
    claimed + CASE bank WHEN 'nccc' THEN 7 WHEN 'ctbc' THEN 0.5 ELSE 0 END FROM {o_year}
  UNION ALL SELECT 'fee', CASE bank WHEN 'taishi' THEN '台新' WHEN 'nccc' THEN 'NCCC' WHEN 'cub' THEN '國泰' WHEN 'ctbc' THEN 'CTBC' ELSE '聯邦' END, NULL, fee FROM {o_year}) t GROUP BY 1, 2""",
}


def _year_check(spark, sf):
    paid = view(spark, sf, "statements").where(F.col("disbursement_date").between(F.lit(YEAR.beg), F.lit(YEAR.end)))
    left = recode(F.col("bank"), {b: "UB" if b == "ub" else RECEIPT_BANKS[c] for b, c in _CODES.items()})
    matrix = paid.groupBy(F.lit(SUBTOTAL).alias("transaction_type"), left.alias("bank")).agg(
        F.sum("request_amount").alias("total_claimed"), F.sum("handling_fee").alias("total_service_fee"))
    long = paid.select(F.col("disbursement_date").alias("Date"), recode(F.col("bank"), _CODES).alias("Bank"),
                       F.col("request_amount").cast(rc.AMOUNT).alias("Net_Billing"), F.col("handling_fee").cast(rc.AMOUNT).alias("Handling_Fee"))
    extra = literal_table(spark, [(YEAR.end, c, Decimal(v), Decimal(0)) for c, v in _EXTRA.items()], f"Date date, Bank string, Net_Billing {rc.AMOUNT}, Handling_Fee {rc.AMOUNT}")
    long = long.unionByName(extra)
    pivots = {"frr_handling_fee": rc.receipt_pivot(long, "Handling_Fee", YEAR, absolute=True), "frr_net_billing": rc.receipt_pivot(long, "Net_Billing", YEAR)}
    return rc.daily_check(matrix, pivots)


@register("tie_out_mixed", "J6", """
SELECT bank, CAST(l AS DOUBLE) AS left_amount, CAST(r AS DOUBLE) AS right_amount, CAST(l - r AS DOUBLE) AS diff, COALESCE(abs(l - r) <= 1, FALSE) AS ok
FROM {o_year_ties} WHERE item = 'billing'""", _YEAR_CTES)
def tie_out_mixed(spark, sf):
    """Equal banks, one within the tolerance, one beyond it, and one missing on each side."""
    return _year_check(spark, sf)["validate_frr_net_billing"]


@register("daily_check_mixed", "Q10 Q6", """
SELECT CASE item WHEN 'fee' THEN 'FRR 手續費' ELSE 'FRR 請款' END AS validation_item, CASE WHEN COUNT(*) FILTER (WHERE abs(l - r) > 1) > 0 THEN '有差異' ELSE '通過' END AS status,
  COUNT(*) FILTER (WHERE abs(l - r) > 1) AS n_off, COUNT(*) FILTER (WHERE l - r IS NULL) AS n_unmatched FROM {o_year_ties} GROUP BY item""", _YEAR_CTES)
def daily_check_mixed(spark, sf):
    """One check passes and one does not."""
    return _year_check(spark, sf)["validation_summary"]


@register("tie_out_summary", "A25", """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE l = r) AS n_equal, COUNT(*) FILTER (WHERE l <> r OR l IS NULL OR r IS NULL) AS n_different,
  CAST(MAX(abs(l - r)) AS DOUBLE) AS max_abs_diff, round(CAST(SUM(abs(l - r)) AS DOUBLE) / COUNT(l - r), 4) AS mean_abs_diff FROM {o_year_ties} WHERE item = 'billing'""", _YEAR_CTES)
def tie_out_summary(spark, sf):
    out = difference_summary(_year_check(spark, sf)["validate_frr_net_billing"], "diff")
    return out.withColumn("mean_abs_diff", F.round(F.col("mean_abs_diff").cast("double"), 4))
