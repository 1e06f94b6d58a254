"""Queries: statement rules, bank summary, invoices."""

from __future__ import annotations

from ledgerloom.operators.joins import union_of_parts
from ledgerloom.operators.rowwise import last_record
from ledgerloom.plans import escrow, statements as st
from ledgerloom.registry.core import register
from ledgerloom.registry.views import PERIOD as P
from ledgerloom.registry.views import VIEWS
from ledgerloom.registry.views import view
from pyspark.sql import functions as F

B, E = f"DATE '{P.beg}'", f"DATE '{P.end}'"
LB, LE = f"DATE '{P.last_beg}'", f"DATE '{P.last_end}'"
PAID = f"disbursement_date BETWEEN {B} AND {E}"
ASKED = f"request_date BETWEEN {B} AND {E}"
PAID_LAST = f"disbursement_date BETWEEN {LB} AND {LE}"
ASKED_LAST = f"request_date BETWEEN {LB} AND {LE}"
PAID_M = "strftime(disbursement_date, '%Y%m') = '199810'"
ASKED_M = "strftime(request_date, '%Y%m') = '199810'"


def total(col: str, cond: str) -> str:
    return f"COALESCE(CAST(trunc(SUM({col}) FILTER (WHERE {cond})) AS BIGINT), 0)"


def _bank(bank: str, load: str, **m: str) -> str:
    names = ["claimed", "returned", "carry_in", "adjustment", "trust_amount", "fee", "prior_fee", "fee_adjustment",
             "tax_adjustment", "invoice_claimed", "invoice_fee"]
    cols = ", ".join(f"CAST({m.get(n, '0')} AS BIGINT) AS {n}" for n in names)
    return (f"SELECT bank, category, COUNT(*) AS n_rows, {cols} FROM {{statements}} "
            f"WHERE bank = '{bank}' AND {load} GROUP BY bank, category")


UNPAID_LAST = f"{ASKED_LAST} AND NOT COALESCE({PAID_LAST}, FALSE)"
SETTLED = f"{PAID_M} AND {ASKED_M}"
_cub_ret = f"abs({total('return_amount', PAID)})"
_cub_net = f"{total('request_amount', PAID)} - {_cub_ret}"
_tai_adj = total("invoice_amount", f"{PAID} AND disbursement_amount = 0")
_tai_fee = f"{total('invoice_amount', PAID)} - {_tai_adj}"

CTES = {
    "o_measures": " UNION ALL ".join([
        _bank("cub", "disbursement_date IS NOT NULL", claimed=total("request_amount", PAID), returned=_cub_ret,
              trust_amount=_cub_net, fee=total("handling_fee", PAID), invoice_claimed=_cub_net,
              invoice_fee=total("handling_fee", PAID)),
        _bank("ctbc", "TRUE", claimed=total("request_amount", SETTLED), carry_in=total("request_amount", UNPAID_LAST),
              adjustment=total("adjustment_amount", SETTLED),
              trust_amount=f"{total('request_amount', SETTLED)} + {total('request_amount', UNPAID_LAST)} + {total('adjustment_amount', SETTLED)}",
              fee=f"{total('handling_fee', SETTLED)} + {total('adjustment_handling_fee', SETTLED)}",
              prior_fee=total("handling_fee", UNPAID_LAST), invoice_claimed=total("request_amount", ASKED_M),
              invoice_fee=total("invoice_amount", ASKED_M)),
        _bank("nccc", "disbursement_date IS NOT NULL", claimed=total("request_amount", PAID),
              carry_in=total("request_amount", f"{PAID} AND NOT COALESCE({ASKED}, FALSE)"),
              trust_amount=total("request_amount", PAID), fee=total("handling_fee", PAID),
              prior_fee=total("handling_fee", f"{ASKED_LAST} AND {PAID}"),
              invoice_claimed=total("request_amount", ASKED), invoice_fee=total("handling_fee", ASKED)),
        _bank("ub", "disbursement_date IS NOT NULL AND request_date IS NOT NULL",
              claimed=total("request_amount", f"{PAID} AND {ASKED} AND store_name LIKE '%行卡%'"),
              carry_in=total("request_amount", f"{PAID} AND {ASKED_LAST}"),
              trust_amount=total("request_amount", f"{PAID_M} AND store_name IN ('他行卡', '自行卡', '自行卡分期內含')"),
              fee=total("handling_fee", f"{PAID} AND store_name = '主公司'"),
              prior_fee=total("handling_fee", f"{PAID} AND {ASKED_LAST}"),
              fee_adjustment=total("handling_fee", f"{ASKED} AND store_name = '調整 -- 退貨'"),
              invoice_claimed="trunc(arg_max(request_amount, seq))"),
        _bank("taishi", "disbursement_date IS NOT NULL", claimed=total("request_amount", PAID),
              trust_amount=total("disbursement_amount", PAID), fee=_tai_fee, fee_adjustment=_tai_adj,
              tax_adjustment=total("tax_amount", f"{PAID} AND disbursement_amount = 0"), invoice_claimed=_tai_fee,
              invoice_fee="NULL"),
    ]),
    "o_summary": """
SELECT CASE WHEN bank IN ('nccc', 'taishi') THEN bank ELSE bank || '_' || category END AS name, bank, claimed, trust_amount,
  CASE WHEN bank = 'ub' THEN fee - prior_fee ELSE fee END AS fee_current,
  CASE WHEN bank = 'ctbc' THEN adjustment ELSE fee_adjustment END AS adjustment,
  CASE WHEN bank = 'cub' THEN returned END AS returned,
  CASE WHEN bank IN ('ctbc', 'nccc', 'ub') THEN carry_in END AS carry_in,
  CASE WHEN bank <> 'taishi' THEN prior_fee END AS prior_fee,
  CASE bank WHEN 'cub' THEN fee + prior_fee WHEN 'ctbc' THEN fee + prior_fee WHEN 'ub' THEN fee - fee_adjustment ELSE fee END AS fee_total,
  CASE WHEN bank = 'taishi' THEN tax_adjustment END AS tax_adjustment,
  CASE WHEN bank IN ('cub', 'ctbc', 'nccc') THEN invoice_claimed END AS invoice_claimed,
  CASE WHEN bank IN ('cub', 'ctbc', 'nccc') THEN invoice_fee END AS invoice_fee
FROM {o_measures}""",
    "o_invoice_summary": f"""
SELECT category, COALESCE(invoice_description LIKE '%手續費%', FALSE) AS is_handling_fee,
  SUM(amount_excl_tax) AS total_amount_excl_tax, SUM(tax_amount) AS total_tax_amount, SUM(amount_incl_tax) AS total_amount_incl_tax
FROM {{invoices}} WHERE strptime(REPLACE(invoice_date, '-', ''), '%Y%m%d')::DATE BETWEEN {B} AND {E} GROUP BY 1, 2""",
    "o_escrow": """
SELECT s.*, i.total_tax_amount, i.total_amount_incl_tax
FROM {o_summary} s LEFT JOIN {o_invoice_summary} i ON s.name = i.category AND i.is_handling_fee""",
}

MEASURE_COLS = ("claimed, returned, carry_in, adjustment, trust_amount, fee, prior_fee, fee_adjustment, tax_adjustment, "
                "invoice_claimed, invoice_fee")


@register("recon_period_measures", "A1 A2 A3 A4 A6 D17 S10 P9 P10 P11 F9 W5",
          f"SELECT bank, category, n_rows, {MEASURE_COLS} FROM {{o_measures}}", CTES, {"invoice_fee": "DOUBLE"})
def recon_period_measures(spark, sf):
    return st.period_measures(view(spark, sf, "statements"), P)


# Asked for three days before payment: adjustments and refunds then fall into the month that is settled.
_ASKED = "CASE WHEN l_quantity = 49 THEN NULL ELSE CAST(l_shipdate AS DATE) - (l_linenumber * 7) END AS request_date"
_PROMPT = VIEWS["statements"].replace(_ASKED, "CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_shipdate AS DATE) - 3 END AS request_date")


@register("recon_prompt_measures", "A1 A2 A3 A4", f"SELECT bank, category, n_rows, {MEASURE_COLS} FROM {{o_measures}}",
          {**CTES, "statements": _PROMPT}, {"invoice_fee": "DOUBLE"})
def recon_prompt_measures(spark, sf):
    prompt = view(spark, sf, "statements").withColumn("request_date", F.date_sub("disbursement_date", 3))
    return st.period_measures(prompt, P)


SUMMARY_GAPS = dict.fromkeys(["returned", "carry_in", "prior_fee", "tax_adjustment", "invoice_claimed", "invoice_fee"], "DOUBLE")


@register("recon_bank_summary", "A7 O3", "SELECT * FROM {o_summary}", CTES, SUMMARY_GAPS)
def recon_bank_summary(spark, sf):
    return st.ordered_summary(st.bank_summary(st.period_measures(view(spark, sf, "statements"), P, whole_table=False)))


@register("store_subtotals", "A5", f"""
SELECT category, store_name, CAST(SUM(request_amount) AS DOUBLE) AS total_claimed, CAST(SUM(handling_fee) AS DOUBLE) AS total_service_fee,
  CAST(SUM(local_handling_fee) AS DOUBLE) AS total_local_service_fee, CAST(SUM(disbursement_amount) AS DOUBLE) AS total_paid
FROM {{statements}} WHERE bank = 'ub' AND request_date IS NOT NULL AND {PAID_M} AND store_name IN ('他行卡', '自行卡', '自行卡分期內含')
GROUP BY 1, 2""")
def store_subtotals(spark, sf):
    return st.store_subtotals(view(spark, sf, "statements"), P)


@register("container_checks", "A8", """
SELECT bank, category, n_rows, n_rows > 0 AS has_rows, claimed < 0 AS negative_claimed, fee < 0 AS negative_fee,
  fee + prior_fee - abs(CASE WHEN bank = 'ctbc' THEN adjustment ELSE fee_adjustment END) AS total_service_fee,
  CASE WHEN bank = 'ub' THEN claimed + carry_in - trust_amount END AS store_diff FROM {o_measures}""", CTES, {"store_diff": "DOUBLE"})
def container_checks(spark, sf):
    return st.container_checks(st.period_measures(view(spark, sf, "statements"), P))


@register("last_record", "W5", """
SELECT o_orderstatus, CAST(CAST(arg_max(o_totalprice, o_orderkey) AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice
FROM {orders} GROUP BY 1""")
def last_record_of_status(spark, sf):
    return last_record(view(spark, sf, "orders"), "o_totalprice", "o_orderkey", ["o_orderstatus"])


@register("statement_union", "S12 U1", """
SELECT bank || '_' || category AS source, COUNT(*) AS n_rows, CAST(SUM(request_amount) AS DOUBLE) AS request_amount,
  COUNT(store_name) AS n_stores FROM (SELECT bank, category, request_amount, CASE WHEN bank = 'ub' THEN store_name END AS store_name
  FROM {statements}) t GROUP BY 1""")
def statement_union(spark, sf):
    """All statement tables under one another, from one scan: the table's name is an expression, and store names exist in the ub tables only."""
    ub = F.col("bank") == "ub"
    rows = union_of_parts(view(spark, sf, "statements"), ["bank", "category"], {"store_name": ub}).select("source", "request_amount", "store_name")
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("request_amount").alias("request_amount"),
        F.count("store_name").alias("n_stores"))


@register("invoice_summary", "A9 F11", """
SELECT category, is_handling_fee, CAST(total_amount_excl_tax AS DOUBLE) AS total_amount_excl_tax,
  CAST(total_tax_amount AS DOUBLE) AS total_tax_amount, CAST(total_amount_incl_tax AS DOUBLE) AS total_amount_incl_tax
FROM {o_invoice_summary}""", CTES)
def invoice_summary(spark, sf):
    return escrow.invoice_summary(view(spark, sf, "invoices"), P)


@register("invoice_check", "A9 J4 F12", """
SELECT name, CAST(CASE WHEN bank = 'ub' THEN total_amount_incl_tax ELSE invoice_fee END AS DOUBLE) AS invoice_fee,
  CAST(total_amount_incl_tax AS DOUBLE) AS total_amount_incl_tax,
  CAST(CASE WHEN bank = 'ub' THEN total_amount_incl_tax - total_amount_incl_tax WHEN bank = 'taishi' THEN fee_current - total_amount_incl_tax
       ELSE invoice_fee - total_amount_incl_tax END AS DOUBLE) AS invoice_diff
FROM {o_escrow}""", CTES)
def invoice_check(spark, sf):
    out = escrow.escrow_summary(view(spark, sf, "statements"), view(spark, sf, "invoices"), P)
    return out.select("name", "invoice_fee", "total_amount_incl_tax", "invoice_diff")


@register("escrow_summary", "D1 F10", """
SELECT name, split_part(name, '_', 1) AS bank, claimed, trust_amount, fee_current, adjustment, returned, carry_in, prior_fee, fee_total,
  tax_adjustment, invoice_claimed, CAST(CASE WHEN bank = 'ub' THEN total_amount_incl_tax ELSE invoice_fee END AS DOUBLE) AS invoice_fee,
  CAST(total_tax_amount AS DOUBLE) AS total_tax_amount, CAST(total_amount_incl_tax AS DOUBLE) AS total_amount_incl_tax,
  CAST(CASE WHEN bank = 'ub' THEN total_amount_incl_tax - total_amount_incl_tax WHEN bank = 'taishi' THEN fee_current - total_amount_incl_tax
       ELSE invoice_fee - total_amount_incl_tax END AS DOUBLE) AS invoice_diff
FROM {o_escrow}""", CTES, SUMMARY_GAPS)
def escrow_summary(spark, sf):
    return escrow.escrow_summary(view(spark, sf, "statements"), view(spark, sf, "invoices"), P)
