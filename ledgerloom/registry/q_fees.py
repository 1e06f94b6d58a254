"""Queries: commission, acquiring fees, payment report, fee histories."""

from __future__ import annotations

from ledgerloom.plans import fees as fe
from ledgerloom.plans.receipts import receipt_report
from ledgerloom.plans.trust import trust_wide, trust_workpaper
from ledgerloom.reference_data import MATRIX_BANKS
from ledgerloom.registry.core import register
from ledgerloom.registry.q_trust import CTES as TRUST_CTES
from ledgerloom.registry.q_trust import _tie, matrix_of, summary_of, totals_by_bank
from ledgerloom.registry.views import DAILY, PERIOD as P
from ledgerloom.registry.views import view
from ledgerloom.session import settle

END = P.end.isoformat()

CTES = {
    **TRUST_CTES,
    "o_adjusted": """
SELECT transaction_type, bank,
  COALESCE(total_claimed, 0) + CASE WHEN bank = '國泰' AND transaction_type IN ('normal', '小計') THEN -611
    WHEN bank = 'NCCC' AND transaction_type IN ('3期', '小計') THEN 250 ELSE 0 END AS total_claimed,
  COALESCE(total_service_fee, 0) AS total_service_fee FROM {o_matrix}""",
    "o_rounded": """
SELECT transaction_type, bank, total_claimed, total_service_fee + CASE WHEN bank = '台新' AND transaction_type IN ('normal', '小計') THEN 5 ELSE 0 END
  AS total_service_fee FROM {o_adjusted}""",
    "o_term_sums": """
SELECT transaction_type, CAST(SUM(total_claimed) AS DECIMAL(28,4)) AS subtotal,
  CASE transaction_type WHEN 'normal' THEN 0.0185 WHEN '3期' THEN 0.0185 WHEN '6期' THEN 0.018 WHEN '12期' THEN 0.017
    WHEN '24期' THEN 0.015 ELSE 0.0185 END AS charge_rate FROM {o_adjusted} GROUP BY 1""",
    "o_commission": """
SELECT transaction_type, subtotal, charge_rate, CASE WHEN transaction_type = '小計'
    THEN (SELECT SUM(round_even(subtotal * charge_rate, 0)) FROM {o_term_sums} WHERE transaction_type <> '小計')
    ELSE round_even(subtotal * charge_rate, 0) END AS commission_fee FROM {o_term_sums}""",
    "o_plug": """
SELECT r.transaction_type, r.bank, r.total_claimed, CASE
    WHEN r.bank IN ('國泰', '聯邦') AND r.transaction_type = '小計' THEN (SELECT MAX(right_amount) FROM {o_validation} v WHERE v.bank = r.bank AND v.metric = 'total_service_fee')
    WHEN r.bank IN ('國泰', '聯邦') AND r.transaction_type = 'normal' THEN (SELECT MAX(right_amount) FROM {o_validation} v WHERE v.bank = r.bank AND v.metric = 'total_service_fee')
      - (SELECT SUM(total_service_fee) FROM {o_rounded} x WHERE x.bank = r.bank AND x.transaction_type NOT IN ('normal', '小計'))
    ELSE r.total_service_fee END AS total_service_fee FROM {o_rounded} r""",
    "o_long": f"""
SELECT transaction_type, bank, 'claimed' AS amt_type, total_claimed AS amount, '{END}' AS period FROM {{o_plug}}
UNION ALL SELECT transaction_type, bank, 'acquiring', total_service_fee, '{END}' FROM {{o_plug}}""",
    "o_charge": """
SELECT bank, round_even(CAST(MAX(total_service_fee) AS DOUBLE) / NULLIF(CAST(MAX(total_claimed) AS DOUBLE), 0), 4) AS charge_rate
FROM {o_plug} WHERE transaction_type = 'normal' GROUP BY 1""",
    "o_report": "SELECT transaction_type AS k, " + ", ".join(
        f"CAST(SUM(total_claimed) FILTER (WHERE bank = '{b}') AS DOUBLE) AS c{i}, CAST(SUM(total_service_fee) FILTER (WHERE bank = '{b}') AS DOUBLE) AS a{i}"
        for i, b in enumerate(MATRIX_BANKS)) + " FROM {o_plug} WHERE transaction_type <> '小計' GROUP BY 1",
    "o_report_sub": "SELECT '小計' AS k, " + ", ".join(
        f"CAST(SUM(total_claimed) FILTER (WHERE bank = '{b}') AS DOUBLE) AS c{i}, CAST(SUM(total_service_fee) FILTER (WHERE bank = '{b}') AS DOUBLE) AS a{i}"
        for i, b in enumerate(MATRIX_BANKS)) + " FROM {o_plug} WHERE transaction_type <> '小計'",
}

_N = range(5)
_C = " + ".join(f"c{i}" for i in _N)
_A = " + ".join(f"a{i}" for i in _N)
_SHOW = ["TSB", "NCCC", "Cathay", "CTBC", "UBOT"]


def _line(label: str, c, a, rebate: str, t: str, f: str, r: str, source: str) -> str:
    cells = ", ".join(f"{c(i)} AS \"{n}\", {a(i)} AS \"{n} Acquiring fee\"" for i, n in enumerate(_SHOW))
    return (f"SELECT {label} AS transaction_type, {cells}, {rebate} AS \"Rebate from Cathay\", {t} AS \"Total Transaction\", "
            f"{f} AS \"Total Acquiring Fee\", {r} AS rate_charge FROM {source}")


_LABEL = ("CASE k WHEN 'normal' THEN 'Non-installment-Payment' WHEN '3期' THEN 'Installment-Payment-3M' WHEN '6期' THEN 'Installment-Payment-6M' "
          "WHEN '12期' THEN 'Installment-Payment-12M' WHEN '24期' THEN 'Installment-Payment-24M' ELSE k END")
_NULL = "CAST(NULL AS DOUBLE)"
REPORT_SQL = " UNION ALL ".join([
    *[_line(_LABEL, lambda i: f"c{i}", lambda i: f"a{i}", "CAST(0 AS DOUBLE)", f"({_C})", f"({_A})", f"({_A}) / NULLIF({_C}, 0)", s)
      for s in ("{o_report}", "{o_report_sub}")],
    _line("'OCP'", lambda i: _NULL, lambda i: f"(SELECT charge_rate FROM {{o_charge}} WHERE bank = '{MATRIX_BANKS[i]}')", _NULL, _NULL,
          f"({_A}) / NULLIF({_C}, 0)", _NULL, "{o_report_sub}"),
    _line("'Percentage'", lambda i: f"c{i} / NULLIF({_C}, 0)", lambda i: _NULL, _NULL, _NULL, _NULL, _NULL, "{o_report_sub}"),
])


def adjusted_of(spark, sf):
    return fe.apply_claimed_adjustments(fe.zero_filled(matrix_of(spark, sf)), P.claimed_adjustments)


def workpaper_of(spark, sf):
    return trust_workpaper(totals_by_bank(spark, sf), summary_of(spark, sf))


def plug_of(spark, sf):
    wp = workpaper_of(spark, sf)
    adjusted = fe.apply_claimed_adjustments(fe.zero_filled(wp["trust_account_fee"]), P.claimed_adjustments)
    return fe.plug_summary(fe.apply_fee_rounding(adjusted, P.fee_rounding), wp["trust_account_validation"])


def pipeline_of(spark, sf):
    wp = workpaper_of(spark, sf)
    receipts = receipt_report(view(spark, sf, "receipt_raw"), DAILY)
    return fe.fee_pipeline(wp["trust_account_fee"], wp["trust_account_validation"], receipts["frr_net_billing"],
                           view(spark, sf, "fee_history"), view(spark, sf, "commission_history"), P)


_BANK_CELLS = ", ".join(f"CAST(SUM(a.total_claimed) FILTER (WHERE a.bank = '{b}') AS DOUBLE) AS \"{b}_total_claimed\"" for b in MATRIX_BANKS)


@register("commission_by_term", "D6 D7 P17 D10 A18", f"""
SELECT c.transaction_type, {_BANK_CELLS}, CAST(MAX(c.subtotal) AS DOUBLE) AS subtotal, CAST(MAX(c.charge_rate) AS DOUBLE) AS charge_rate,
  CAST(MAX(c.commission_fee) AS DOUBLE) AS commission_fee,
  CAST(MAX(round_even(CAST(c.commission_fee AS DECIMAL(28,2)) * 1.05, 0)) AS DOUBLE) AS spe_charge_with_tax
FROM {{o_commission}} c JOIN {{o_adjusted}} a ON a.transaction_type = c.transaction_type GROUP BY 1""", CTES)
def commission_by_term(spark, sf):
    return fe.commission_by_term(adjusted_of(spark, sf), P)


@register("commission_legacy_subtotal", "D6", """
SELECT transaction_type, CAST(CASE WHEN transaction_type = '小計' THEN (SELECT SUM(round_even(subtotal * charge_rate, 0)) FROM {o_term_sums})
  ELSE commission_fee END AS DOUBLE) AS commission_fee FROM {o_commission}""", CTES)
def commission_legacy_subtotal(spark, sf):
    out = fe.commission_by_term(adjusted_of(spark, sf), P, count_subtotal_twice=True)
    return out.select("transaction_type", "commission_fee")


@register("fee_rounding", "P18", """SELECT transaction_type, bank, CAST(total_claimed AS DOUBLE) AS total_claimed,
  CAST(total_service_fee AS DOUBLE) AS total_service_fee FROM {o_rounded}""", CTES)
def fee_rounding(spark, sf):
    return fe.apply_fee_rounding(adjusted_of(spark, sf), P.fee_rounding)


@register("plug_summary", "W7", """SELECT transaction_type, bank, CAST(total_claimed AS DOUBLE) AS total_claimed,
  CAST(total_service_fee AS DOUBLE) AS total_service_fee FROM {o_plug}""", CTES)
def plug_summary(spark, sf):
    return plug_of(spark, sf)


@register("summary_long", "R2 R5 F10", """
SELECT l.transaction_type, CAST(l.amount AS DOUBLE) AS amount, l.bank, l.amt_type, l.period,
  CASE WHEN l.transaction_type = 'normal' AND l.amt_type = 'acquiring' THEN c.charge_rate END AS charge_rate
FROM {o_long} l LEFT JOIN {o_charge} c ON c.bank = l.bank""", CTES)
def summary_long(spark, sf):
    return fe.with_charge_rate(fe.summary_long(trust_wide(plug_of(spark, sf)), END))


@register("payment_report", "R4", REPORT_SQL, CTES)
def payment_report(spark, sf):
    summary = settle(plug_of(spark, sf), "apcc_summary")
    return fe.payment_report(fe.with_charge_rate(fe.summary_long(trust_wide(summary), END)), END)


@register("commission_vs_receipts", "J6 D10", _tie("total_claimed", "Net_Billing").replace("{o_matrix}", "{o_adjusted}"), CTES)
def commission_vs_receipts(spark, sf):
    return pipeline_of(spark, sf)["apcc_validate_frr"]


@register("net_card_revenue", "D8 J11", """
SELECT f.period, CAST(round_even(CAST(c.commission_fee AS DECIMAL(28,4)) * 1.05, 0) - f.amount - 150000 AS DOUBLE) AS cc_net_revenue
FROM (SELECT substr(period, 1, 7) AS period, SUM(amount) AS amount FROM {fee_history} WHERE amt_type = 'acquiring' AND transaction_type = '小計' GROUP BY 1) f
JOIN (SELECT substr(end_date, 1, 7) AS period, commission_fee FROM {commission_history} WHERE transaction_type = '小計') c ON c.period = f.period""")
def net_card_revenue(spark, sf):
    return fe.net_card_revenue(view(spark, sf, "fee_history"), view(spark, sf, "commission_history"), P)


@register("fee_share", "W6", """
SELECT h.transaction_type, CAST(h.commission_fee AS DOUBLE) AS commission_fee,
  CAST(round_even(CAST(h.commission_fee AS DECIMAL(28,4)) * 1.05, 0) AS DOUBLE) AS commission_fee_inc_tax, CAST(h.charge_rate AS DOUBLE) AS charge_rate,
  h.end_date, CASE WHEN s.end_date IS NULL THEN CAST(0 AS DOUBLE)
    ELSE round_even(CAST(h.commission_fee AS DOUBLE) / NULLIF(CAST(s.commission_fee AS DOUBLE), 0), 4) END AS percentage
FROM {commission_history} h LEFT JOIN (SELECT * FROM {commission_history} WHERE transaction_type = '小計') s ON s.end_date = h.end_date""")
def fee_share(spark, sf):
    return fe.commission_share(view(spark, sf, "commission_history"), P)


@register("fee_ratio", "D9 O2 R1", """
SELECT s.transaction_type, x.amt_type, CAST(CASE x.amt_type WHEN 'claimed' THEN s.claimed ELSE s.acquiring END AS DOUBLE) AS amount, s.period,
  CASE WHEN s.claimed = 0 THEN CAST(0 AS DOUBLE) ELSE round_even(CAST(s.acquiring AS DOUBLE) / CAST(s.claimed AS DOUBLE), 4) END AS percentage
FROM (SELECT period, transaction_type, COALESCE(SUM(amount) FILTER (WHERE amt_type = 'claimed'), 0) AS claimed,
  COALESCE(SUM(amount) FILTER (WHERE amt_type = 'acquiring'), 0) AS acquiring FROM {fee_history} GROUP BY 1, 2) s
CROSS JOIN (VALUES ('claimed'), ('acquiring')) x(amt_type)""")
def fee_ratio(spark, sf):
    return fe.fee_ratio(view(spark, sf, "fee_history"))
