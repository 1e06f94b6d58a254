"""Queries: bank balances, running balances, journal and its checks."""

from __future__ import annotations

from ledgerloom.operators.joins import fill_spine, literal_amounts, sparse_to_spine
from ledgerloom.operators.rowwise import running_total
from ledgerloom.plans import balances as ba
from ledgerloom.plans import journal as jo
from ledgerloom.plans.receipts import receipt_report
from ledgerloom.reference_data import ACCOUNTS, ENTRY_MAPPING, MOVEMENT_TYPES, TYPE_LABELS
from ledgerloom.registry.core import register
from ledgerloom.registry.q_trust import CTES as TRUST_CTES
from ledgerloom.registry.views import DAILY as P
from ledgerloom.registry.views import view
from pyspark.sql import functions as F

LAYOUT = ba.BalanceLayout(
    inbound=("bt", "collection_shop"), inbound_extra=("offline_transfer", "adj_transfer"), ach=("ach_a", "ach_b"),
    outbound=("out_a", "out_b", "out_tax", "out_missing"),
    expected_inbound=("bt", "cc_a", "cc_b", "collection_shop", "offline_transfer"),
    expected_outbound=("out_a", "out_b", "spl"),
)
B, E = f"DATE '{P.beg}'", f"DATE '{P.end}'"
FEE, REM = "abs(SUM(Handling_Fee))", "SUM(Remittance_Fee)"


def nz(*cols: str) -> str:
    return "(" + " + ".join(f"COALESCE({c}, 0)" for c in cols) + ")"


def _q(text) -> str:
    return "NULL" if text is None else f"'{text}'"


_MAP = ", ".join(f"({_q(c)}, {_q(a)}, {_q(t)}, {_q(k)})" for c, a, t, k in ENTRY_MAPPING)
_ACC = ", ".join(f"({_q(a)}, {_q(k)}, {_q(d)})" for a, k, d in ACCOUNTS)
_COLS = [m[0] for m in ENTRY_MAPPING]

CTES = {
    **TRUST_CTES,
    "o_daily": f"""
SELECT Date AS d, {nz('bt', 'cc_a', 'cc_b', 'collection_shop', 'offline_transfer', 'adj_transfer')} AS inbound, {nz('ach_a', 'ach_b')} AS ach,
  {nz('out_a', 'out_b', 'out_tax')} AS outbound, {nz('spl')} AS spl, {nz('interest')} AS interest, {nz('interbank')} AS interbank,
  {nz('offline_transfer')} AS offline_transfer, {nz('service_fee')} AS service_fee, {nz('balance_1')} AS balance
FROM {{balance_raw}} WHERE Date BETWEEN {B} AND {E}""",
    "o_fees": f"SELECT Date AS d, {FEE} AS fee, {REM} AS rem FROM {{o_receipt_long}} GROUP BY 1",
    "o_wp": """
SELECT o.d, f.rem, f.fee, o.inbound + o.service_fee + o.spl AS inbound, o.ach, o.outbound, o.interest
FROM {o_daily} o LEFT JOIN {o_fees} f ON f.d = o.d""",
    "o_rebate": "SELECT received_date AS d, arg_max(received_amount, seq) AS reb FROM {rebates} GROUP BY 1",
    "o_series": """
SELECT s.d, COALESCE(w.rem, 0) AS rem, COALESCE(w.fee, 0) AS fee, COALESCE(w.inbound, 0) AS inb, COALESCE(w.ach, 0) AS ach,
  COALESCE(w.outbound, 0) AS outb, CAST(COALESCE(w.interest, 0) AS DECIMAL(24,2)) AS i, COALESCE(r.reb, 0) AS reb,
  CASE s.d WHEN DATE '2024-01-09' THEN 1814.25 WHEN DATE '2024-01-28' THEN 952.75 ELSE 0 END AS spt
FROM {o_spine} s LEFT JOIN {o_wp} w ON w.d = s.d LEFT JOIN {o_rebate} r ON r.d = s.d""",
    "o_wide": """
SELECT d AS Date, -spt AS "acc_101150_Received_CTBC_SPT", rem AS "acc_104171_內扣CTBCCC匯費", inb - rem - reb AS "acc_104171_ReceivedCTBCSPT",
  ach AS "acc_104171_ReceivedCTBCSPT退匯", outb + i * 0.1 AS "acc_104171_OutCTBCSPT", reb AS "acc_104171_others", -reb AS "acc_999995_others",
  -rem AS "acc_530006_內扣CTBCCC匯費", fee AS "acc_530006_收單_SPE", -ach AS "acc_200701_ReceivedCTBCSPT退匯", -outb - i * 0.1 AS "acc_200701_OutCTBCSPT",
  -i AS "acc_440001_interest", i * 0.9 AS "acc_104171_others_利息", i * 0.1 AS "acc_111302_interest",
  fee + inb - rem - reb - spt AS "acc_200208_ReceivedCTBCSPT_positive", -(fee + inb - rem - reb - spt) AS "acc_200208_ReceivedCTBCSPT_negative",
  -(fee + inb - rem - reb - spt) AS "acc_200701_ReceivedCTBCSPT_negative" FROM {o_series}""",
    "o_accounts": f"SELECT * FROM (VALUES {_ACC}) t(account_no, desc_key, account_desc)",
    "o_lines": " UNION ALL ".join(
        f"SELECT Date AS d, {_q(a)} AS account_no, {_q(t)} AS transaction_type, {_q(k)} AS desc_key, CAST(\"{c}\" AS DECIMAL(28,4)) AS amount FROM {{o_wide}}"
        for c, a, t, k in ENTRY_MAPPING),
    "o_allowance": f"""SELECT vat, -gross AS neg_gross FROM {{fee_documents}} WHERE regexp_matches(doc_no, '{P.beg:%Y/%m}.*折讓總計')
ORDER BY seq DESC LIMIT 1""",
    "o_service": f"""SELECT gross FROM {{fee_documents}} WHERE CAST(issued AS STRING) LIKE '%{P.beg:%m}%' AND CAST(issued AS STRING) LIKE '%{P.beg:%Y}%'
  AND regexp_matches(doc_no, '[A-Z][A-Z]\\d{{{{8}}}}') ORDER BY seq DESC LIMIT 1""",
    "o_end": """
SELECT account_no, transaction_type, desc_key, CAST(amount AS DECIMAL(28,4)) AS amount FROM (
  SELECT * FROM (VALUES ('111301', 'spe_withdrawal', NULL, 0), ('111301', '期初數', NULL, -15571), ('111302', '期初數', NULL, 0), ('112001', '期初數', NULL, 0),
    ('112002', '期初數', NULL, 191713), ('112002', '發票已開立沖轉', NULL, -191713), ('113101', '期初數', NULL, 0), ('101150', '期初數', NULL, 0),
    ('104171', '期初數', NULL, 25996), ('200208', 'spt', NULL, 0), ('200208', 'spt', NULL, 0), ('200208', '期初數', NULL, -1000), ('200208', '期初數', NULL, 1000),
    ('200601', '期初數', NULL, 0), ('200701', 'spe_withdrawal', NULL, 0), ('200701', '期初數', NULL, -26390), ('440001', '期初數', NULL, 0),
    ('460103', 'spt', 'APCC_ACH', -68150), ('530006', 'spt', '回饋金', -120), ('530006', 'spt', 'COD匯費', 6430), ('999995', 'spe_withdrawal', NULL, 0))
    t(account_no, transaction_type, desc_key, amount)
  UNION ALL SELECT '111301', 'spl手續費調整', NULL, COALESCE((SELECT vat FROM {o_allowance}), 0)
  UNION ALL SELECT '112002', 'spt', NULL, 68150 + (SELECT SUM(total_fee) FROM {o_commission_total})
  UNION ALL SELECT '200701', 'spl手續費調整', NULL, COALESCE((SELECT neg_gross FROM {o_allowance}), 0)
  UNION ALL SELECT '200701', 'spt', NULL, -COALESCE((SELECT gross FROM {o_service}), 0) - 6430 + 120
  UNION ALL SELECT '460103', 'spt', 'APCC_手續費', -(SELECT SUM(total_fee) FROM {o_commission_total})
  UNION ALL SELECT '999995', 'spl手續費調整', NULL, -COALESCE((SELECT vat FROM {o_allowance}), 0) - COALESCE((SELECT neg_gross FROM {o_allowance}), 0)
  UNION ALL SELECT '999995', 'spt', NULL, COALESCE((SELECT gross FROM {o_service}), 0)) u""",
    "o_commission_total": "SELECT round_even(SUM(CAST(c_acctbal AS DECIMAL(18,2))) * 0.0185, 0) AS total_fee FROM {customer}",
    "o_special": """
SELECT * FROM (VALUES ('104171', 'other_利息', NULL, 900), ('111302', 'other_利息', NULL, 100), ('530006', 'other', 'COD匯費', -1000))
t(account_no, transaction_type, desc_key, amount) WHERE EXISTS (SELECT 1 FROM {o_spine} WHERE d = DATE '2024-01-21')""",
    "o_journal": f"""
SELECT l.accounting_date, l.transaction_type, l.account_no,
  COALESCE((SELECT MAX(a.account_desc) FROM {{o_accounts}} a WHERE a.account_no = l.account_no AND (a.desc_key IS NULL OR a.desc_key = l.desc_key)), '') AS account_desc,
  round_even(CAST(l.amount AS DECIMAL(28,4)), 2) AS amount, l.period FROM (
  SELECT strftime(d, '%Y/%m/%d') AS accounting_date, transaction_type, account_no, desc_key, amount, strftime(d, '%Y-%m') AS period FROM {{o_lines}}
  UNION ALL SELECT '2024/01/21', transaction_type, account_no, desc_key, amount, '2024-01' FROM {{o_special}}
  UNION ALL SELECT NULL, transaction_type, account_no, desc_key, amount, '2024-01' FROM {{o_end}}) l""",
    "o_labelled": "SELECT COALESCE(accounting_date, '期末會計調整') AS accounting_date, CASE transaction_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_LABELS.items())
    + " ELSE transaction_type END AS transaction_type, account_no, account_desc, amount, period FROM {o_journal}",
    "o_ledger": """
SELECT m.accounting_date, m.daily_movement, o.balance AS balance_dfr, (SELECT MAX(amount) FROM {o_labelled} WHERE account_no = '104171' AND transaction_type = '00.期初數')
  + SUM(m.daily_movement) OVER (ORDER BY m.accounting_date ROWS UNBOUNDED PRECEDING) AS balance_entry
FROM (SELECT accounting_date, SUM(amount) AS daily_movement FROM {o_labelled} WHERE account_no = '104171' AND regexp_matches(transaction_type, '0[1-5]') GROUP BY 1) m
LEFT JOIN {o_daily} o ON strftime(o.d, '%Y/%m/%d') = m.accounting_date""",
    "o_checked": """
SELECT *, balance_dfr - balance_entry AS chk,
  round_even(CAST(balance_dfr - balance_entry AS DOUBLE) / NULLIF(CAST(balance_dfr AS DOUBLE), 0) * 100, 2) AS pct FROM {o_ledger}""",
}


def balances_of(spark, sf):
    receipts = receipt_report(view(spark, sf, "receipt_raw"), P)
    return ba.balance_report(view(spark, sf, "balance_raw"), receipts, LAYOUT, P)


def commission_row(spark, sf):
    """One-row commission of the period, from the customer balances."""
    base = F.sum(F.col("c_acctbal").cast("decimal(18,2)"))
    return view(spark, sf, "customer").agg(F.bround(base * F.lit("0.0185").cast("decimal(9,6)"), 0).alias("commission_fee"))


def rebate_of(spark, sf):
    return sparse_to_spine(view(spark, sf, "rebates"), "received_date", "received_amount", "seq", P.beg, P.end)


def journal_of(spark, sf):
    bal = balances_of(spark, sf)
    spt = literal_amounts(spark, P.special_receipts, P.beg, P.end)
    return jo.journal_step(bal["dfr_daily"], bal["dfr_result"], rebate_of(spark, sf), spt, P,
                           commission_row(spark, sf), view(spark, sf, "fee_documents"))


def dbl(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {n}" for c, n in (x.split(" AS ") for x in cols))


@register("balance_daily", "D4 P14 A18 J9", f"""
SELECT CAST(o.d AS STRING) AS Date, {dbl('inbound AS Inbound', 'ach AS Unsuccessful_ACH', 'outbound AS Outbound', 'spl AS spl', 'interest AS interest',
 'interbank AS interbank', 'offline_transfer AS offline_transfer', 'service_fee AS withdraw_service_fee', 'balance AS balance',
 'f.rem AS remittance_fee', 'f.fee AS handing_fee')} FROM {{o_daily}} o LEFT JOIN {{o_fees}} f ON f.d = o.d""", CTES)
def balance_daily(spark, sf):
    return balances_of(spark, sf)["dfr_result"]


@register("balance_columns_check", "P15", """
SELECT side, valid, missing, (SELECT COUNT(*) FROM {balance_raw}) AS n_days FROM (VALUES ('inbound', TRUE, ''), ('outbound', FALSE, '')) t(side, valid, missing)""")
def balance_columns_check(spark, sf):
    raw = view(spark, sf, "balance_raw")
    return ba.layout_report(raw, LAYOUT).withColumn("n_days", raw.agg(F.count(F.lit(1)).alias("n")).scalar())


_WP = dbl("rem AS remittance_fee", "inbound AS Inbound", "ach AS Unsuccessful_ACH", "outbound AS Outbound", "fee AS handing_fee")
_WPS = dbl("SUM(rem) AS remittance_fee", "SUM(inbound) AS Inbound", "SUM(ach) AS Unsuccessful_ACH", "SUM(outbound) AS Outbound", "SUM(fee) AS handing_fee")


@register("balance_workpaper", "A19 D5", f"""
SELECT CAST(d AS STRING) AS Date, {_WP} FROM {{o_wp}} UNION ALL SELECT 'Total', {_WPS} FROM {{o_wp}}""", CTES)
def balance_workpaper(spark, sf):
    return balances_of(spark, sf)["dfr_wp"]


@register("running_balance", "W1 W4 D5", """
SELECT CAST(d AS STRING) AS Date, CAST(mv AS DOUBLE) AS daily_movement, CAST(SUM(mv) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING)
  + COALESCE((SELECT arg_max(balance_1, Date) FROM {balance_raw} WHERE Date < DATE '2024-01-05'), 0) AS DOUBLE) AS running_balance
FROM (SELECT d, inbound + ach + outbound + spl + interest + interbank + offline_transfer + service_fee AS mv FROM {o_daily}) t""", CTES)
def running_balance(spark, sf):
    return balances_of(spark, sf)["dfr_with_balance"].select("Date", "daily_movement", "running_balance")


@register("running_total_events", "W1", """
SELECT event_id, e, CAST(SUM(v) OVER (PARTITION BY e ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM {daily}""")
def running_total_events(spark, sf):
    out = running_total(view(spark, sf, "daily"), "v", ["e"], "event_id", "running")
    return out.select("event_id", "e", "running")


@register("spine_fill", "J2 F11", f"""
SELECT CAST(s.d AS STRING) AS Date, CAST(COALESCE(t.v, 0) AS DOUBLE) AS v FROM {{o_spine}} s LEFT JOIN
  (SELECT d, SUM(v) AS v FROM {{daily}} GROUP BY 1) t ON t.d = s.d""", CTES)
def spine_fill(spark, sf):
    per_day = view(spark, sf, "daily").groupBy(F.col("d").alias("Date")).agg(F.sum("v").alias("v"))
    return fill_spine(per_day, P.beg, P.end)


@register("daily_rebate", "J3", """
SELECT CAST(s.d AS STRING) AS Date, CAST(COALESCE(r.reb, 0) AS DOUBLE) AS amount FROM {o_spine} s LEFT JOIN {o_rebate} r ON r.d = s.d""", CTES)
def daily_rebate(spark, sf):
    return rebate_of(spark, sf)


_WIDE = ", ".join(f"CAST(\"{c}\" AS DOUBLE) AS \"{c}\"" for c in dict.fromkeys(_COLS))


@register("journal_wide", "D11 J9", f"SELECT CAST(Date AS STRING) AS Date, {_WIDE} FROM {{o_wide}}", CTES)
def journal_wide(spark, sf):
    return journal_of(spark, sf)["entry_temp"]


_DAYSUM = " + ".join(f'"{c}"' for c in dict.fromkeys(_COLS))


@register("journal_day_balance", "A20", f"""
SELECT abs(SUM(t)) < 1 AS is_balanced, CAST(SUM(t) AS DOUBLE) AS total_diff, CAST(MAX(abs(t)) AS DOUBLE) AS daily_max_diff,
  COUNT(*) FILTER (WHERE abs(t) >= 1) AS unbalanced_days FROM (SELECT {_DAYSUM} AS t FROM {{o_wide}}) x""", CTES)
def journal_day_balance(spark, sf):
    return journal_of(spark, sf)["entry_validation"]


@register("journal_long", "R3 D12 D13 D14 P21 O1 F12 F14", """
SELECT accounting_date, transaction_type, account_no, account_desc, CAST(amount AS DOUBLE) AS amount, period FROM {o_journal}""", CTES)
def journal_long(spark, sf):
    return journal_of(spark, sf)["entry_long"]


@register("allowance_lookup", "F14", f"""
SELECT (SELECT CAST(vat AS DOUBLE) FROM {{o_allowance}}) AS vat, (SELECT CAST(neg_gross AS DOUBLE) FROM {{o_allowance}}) AS neg_gross,
  (SELECT CAST(gross AS DOUBLE) FROM {{o_service}}) AS service_fee""", {
    **CTES,
    "o_allowance": CTES["o_allowance"].replace("2024/01", "1998/10"),
    "o_service": CTES["o_service"].replace("%01%", "%10%").replace("%2024%", "%1998%"),
})
def allowance_lookup(spark, sf):
    from ledgerloom.registry.views import PERIOD

    documents = view(spark, sf, "fee_documents")
    service = jo.service_fee_of_month(documents, PERIOD)
    return jo.allowance_of_month(documents, PERIOD).withColumn("service_fee", service.scalar())


_DATES = jo.period_dates(P)
_DAYCELLS = ", ".join(f"CAST(SUM(amount) FILTER (WHERE accounting_date = '{d}') AS DOUBLE) AS \"{d}\"" for d in _DATES)


@register("journal_pivot", "A17 D16 P20", f"""
SELECT account_no, account_desc, transaction_type, {_DAYCELLS}, CAST(SUM(amount) AS DOUBLE) AS "Total" FROM {{o_labelled}} GROUP BY 1, 2, 3
UNION ALL SELECT 'Total', '', '', {_DAYCELLS}, CAST(SUM(amount) AS DOUBLE) FROM {{o_labelled}}""", CTES)
def journal_pivot(spark, sf):
    return journal_of(spark, sf)["big_entry"]


_TYPES = [t for t in dict.fromkeys(TYPE_LABELS.values()) if t[:2] not in ("00", "09")]
_TYPECELLS = ", ".join(f"CAST(SUM(amount) FILTER (WHERE transaction_type = '{t}') AS DOUBLE) AS \"{t}\"" for t in _TYPES)
_KEPT = "(SELECT * FROM {o_labelled} WHERE transaction_type NOT IN ('00.期初數', '09.發票已開立沖轉')) t"


@register("journal_type_pivot", "A17 P19 P20", f"""
SELECT accounting_date, {_TYPECELLS}, CAST(SUM(amount) AS DOUBLE) AS "Total" FROM {_KEPT} GROUP BY 1
UNION ALL SELECT 'Total', {_TYPECELLS}, CAST(SUM(amount) AS DOUBLE) FROM {_KEPT}""", CTES)
def journal_type_pivot(spark, sf):
    return journal_of(spark, sf)["category_validation"]


@register("ending_balance", "A22", """
SELECT account_no, CAST(NULL AS STRING) AS accounting_date, '調整後期末餘額' AS transaction_type, MAX(account_desc) AS account_desc,
  CAST(trunc(SUM(amount)) AS BIGINT) AS amount, MIN(period) AS period FROM {o_journal} WHERE regexp_matches(account_no, '^1|2') GROUP BY 1""", CTES)
def ending_balance(spark, sf):
    return journal_of(spark, sf)["ending_balance"]


@register("ledger_check", "D15 W2", """
SELECT accounting_date, CAST(daily_movement AS DOUBLE) AS daily_movement, CAST(balance_dfr AS DOUBLE) AS balance_dfr,
  CAST(balance_entry AS DOUBLE) AS balance_entry, CAST(chk AS DOUBLE) AS "check", pct AS check_pct FROM {o_checked}""", CTES)
def ledger_check(spark, sf):
    return journal_of(spark, sf)["dfr_balance_check"]


@register("ledger_check_summary", "A25", """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE chk = 0) AS n_equal, COUNT(*) FILTER (WHERE chk IS NULL OR chk <> 0) AS n_different,
  CAST(MAX(abs(chk)) AS DOUBLE) AS max_abs_diff, round(CAST(SUM(abs(chk)) AS DOUBLE) / COUNT(chk), 4) AS mean_abs_diff,
  COUNT(*) FILTER (WHERE abs(pct) > 1.0) AS n_over_tolerance FROM {o_checked}""", CTES)
def ledger_check_summary(spark, sf):
    out = journal_of(spark, sf)["dfr_balance_summary"]
    return out.withColumn("mean_abs_diff", F.round(F.col("mean_abs_diff").cast("double"), 4))


_MOVE = ", ".join(f"'{t}'" for t in MOVEMENT_TYPES)
_STATS = {
    "lines": "COUNT(*)", "accounts": "COUNT(DISTINCT account_no)", "types": "COUNT(DISTINCT transaction_type)",
    "debit": "SUM(amount) FILTER (WHERE amount > 0)", "credit": "SUM(amount) FILTER (WHERE amount < 0)",
    "movement_debit": f"SUM(amount) FILTER (WHERE amount > 0 AND transaction_type IN ({_MOVE}))",
    "movement_credit": f"SUM(amount) FILTER (WHERE amount < 0 AND transaction_type IN ({_MOVE}))",
    "max": "MAX(amount)", "min": "MIN(amount)",
}


@register("journal_report", "A21 O4", " UNION ALL ".join(
    f"SELECT 'totals' AS section, '{n}' AS item, CAST({e} AS DOUBLE) AS value FROM {{o_journal}}" for n, e in _STATS.items()) + f"""
UNION ALL SELECT 'types', transaction_type, CAST(COUNT(*) AS DOUBLE) FROM {{o_journal}} GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'top_accounts', account_no, CAST(COUNT(*) AS DOUBLE) AS n FROM {{o_journal}} GROUP BY 2 ORDER BY n DESC, account_no LIMIT 10) t
UNION ALL SELECT 'movement', account_no, CAST(trunc(SUM(amount)) AS DOUBLE) FROM {{o_journal}} WHERE transaction_type IN ({_MOVE}) GROUP BY 2""", CTES)
def journal_report(spark, sf):
    return journal_of(spark, sf)["entry_report"]


@register("journal_validation", "Q9", """
SELECT '' AS missing_columns, TRUE AS amount_is_numeric, COUNT(*) FILTER (WHERE transaction_type IS NULL) AS null_transaction_type,
  COUNT(*) FILTER (WHERE account_no IS NULL) AS null_account_no, COUNT(*) FILTER (WHERE amount IS NULL) AS null_amount,
  COUNT(*) FILTER (WHERE abs(amount) > 1e12) AS abnormal_amounts FROM {o_journal}""", CTES)
def journal_validation(spark, sf):
    return journal_of(spark, sf)["entry_checks"]


@register("orders_journal", "R3 O1", """
SELECT strftime(d, '%Y/%m/%d') AS accounting_date, t AS transaction_type, a AS account_no, CASE a WHEN '104171' THEN 'Escrow bank' WHEN '200701'
  THEN 'Amount due to escrow' ELSE 'Bank transaction fee - COD remittance' END AS account_desc,
  CAST(amount AS DOUBLE) AS amount, strftime(d, '%Y-%m') AS period FROM (
  SELECT CAST(o_orderdate AS DATE) AS d, 'received' AS t, '104171' AS a, COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F'), 0) AS amount FROM {orders} GROUP BY 1
  UNION ALL SELECT CAST(o_orderdate AS DATE), 'received', '200701', COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F'), 0) FROM {orders} GROUP BY 1
  UNION ALL SELECT CAST(o_orderdate AS DATE), 'out', '104171', COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O'), 0) FROM {orders} GROUP BY 1
  UNION ALL SELECT CAST(o_orderdate AS DATE), 'fee', '530006', COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P'), 0) FROM {orders} GROUP BY 1) x""")
def orders_journal(spark, sf):
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    wide = view(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("Date")).agg(
        *[F.sum(F.when(F.col("o_orderstatus") == s, amount)).alias(f"acc_{s}") for s in "FOP"])
    mapping = jo.mapping_table(spark, [("acc_F", "104171", "received", None), ("acc_F", "200701", "received", None),
                                       ("acc_O", "104171", "out", None), ("acc_P", "530006", "fee", "COD匯費")])
    lines = jo.to_journal(wide, mapping, jo.account_table(spark), ["acc_F", "acc_O", "acc_P", "acc_absent"])
    return lines.orderBy(F.asc_nulls_last("accounting_date"), F.asc_nulls_last("account_no"))
