"""Native input tables of the engine, derived from the given tables.

Each view is one SQL text that reads the same in Spark and DuckDB; ``{name}`` stands for a given
table or another view. Every view reads its whole source tables.
"""

from __future__ import annotations

import datetime as dt
import string
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.params import ReconParams
from ledgerloom.sources.writers import write_statements

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

PERIOD = ReconParams(
    beg=dt.date(1998, 10, 1), end=dt.date(1998, 10, 31), last_beg=dt.date(1998, 9, 1), last_end=dt.date(1998, 9, 30),
    claimed_adjustments={"國泰": Decimal("-611"), "NCCC": Decimal("250")},
    fee_rounding={"台新": Decimal("5")},
)
DAILY = ReconParams(
    beg=dt.date(2024, 1, 5), end=dt.date(2024, 1, 31), last_beg=dt.date(2023, 12, 1), last_end=dt.date(2023, 12, 31),
    special_receipts={"2024-01-09": Decimal("1814.25"), "2024-01-28": Decimal("952.75")},
    cod_remittance_fee=Decimal("6430"), ach_expense=Decimal("68150"), ctbc_rebate=Decimal("120"),
    opening_balances={"111301": Decimal("-15571"), "104171": Decimal("25996"), "112002": Decimal("191713"),
                      "200701": Decimal("-26390"), "200208_debit": Decimal("1000"), "200208_credit": Decimal("-1000")},
    special_entries={
        "2024-01-21": [
            {"account_no": "104171", "transaction_type": "other_利息", "amount": 900},
            {"account_no": "111302", "transaction_type": "other_利息", "amount": 100},
            {"account_no": "530006", "transaction_type": "other", "amount": -1000, "desc_key": "COD匯費"},
        ],
        "2025-01-21": [{"account_no": "104171", "transaction_type": "other", "amount": 1}],
    },
)

VIEWS: dict[str, str] = {}

VIEWS["statements"] = """
SELECT CASE l_suppkey % 5 WHEN 0 THEN 'taishi' WHEN 1 THEN 'nccc' WHEN 2 THEN 'cub' WHEN 3 THEN 'ctbc' ELSE 'ub' END AS bank,
  CASE l_suppkey % 5 WHEN 0 THEN 'default' WHEN 1 THEN 'recon'
    WHEN 2 THEN CASE WHEN l_linestatus = 'F' THEN 'individual' ELSE 'nonindividual' END
    ELSE CASE WHEN l_linestatus = 'F' THEN 'installment' ELSE 'noninstallment' END END AS category,
  (((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey % 100000) * 1000 + l_suppkey % 1000) * 51 + CAST(l_quantity AS BIGINT) AS seq,
  CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS disbursement_date,
  CASE WHEN l_quantity = 49 THEN NULL ELSE CAST(l_shipdate AS DATE) - (l_linenumber * 7) END AS request_date,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS request_amount,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS handling_fee,
  CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS return_amount,
  CASE WHEN l_linenumber = 6 THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS adjustment_amount,
  CASE WHEN l_linenumber = 6 THEN CAST(l_tax AS DECIMAL(18,2)) ELSE NULL END AS adjustment_handling_fee,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS local_handling_fee,
  CASE WHEN CAST(l_discount AS DECIMAL(4,2)) = 0.10 THEN CAST(0 AS DECIMAL(18,4))
    ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) END AS disbursement_amount,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS invoice_amount,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tax_amount,
  CASE l_linenumber WHEN 1 THEN '他行卡' WHEN 2 THEN '自行卡' WHEN 3 THEN '自行卡分期內含' WHEN 4 THEN '主公司'
    WHEN 5 THEN '調整 -- 退貨' WHEN 6 THEN '商店總計' ELSE NULL END AS store_name,
  CASE l_linenumber WHEN 1 THEN 'normal' WHEN 2 THEN '3期' WHEN 3 THEN '6期' WHEN 4 THEN '12期' WHEN 5 THEN '24期'
    WHEN 6 THEN 'adj' ELSE 'normal' END AS transaction_type
FROM {lineitem}
"""

VIEWS["invoices"] = """
SELECT CASE o_custkey % 8 WHEN 0 THEN 'taishi' WHEN 1 THEN 'nccc' WHEN 2 THEN 'cub_individual' WHEN 3 THEN 'cub_nonindividual'
    WHEN 4 THEN 'ctbc_installment' WHEN 5 THEN 'ctbc_noninstallment' WHEN 6 THEN 'ub_installment'
    ELSE 'ub_noninstallment' END AS category,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
    ELSE REPLACE(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') END AS invoice_date,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '收單手續費' ELSE '貨款' END AS invoice_description,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount_excl_tax,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tax_amount,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS amount_incl_tax
FROM {orders}
"""

# Report rows carry their file and a running number; keys stand only on the first row of a group.
VIEWS["plain_report"] = """
SELECT CASE o_custkey % 3 WHEN 0 THEN 'cub_individual' WHEN 1 THEN 'cub_nonindividual' ELSE 'nccc' END AS report,
  CAST(FLOOR(o_orderkey / 1000) AS BIGINT) AS file_no,
  o_orderkey AS seq,
  CASE WHEN o_orderkey % 7 = 0 THEN SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) ELSE NULL END AS claim_month,
  CASE WHEN o_orderkey % 4 = 0 THEN CASE o_custkey % 5 WHEN 0 THEN '3期' WHEN 1 THEN '6期' WHEN 2 THEN '12期' WHEN 3 THEN '24期' ELSE '一般' END
    ELSE NULL END AS term,
  CASE WHEN o_orderkey % 9 = 0 THEN CONCAT('S', CAST(o_custkey AS STRING)) ELSE NULL END AS store_code,
  CASE WHEN o_orderkey % 13 = 0 THEN '小計' WHEN o_orderkey % 17 = 0 THEN NULL ELSE '請款' END AS kind,
  CASE WHEN o_orderkey % 12 = 0 THEN '合計' WHEN o_orderkey % 10 = 0 THEN NULL
    ELSE CASE o_custkey % 5 WHEN 0 THEN '03' WHEN 1 THEN '06' WHEN 2 THEN '12' WHEN 3 THEN '24' ELSE '99' END END AS row_term,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS amount,
  CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.02 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS STRING) AS fee
FROM {orders}
"""

VIEWS["sheet_report"] = """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN CONCAT('分-', md) ELSE md END AS source,
  CASE WHEN o_orderkey % 2 = 0 THEN CASE o_custkey % 5 WHEN 0 THEN 3 WHEN 1 THEN 6 WHEN 2 THEN 12 WHEN 3 THEN 24 ELSE NULL END ELSE NULL END AS term,
  CASE WHEN o_custkey % 11 = 0 THEN '帳務調整' WHEN o_custkey % 3 = 0 THEN NULL ELSE '一般' END AS product,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '非本行國內' WHEN 2 THEN '帳務調整' ELSE 'TOTAL' END END AS card,
  amount,
  CAST(amount * CAST(0.02 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS fee
FROM (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  REPLACE(SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 6, 5), '-', '') AS md FROM {orders}) t
"""

VIEWS["rated_report"] = """
SELECT o_orderkey AS seq,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE '主公司' END AS store_name,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE '請款' END AS kind,
  CASE o_custkey % 5 WHEN 0 THEN '03' WHEN 1 THEN '06' WHEN 2 THEN '12' WHEN 3 THEN '24' ELSE '30' END AS term,
  CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS STRING) AS amount,
  CAST(CAST(FLOOR(o_totalprice * 0.02) AS BIGINT) AS STRING) AS fee
FROM {orders}
"""

VIEWS["card_report"] = """
SELECT CASE o_orderkey % 2 WHEN 0 THEN 'normal' ELSE 'voucher' END AS sheet,
  CAST(FLOOR(o_orderkey / 1000) AS BIGINT) AS file_no,
  o_orderkey AS seq,
  CASE WHEN o_orderkey % 1000 IN (990, 991) THEN '總筆數' WHEN o_orderkey % 5 = 0 THEN 'Visa|卡' ELSE NULL END AS card,
  CASE WHEN o_orderkey % 8 IN (0, 1) THEN CASE o_custkey % 6 WHEN 0 THEN '一 般' WHEN 1 THEN '3 期' WHEN 2 THEN '6期' WHEN 3 THEN '12期'
    WHEN 4 THEN '24期' ELSE '小 計' END ELSE NULL END AS transaction_type,
  CASE o_orderkey % 6 WHEN 0 THEN '筆數' WHEN 1 THEN '金額' WHEN 2 THEN '金額' WHEN 3 THEN '筆數' ELSE NULL END AS count_and_amount,
  CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS STRING) AS subtotal
FROM {orders}
"""

VIEWS["rate_matrix"] = """
SELECT CASE p_size WHEN 41 THEN '一般' WHEN 42 THEN '3期' WHEN 43 THEN '6期' WHEN 44 THEN '12期' WHEN 45 THEN '24期'
    ELSE CAST(p_size AS STRING) END AS idx, CAST(MIN(p_partkey) AS STRING) AS level_0,
  CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 11 = 0 THEN ' ' ELSE CAST(CAST(p_size * 0.0005 AS DECIMAL(9,6)) AS STRING) END AS ub,
  CAST(CAST(p_size * 0.0007 AS DECIMAL(9,6)) AS STRING) AS taishi,
  CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE CAST(CAST(p_size * 0.0009 AS DECIMAL(9,6)) AS STRING) END AS taishi_voucher
FROM {part} GROUP BY p_size
"""

VIEWS["daily"] = """
SELECT CAST(ts AS DATE) AS d, event_type AS e, CAST(value AS DECIMAL(18,2)) AS v, event_id, user_id FROM {events}
"""


def _receipt_sql() -> str:
    """Wide daily report as text, one block of columns per bank, with a total row and dirty cells."""
    blocks = [("view", 4), ("signup", 4), ("error", 4), ("click", 5), ("purchase", 5)]
    cols: list[str] = []
    for event, width in blocks:
        pick = f"SUM(CASE WHEN e = '{event}' THEN v END)"
        fee = f"SUM(CASE WHEN e = '{event}' THEN CAST(v * CAST(-0.02 AS DECIMAL(4,2)) AS DECIMAL(18,4)) END)"
        adj = (f"CASE WHEN EXTRACT(DAY FROM d) % 10 = 3 THEN '-' ELSE CAST(SUM(CASE WHEN e = '{event}' AND event_id % 50 = 0 "
               "THEN -v END) AS STRING) END")
        remit = f"SUM(CASE WHEN e = '{event}' AND event_id % 100 = 0 THEN CAST(-30 AS DECIMAL(18,2)) END)"
        net = f"SUM(CASE WHEN e = '{event}' THEN CAST(v * CAST(0.98 AS DECIMAL(4,2)) AS DECIMAL(18,4)) END)"
        text = [f"CAST({pick} AS STRING)", f"CAST({fee} AS STRING)", adj]
        if width == 5:
            text.insert(2 if event == "purchase" else 3, f"CAST({remit} AS STRING)")
        text.append(f"CAST({net} AS STRING)")
        cols += text
    named = ",\n  ".join(f"{c} AS c{i + 1}" for i, c in enumerate(cols))
    total = ", ".join(f"CAST(COUNT(*) AS STRING) AS c{i + 1}" for i in range(len(cols)))
    return (f"SELECT CAST(d AS STRING) AS c0,\n  {named},\n  'memo' AS c23 FROM {{daily}} GROUP BY d\n"
            f"UNION ALL SELECT NULL AS c0, {total}, NULL AS c23 FROM {{daily}}")


VIEWS["receipt_raw"] = _receipt_sql()


def _balance_sql() -> str:
    names = ["bt", "cc_a", "cc_b", "collection_shop", "memo_amount", "offline_transfer", "adj_transfer", "ach_a", "ach_b",
             "out_a", "out_b", "out_tax", "spl", "interest", "interbank", "service_fee"]
    signed = {"ach_a": "v", "out_a": "-v", "out_b": "-v", "out_tax": "-v", "service_fee": "-v"}
    cols = [f"SUM(CASE WHEN user_id % 16 = {i} THEN {signed.get(n, 'v')} END) AS {n}" for i, n in enumerate(names)]
    return "SELECT d AS Date, " + ",\n  ".join(cols) + ", SUM(v) * 3 AS balance_1 FROM {daily} GROUP BY d"


VIEWS["balance_raw"] = _balance_sql()

VIEWS["rebates"] = """
SELECT d AS received_date, event_id AS seq, v AS received_amount FROM {daily} WHERE e = 'signup' AND EXTRACT(DAY FROM d) % 4 = 0
"""

VIEWS["fee_parts"] = """
SELECT SUBSTR(CAST(disbursement_date AS STRING), 1, 7) AS month,
  CASE bank WHEN 'taishi' THEN '台新' WHEN 'nccc' THEN 'NCCC' WHEN 'cub' THEN '國泰' WHEN 'ctbc' THEN 'CTBC' ELSE '聯邦' END AS bank,
  CASE WHEN transaction_type = 'adj' THEN 'normal' ELSE transaction_type END AS transaction_type,
  request_amount, handling_fee FROM {statements} WHERE disbursement_date IS NOT NULL
"""

VIEWS["fee_history"] = """
SELECT transaction_type, CAST(SUM(request_amount) AS DECIMAL(24,4)) AS amount, bank, 'claimed' AS amt_type, CONCAT(month, '-28') AS period
  FROM {fee_parts} GROUP BY transaction_type, bank, month
UNION ALL SELECT transaction_type, CAST(SUM(handling_fee) AS DECIMAL(24,4)) AS amount, bank, 'acquiring' AS amt_type, CONCAT(month, '-28') AS period
  FROM {fee_parts} GROUP BY transaction_type, bank, month
UNION ALL SELECT '小計' AS transaction_type, CAST(SUM(request_amount) AS DECIMAL(24,4)) AS amount, bank, 'claimed' AS amt_type, CONCAT(month, '-28') AS period
  FROM {fee_parts} GROUP BY bank, month
UNION ALL SELECT '小計' AS transaction_type, CAST(SUM(handling_fee) AS DECIMAL(24,4)) AS amount, bank, 'acquiring' AS amt_type, CONCAT(month, '-28') AS period
  FROM {fee_parts} GROUP BY bank, month
"""

VIEWS["commission_history"] = """
SELECT transaction_type, CAST(SUM(request_amount) AS DECIMAL(24,4)) AS subtotal, CAST(0.0185 AS DECIMAL(9,6)) AS charge_rate,
  CAST(SUM(handling_fee) * CAST(1.2 AS DECIMAL(4,2)) AS DECIMAL(24,4)) AS commission_fee, CONCAT(month, '-28') AS end_date,
  CAST(COUNT(*) AS BIGINT) AS seq
FROM {fee_parts} GROUP BY transaction_type, month
UNION ALL SELECT '小計' AS transaction_type, CAST(SUM(request_amount) AS DECIMAL(24,4)) AS subtotal, CAST(0.0185 AS DECIMAL(9,6)) AS charge_rate,
  CAST(SUM(handling_fee) * CAST(1.2 AS DECIMAL(4,2)) AS DECIMAL(24,4)) AS commission_fee, CONCAT(month, '-28') AS end_date,
  CAST(COUNT(*) AS BIGINT) AS seq
FROM {fee_parts} WHERE SUBSTR(month, 6, 2) <> '03' GROUP BY month
"""

VIEWS["fee_documents"] = """
SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS issued,
  CASE WHEN o_orderkey % 3 = 0 THEN CONCAT(REPLACE(SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7), '-', '/'), ' 折讓總計')
    WHEN o_orderkey % 3 = 1 THEN CONCAT('AB', CAST(10000000 + o_orderkey AS STRING)) ELSE NULL END AS doc_no,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS vat,
  CAST(o_totalprice AS DECIMAL(18,2)) AS gross FROM {orders}
"""

VIEWS["dirty"] = """
SELECT o_orderkey AS k, amt,
  CASE o_orderkey % 12
    WHEN 0 THEN CONCAT('$', CAST(amt AS STRING))
    WHEN 1 THEN CONCAT(' ', CAST(CAST(FLOOR(amt / 1000) AS BIGINT) AS STRING), ',', LPAD(CAST(CAST(FLOOR(amt) AS BIGINT) % 1000 AS STRING), 3, '0'), ' ')
    WHEN 2 THEN '-' WHEN 3 THEN 'N/A' WHEN 4 THEN '5%' WHEN 5 THEN 'abc' WHEN 6 THEN NULL WHEN 7 THEN ''
    WHEN 8 THEN CONCAT(CAST(CAST(FLOOR(amt) AS BIGINT) AS STRING), '元') WHEN 9 THEN CONCAT('NT$', CAST(amt AS STRING))
    WHEN 10 THEN CONCAT('-', CAST(amt AS STRING)) ELSE CAST(amt AS STRING) END AS amount_text,
  CASE o_orderkey % 7
    WHEN 0 THEN CAST(day AS STRING) WHEN 1 THEN REPLACE(CAST(day AS STRING), '-', '/') WHEN 2 THEN REPLACE(CAST(day AS STRING), '-', '')
    WHEN 3 THEN 'not a date' WHEN 4 THEN NULL WHEN 5 THEN CONCAT(' ', CAST(day AS STRING), ' ') ELSE 'nan' END AS date_text,
  CASE o_orderkey % 8 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' yes' WHEN 2 THEN '是' WHEN 3 THEN 'N' WHEN 4 THEN '否' WHEN 5 THEN '0' WHEN 6 THEN 'maybe' ELSE NULL END AS flag_text,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CONCAT('  ', o_orderpriority, ' ') END AS note
FROM (SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS amt, CAST(o_orderdate AS DATE) AS day FROM {orders}) t
"""

VIEWS["target_customers"] = """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM {customer}
"""

VIEWS["customer_updates"] = """
SELECT c_custkey + CASE WHEN c_custkey % 3 = 2 THEN 1000000 ELSE 0 END AS c_custkey, c_name,
  CASE WHEN c_custkey % 6 = 1 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS c_nationkey, c_mktsegment,
  CAST(c_acctbal + 1 AS DECIMAL(18,2)) AS balance
FROM {customer} WHERE (c_nationkey < 4 AND c_mktsegment = 'BUILDING') OR (c_nationkey BETWEEN 4 AND 8 AND c_mktsegment = 'MACHINERY')
"""


def _placeholders(text: str) -> list[str]:
    seen: dict[str, None] = {}
    for _, name, _, _ in string.Formatter().parse(text):
        if name:
            seen[name] = None
    return list(seen)


# Lazy handles only, no data: a table's footer is read and a view is analysed once per session.
_HANDLES: dict[tuple[str, str, str], DataFrame] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived view as a lazy DataFrame."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _HANDLES:
        if name in TABLES:
            _HANDLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            deps = {d: view(spark, sf_dir, d) for d in _placeholders(VIEWS[name])}
            _HANDLES[key] = spark.sql(VIEWS[name], **deps)
    return _HANDLES[key]


table = view

def write_views(spark: SparkSession, sf_dir: str, root: str, names: list[str] | None = None) -> None:
    """Write views as Parquet tables and use those from then on, as a user with native tables would."""
    for name in names or list(VIEWS):
        path = f"{root}/{name}"
        df = view(spark, sf_dir, name)
        write_statements(df, path) if name == "statements" else df.write.parquet(path)
        _HANDLES[(spark.sparkContext.applicationId, sf_dir, name)] = spark.read.schema(df.schema).parquet(path)


def checked_by(final_sql: str, ctes: dict[str, str] | None = None) -> str:
    """The check SQL with every view it names written out before it."""
    extra = ctes or {}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _placeholders(text):
            if name in TABLES or name in order:
                continue
            body = extra.get(name) or VIEWS[name]
            visit(body)
            order.append(name)

    visit(final_sql)
    bodies = {n: (extra.get(n) or VIEWS[n]) for n in order}
    fill = {n: n for n in [*TABLES, *order]}
    parts = [f"{n} AS ({bodies[n].format(**fill).strip()})" for n in order]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + final_sql.format(**fill).strip()
