"""Fixed values of the reconciliation: banks, terms, accounts, mappings. Plain data, no logic."""

from __future__ import annotations

# Statement categories, in display order of the summary.
STATEMENT_ORDER = [
    "taishi",
    "nccc",
    "cub_nonindividual",
    "cub_individual",
    "ctbc_noninstallment",
    "ctbc_installment",
    "ub_noninstallment",
    "ub_installment",
]

# Statement tables as (bank, category).
STATEMENT_TABLES = [
    ("cub", "individual"), ("cub", "nonindividual"), ("ctbc", "installment"), ("ctbc", "noninstallment"),
    ("nccc", "recon"), ("ub", "installment"), ("ub", "noninstallment"), ("taishi", "default"),
]

# Dates that must be present for a statement row to be read, by bank.
REQUIRED_DATES = {
    "cub": ("disbursement_date",),
    "ctbc": (),
    "nccc": ("disbursement_date",),
    "ub": ("disbursement_date", "request_date"),
    "taishi": ("disbursement_date",),
}

# Stores of the store-aware rule.
TARGET_STORES = ["他行卡", "自行卡", "自行卡分期內含"]
CARD_STORE_TEXT = "行卡"
REFUND_STORE = "調整 -- 退貨"

# Instalment terms.
TERM_LABELS = {"03": "3期", "06": "6期", "12": "12期", "24": "24期"}
INSTALMENT_TYPES = ["3期", "6期", "12期", "24期"]
TRANSACTION_TYPES = ["normal", "3期", "6期", "12期", "24期"]
SUBTOTAL = "小計"

# Bank code -> display name, in matrix order, and finance report code -> display name.
BANK_NAMES = {"taishi": "台新", "nccc": "NCCC", "cub": "國泰", "ctbc": "CTBC", "ub": "聯邦"}
MATRIX_BANKS = ["台新", "NCCC", "國泰", "CTBC", "聯邦"]
RECEIPT_BANKS = {"TSPG": "台新", "CTBC": "CTBC", "NCCC": "NCCC", "CUB": "國泰", "UBOT": "聯邦"}
PLUG_BANKS = ["國泰", "聯邦"]

# Columns of the finance receipt report, by position.
RECEIPT_COLUMNS = [
    "Date",
    "TSPG_Net_Billing", "TSPG_Handling_Fee", "TSPG_Adjustment", "TSPG_Net_Disbursement",
    "CTBC_Net_Billing", "CTBC_Handling_Fee", "CTBC_Adjustment", "CTBC_Net_Disbursement",
    "NCCC_Net_Billing", "NCCC_Handling_Fee", "NCCC_Adjustment", "NCCC_Net_Disbursement",
    "CUB_Net_Billing", "CUB_Handling_Fee", "CUB_Adjustment", "CUB_Remittance_Fee", "CUB_Net_Disbursement",
    "UBOT_Net_Billing", "UBOT_Handling_Fee", "UBOT_Remittance_Fee", "UBOT_Adjustment", "UBOT_Net_Disbursement",
]
RECEIPT_METRICS = ["Net_Billing", "Handling_Fee", "Adjustment", "Remittance_Fee", "Net_Disbursement"]

# Payment report labels.
PAYMENT_ROWS = {
    "normal": "Non-installment-Payment",
    "3期": "Installment-Payment-3M",
    "6期": "Installment-Payment-6M",
    "12期": "Installment-Payment-12M",
    "24期": "Installment-Payment-24M",
}
PAYMENT_BANKS = {"台新": "TSB", "NCCC": "NCCC", "國泰": "Cathay", "CTBC": "CTBC", "聯邦": "UBOT"}

# Chart of accounts (account, description key, description).
ACCOUNTS = [
    ("101150", None, "Cash in bank"),
    ("104171", None, "Escrow bank"),
    ("111301", None, "Tax receivable - GST/VAT"),
    ("111302", None, "Tax receivable - WHT"),
    ("112001", None, "Amount due from related party"),
    ("112002", None, "Unbilled receivables"),
    ("113101", None, "Receivables from payment gateway"),
    ("200208", None, "Receive on behalf"),
    ("200601", None, "Tax payables - GST/VAT/WHT"),
    ("200701", None, "Amount due to escrow"),
    ("440001", None, "Interest income"),
    ("999995", None, "Cash clearing"),
    ("460103", "APCC_ACH", "Commission charge - ACH"),
    ("460103", "APCC_手續費", "Commission charge - acquiring"),
    ("530006", "收單_SPE", "Bank transaction fee - acquiring"),
    ("530006", "回饋金", "Bank transaction fee - rebate"),
    ("530006", "內扣CTBCCC匯費", "Bank transaction fee - remittance"),
    ("530006", "COD匯費", "Bank transaction fee - COD remittance"),
]

# Wide journal column -> (account, transaction type, description key).
ENTRY_MAPPING = [
    ("acc_200208_ReceivedCTBCSPT_negative", "200208", "received_ctbc_spt", None),
    ("acc_200208_ReceivedCTBCSPT_positive", "200208", "received_ctbc_spt", None),
    ("acc_200701_OutCTBCSPT", "200701", "out_ctbc_spt", None),
    ("acc_200701_ReceivedCTBCSPT_negative", "200701", "received_ctbc_spt", None),
    ("acc_200701_ReceivedCTBCSPT退匯", "200701", "received_ctbc_spt_退匯", None),
    ("acc_530006_收單_SPE", "530006", "received_ctbc_spt", "收單_SPE"),
    ("acc_530006_內扣CTBCCC匯費", "530006", "內扣_ctbc_cc_匯費", "內扣CTBCCC匯費"),
    ("acc_101150_Received_CTBC_SPT", "101150", "received_ctbc_spt", None),
    ("acc_104171_OutCTBCSPT", "104171", "out_ctbc_spt", None),
    ("acc_104171_ReceivedCTBCSPT", "104171", "received_ctbc_spt", None),
    ("acc_104171_ReceivedCTBCSPT退匯", "104171", "received_ctbc_spt_退匯", None),
    ("acc_104171_內扣CTBCCC匯費", "104171", "內扣_ctbc_cc_匯費", None),
    ("acc_104171_others", "104171", "other", None),
    ("acc_104171_others_利息", "104171", "other_利息", None),
    ("acc_999995_others", "999995", "other", None),
    ("acc_440001_interest", "440001", "other_利息", None),
    ("acc_111302_interest", "111302", "other_利息", None),
]

# Transaction type -> ordered label.
TYPE_LABELS = {
    "期初數": "00.期初數",
    "內扣_ctbc_cc_匯費": "01.內扣_ctbc_cc_匯費",
    "received_ctbc_spt": "02.received_ctbc_spt",
    "received_ctbc_spt_退匯": "03.received_ctbc_spt_退匯",
    "out_ctbc_spt": "04.out_ctbc_spt",
    "other": "05.other",
    "other_利息": "05.other_利息",
    "spt": "06.spt",
    "spe_withdrawal": "07.spe_withdrawal",
    "spl手續費調整": "08.spl手續費調整",
    "發票已開立沖轉": "09.發票已開立沖轉",
}
ZERO_CHECK_EXCLUDED = ["00.期初數", "09.發票已開立沖轉"]
MOVEMENT_TYPES = [
    "內扣_ctbc_cc_匯費", "received_ctbc_spt", "received_ctbc_spt_退匯", "out_ctbc_spt", "other", "other_利息",
]

# Period-end lines (account, type, description key, setting that gives the fixed part, its sign,
# then the factors of: allowance tax, allowance gross, service fee, commission).
PERIOD_END_LINES = [
    ("111301", "spe_withdrawal", None, None, 1, 0, 0, 0, 0),
    ("111301", "spl手續費調整", None, None, 1, 1, 0, 0, 0),
    ("111301", "期初數", None, "111301", 1, 0, 0, 0, 0),
    ("111302", "期初數", None, "111302", 1, 0, 0, 0, 0),
    ("112001", "期初數", None, "112001", 1, 0, 0, 0, 0),
    ("112002", "spt", None, "ach", 1, 0, 0, 0, 1),
    ("112002", "期初數", None, "112002", 1, 0, 0, 0, 0),
    ("112002", "發票已開立沖轉", None, "112002_reversal", 1, 0, 0, 0, 0),
    ("113101", "期初數", None, "113101", 1, 0, 0, 0, 0),
    ("101150", "期初數", None, "101150", 1, 0, 0, 0, 0),
    ("104171", "期初數", None, "104171", 1, 0, 0, 0, 0),
    ("200208", "spt", None, None, 1, 0, 0, 0, 0),
    ("200208", "spt", None, None, 1, 0, 0, 0, 0),
    ("200208", "期初數", None, "200208_credit", 1, 0, 0, 0, 0),
    ("200208", "期初數", None, "200208_debit", 1, 0, 0, 0, 0),
    ("200601", "期初數", None, "200601", 1, 0, 0, 0, 0),
    ("200701", "spe_withdrawal", None, None, 1, 0, 0, 0, 0),
    ("200701", "spl手續費調整", None, None, 1, 0, 1, 0, 0),
    ("200701", "spt", None, "cod_less_rebate", -1, 0, 0, -1, 0),
    ("200701", "期初數", None, "200701", 1, 0, 0, 0, 0),
    ("440001", "期初數", None, "440001", 1, 0, 0, 0, 0),
    ("460103", "spt", "APCC_ACH", "ach", -1, 0, 0, 0, 0),
    ("460103", "spt", "APCC_手續費", None, 1, 0, 0, 0, -1),
    ("530006", "spt", "回饋金", "rebate", -1, 0, 0, 0, 0),
    ("530006", "spt", "COD匯費", "cod", 1, 0, 0, 0, 0),
    ("999995", "spe_withdrawal", None, None, 1, 0, 0, 0, 0),
    ("999995", "spl手續費調整", None, None, 1, -1, -1, 0, 0),
    ("999995", "spt", None, None, 1, 0, 0, 1, 0),
]
PERIOD_END_LABEL = "期末會計調整"

# Result name -> sheet name of the workpaper set, in output order.
WORKPAPER_SHEETS = [
    ("big_entry", "大entry"),
    ("dfr_balance_check", "104171 vs DFR"),
    ("category_validation", "分類驗證"),
    ("entry_validation", "Entry Source Validation"),
    ("entry_temp", "entry_temp"),
    ("entry_long_temp", "entry_long_temp"),
    ("dfr_raw", "dfr"),
    ("dfr_with_balance", "dfr_detail"),
    ("dfr_wp", "dfr_wp"),
    ("apcc_acquiring_charge", "APCC手續費"),
    ("apcc_validate_frr", "apcc_validate_frr"),
    ("apcc_summary", "Trust account fee回補手續費"),
    ("trust_account_fee", "trust_account_fee"),
    ("validation_summary", "validate_frr_summary"),
    ("validate_frr_handling_fee", "validate_frr_handling_fee"),
    ("validate_frr_net_billing", "validate_frr_net_billing"),
    ("frr_handling_fee", "frr_handling_fee"),
    ("frr_remittance_fee", "frr_remittance_fee"),
    ("frr_long_format", "extracted_from_frr"),
    ("acquiring_charge_history", "acquiring_charge_history"),
    ("apcc_history", "APCC手續費_history"),
]

# The words of the boolean cast, and the characters stripped from text numbers.
TRUE_WORDS = ["true", "yes", "1", "y", "t", "是", "有"]
FALSE_WORDS = ["false", "no", "0", "n", "f", "否", "無"]
STRIP_CHARS = [",", "$", "€", "¥", " ", "￥", "₩", "£", "_", "-"]

# Type names that count as the same type in a schema comparison.
TYPE_FAMILIES = [
    ("INT", "INTEGER", "INT4", "SIGNED"),
    ("BIGINT", "INT8", "LONG"),
    ("SMALLINT", "INT2", "SHORT"),
    ("TINYINT", "INT1"),
    ("DOUBLE", "FLOAT8", "NUMERIC", "DECIMAL"),
    ("REAL", "FLOAT4", "FLOAT"),
    ("VARCHAR", "STRING", "TEXT", "CHAR", "BPCHAR"),
    ("BOOLEAN", "BOOL", "LOGICAL"),
    ("TIMESTAMP", "DATETIME", "TIMESTAMP WITH TIME ZONE"),
]
