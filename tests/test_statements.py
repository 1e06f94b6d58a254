"""Bank rules on small tables: missing dates, cut totals, the last record."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerloom.params import ReconParams
from ledgerloom.plans import statements as st

P = ReconParams(dt.date(2024, 2, 1), dt.date(2024, 2, 29), dt.date(2024, 1, 1), dt.date(2024, 1, 31))
COLS = ("bank string, category string, seq bigint, request_date date, disbursement_date date, request_amount decimal(18,2), "
        "return_amount decimal(18,2), adjustment_amount decimal(18,2), handling_fee decimal(18,2), adjustment_handling_fee decimal(18,2), "
        "local_handling_fee decimal(18,2), disbursement_amount decimal(18,2), invoice_amount decimal(18,2), tax_amount decimal(18,2), store_name string")
JAN, FEB = dt.date(2024, 1, 15), dt.date(2024, 2, 15)


def row(bank, category, seq, asked, paid, amount, **kw):
    names = ["return_amount", "adjustment_amount", "handling_fee", "adjustment_handling_fee", "local_handling_fee",
             "disbursement_amount", "invoice_amount", "tax_amount"]
    money = [Decimal(str(kw.get(n, 0))) for n in names]
    return (bank, category, seq, asked, paid, Decimal(str(amount)), *money, kw.get("store_name"))


@pytest.fixture(scope="module")
def measures(spark):
    data = [
        row("cub", "individual", 1, None, FEB, "100.60", return_amount="-10.70", handling_fee="1.90"),
        row("cub", "individual", 2, None, FEB, "0.60", handling_fee="0.30"),
        row("cub", "individual", 3, None, JAN, "999"),
        row("cub", "individual", 4, None, None, "999"),
        row("ctbc", "installment", 1, FEB, FEB, "50", handling_fee="2", adjustment_handling_fee="1.5", adjustment_amount="3", invoice_amount="7"),
        row("ctbc", "installment", 2, JAN, FEB, "20", handling_fee="1"),
        row("ctbc", "installment", 3, JAN, None, "5", handling_fee="0.5"),
        row("ctbc", "installment", 4, JAN, JAN, "999"),
        row("nccc", "recon", 1, JAN, FEB, "30", handling_fee="3"),
        row("nccc", "recon", 2, FEB, FEB, "40", handling_fee="4"),
        row("nccc", "recon", 3, None, FEB, "1", handling_fee="1"),
        row("nccc", "recon", 4, FEB, None, "999", handling_fee="999"),
        row("ub", "installment", 1, FEB, FEB, "10", store_name="自行卡"),
        row("ub", "installment", 2, JAN, FEB, "20", store_name="他行卡", handling_fee="2"),
        row("ub", "installment", 3, FEB, FEB, "500", store_name="主公司", handling_fee="9"),
        row("ub", "installment", 4, FEB, JAN, "0", store_name="調整 -- 退貨", handling_fee="4"),
        row("ub", "installment", 5, JAN, JAN, "77.9", store_name="商店總計"),
        row("ub", "installment", 6, None, FEB, "888", store_name="自行卡"),
        row("taishi", "default", 1, None, FEB, "100", disbursement_amount="97", invoice_amount="3", tax_amount="0.1"),
        row("taishi", "default", 2, None, FEB, "0", disbursement_amount="0", invoice_amount="2.5", tax_amount="1.9"),
    ]
    df = spark.createDataFrame(data, COLS)
    return {(r["bank"]): r.asDict() for r in st.period_measures(df, P).collect()}


def test_by_disbursement_cuts_each_total(measures):
    m = measures["cub"]
    assert (m["claimed"], m["returned"], m["trust_amount"], m["fee"], m["invoice_claimed"], m["n_rows"]) == (101, 10, 91, 2, 91, 3)


def test_missing_payment_counts_as_unpaid(measures):
    m = measures["ctbc"]
    assert (m["claimed"], m["carry_in"], m["adjustment"], m["trust_amount"], m["fee"], m["prior_fee"]) == (50, 25, 3, 78, 3, 1)
    assert (m["invoice_claimed"], m["invoice_fee"]) == (50, 7)


def test_missing_request_counts_as_not_requested(measures):
    m = measures["nccc"]
    assert (m["claimed"], m["carry_in"], m["fee"], m["prior_fee"], m["invoice_claimed"], m["invoice_fee"]) == (71, 31, 8, 3, 40, 4)


def test_store_rule(measures):
    m = measures["ub"]
    assert (m["trust_amount"], m["claimed"], m["carry_in"], m["fee"], m["prior_fee"], m["fee_adjustment"]) == (30, 10, 20, 9, 2, 4)
    assert m["invoice_claimed"] == 77 and m["invoice_fee"] == 0


def test_zero_paid_rows_are_carved_out(measures):
    m = measures["taishi"]
    assert (m["claimed"], m["trust_amount"], m["fee"], m["fee_adjustment"], m["tax_adjustment"], m["invoice_fee"]) == (100, 97, 3, 2, 1, None)


def test_disabled_bank_is_left_out(spark):
    df = spark.createDataFrame([row("cub", "individual", 1, None, FEB, 1), row("nccc", "recon", 1, FEB, FEB, 1)], COLS)
    only = P.with_(enabled_banks=("nccc",))
    assert [r["bank"] for r in st.period_measures(df, only).collect()] == ["nccc"]
    assert [r["bank"] for r in st.period_measures(df, only, whole_table=False).collect()] == ["nccc"]


def test_summary_lists_every_table_even_without_rows(spark):
    df = spark.createDataFrame([row("cub", "individual", 1, None, FEB, 1)], COLS)
    out = st.ordered_summary(st.bank_summary(st.period_measures(df, P, whole_table=False))).collect()
    assert [r["name"] for r in out][:2] == ["taishi", "nccc"] and len(out) == 8


def test_params_from_settings():
    p = ReconParams.from_dict({"beg": "2024-02-01", "end": "2024-02-29", "last_beg": "2024-01-01", "last_end": "2024-01-31",
                               "tax_rate": 0.05, "opening_balances": {"104171": 12.5}, "enabled_banks": ["ub"]})
    assert p.tax_rate == Decimal("0.05") and p.opening_balances["104171"] == Decimal("12.5") and p.period == "2024-02"
    with pytest.raises(KeyError):
        ReconParams.from_dict({"nonsense": 1})
    with pytest.raises(ValueError):
        P.with_(beg=dt.date(2025, 1, 1))
