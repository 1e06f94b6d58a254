"""Journal invariants: every day nets to zero, margins agree, labels and lookups."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.joins import date_spine, literal_amounts
from ledgerloom.params import ReconParams
from ledgerloom.plans import balances as ba
from ledgerloom.plans import journal as jo

P = ReconParams(dt.date(2024, 2, 1), dt.date(2024, 2, 5), dt.date(2024, 1, 1), dt.date(2024, 1, 31),
                special_receipts={"2024-02-02": Decimal("30.25")}, opening_balances={"104171": Decimal(100), "112002": Decimal(40)},
                special_entries={"2024-02-03": [{"account_no": "104171", "transaction_type": "other", "amount": 5, "account_desc": "given"}],
                                 "2024-03-03": [{"account_no": "104171", "transaction_type": "other", "amount": 5}]})


@pytest.fixture(scope="module")
def wide(spark):
    day = F.dayofmonth("Date").cast("decimal(18,2)")
    wp = date_spine(spark, P.beg, P.end).select("Date", (day * 2).alias("remittance_fee"), (day * 100).alias("Inbound"), (day * 3).alias("Unsuccessful_ACH"),
                                                (-day * 40).alias("Outbound"), (day * 7).alias("handing_fee"))
    interest = date_spine(spark, P.beg, P.end).where("Date <> DATE '2024-02-04'").select("Date", (day * 10).alias("interest"))
    rebate = date_spine(spark, P.beg, P.end).select("Date", day.alias("amount"))
    return jo.journal_wide(wp, interest, rebate, literal_amounts(spark, P.special_receipts, P.beg, P.end), P)


def test_each_day_nets_to_zero(wide):
    r = jo.day_balance(wide).first()
    assert (r["is_balanced"], float(r["daily_max_diff"]), r["unbalanced_days"]) == (True, 0.0, 0)


def test_missing_day_of_a_series_counts_as_zero(wide):
    got = {r["Date"].day: r["acc_440001_interest"] for r in wide.collect()}
    assert got[4] == 0 and got[5] == -50


def test_daily_lines_sum_to_the_wide_table(spark, wide):
    journal = jo.full_journal(wide, P)
    daily = journal.where("accounting_date IS NOT NULL AND account_desc <> 'given'")
    assert daily.count() == 5 * 17 and daily.agg(F.sum("amount")).first()[0] == 0


def test_special_lines_only_for_days_in_the_data(wide):
    got = jo.full_journal(wide, P).where("account_desc = 'given'").collect()
    assert [(r["accounting_date"], r["amount"], r["period"]) for r in got] == [("2024/02/03", Decimal(5), "2024-02")]
    with pytest.raises(ValueError, match="amount"):
        jo.special_lines(wide, P.with_(special_entries={"2024-02-01": [{"account_no": "1", "transaction_type": "x"}]}))


def test_period_end_lines(spark):
    lines = jo.period_end_lines(spark, P)
    got = {(r["account_no"], r["transaction_type"], r["desc_key"]): r["amount"] for r in lines.collect()}
    assert lines.count() == 28
    assert got["112002", "發票已開立沖轉", None] == -40 and got["104171", "期初數", None] == 100
    assert got["200701", "spt", None] == 0


def test_undated_lines_come_last_and_labels(wide):
    out = jo.full_journal(wide, P).collect()
    dates = [r["accounting_date"] for r in out]
    assert dates == sorted([d for d in dates if d]) + [None] * dates.count(None)
    labels = {r["transaction_type"] for r in jo.labelled(jo.full_journal(wide, P)).select("transaction_type").distinct().collect()}
    assert "00.期初數" in labels and "05.other_利息" in labels


def test_descriptions(spark):
    rows = spark.createDataFrame([("104171", None), ("104171", "any"), ("530006", "COD匯費"), ("530006", None), ("000", None)], "account_no string, desc_key string")
    keyed = rows.withColumn("i", F.monotonically_increasing_id())
    got = [r["account_desc"] for r in jo.with_descriptions(keyed, jo.account_table(spark)).orderBy("i").collect()]
    assert got == ["Escrow bank", "Escrow bank", "Bank transaction fee - COD remittance", "", ""]


def test_pivot_margins_agree(wide):
    lines = jo.labelled(jo.full_journal(wide, P))
    pivot = jo.journal_pivot(lines, jo.period_dates(P))
    total = pivot.where("account_no = 'Total'").first()
    assert total["Total"] == lines.agg(F.sum("amount")).first()[0]
    assert total["2024/02/03"] == 5


def test_text_amounts_in_the_running_balance(spark):
    df = spark.createDataFrame([("d1", "1,000", 1500.0), ("d2", "-", 1400.0), ("d3", " ", 0.0), ("d4", None, 1500.0), ("d5", "-500.5", None)],
                               "accounting_date string, daily_movement string, balance_dfr double")
    out = jo.text_balance(df, 500).orderBy("accounting_date").collect()
    assert [float(r["balance_entry"]) for r in out] == [1500.0, 1500.0, 1500.0, 1500.0, 999.5]
    assert [r["check_pct"] for r in out] == [0.0, -7.14, None, 0.0, None]


def test_ending_balance_pattern(spark):
    df = spark.createDataFrame([("101150", "a", Decimal("1.9"), "p"), ("530006", "b", Decimal(3), "p"), ("530026", "c", Decimal(4), "p"), ("200208", "d", Decimal("-2.9"), "p")],
                               "account_no string, account_desc string, amount decimal(18,2), period string")
    assert {r["account_no"]: r["amount"] for r in jo.ending_balance(df).collect()} == {"101150": 1, "530026": 4, "200208": -2}
    assert {r["account_no"] for r in jo.ending_balance(df, "^[12]").collect()} == {"101150", "200208"}


def test_offline_transfer_may_count_once(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 1), 10, 4), (dt.date(2024, 2, 2), 20, 0)], "Date date, Inbound int, offline_transfer int")
    opening = spark.range(1).select(F.lit(100).alias("b"))
    both = [r["running_balance"] for r in ba.with_running_balance(df, opening).orderBy("Date").collect()]
    single = [r["running_balance"] for r in ba.with_running_balance(df, opening, ("Inbound",)).orderBy("Date").collect()]
    assert both == [114, 134] and single == [110, 130]


def test_abnormal_amounts_are_listed(wide):
    journal = jo.full_journal(wide, P.with_(opening_balances={"200208_debit": Decimal("2000000000000")}))
    assert [(r["account_no"], r["amount"]) for r in jo.abnormal_lines(journal).collect()] == [("200208", Decimal("2000000000000"))]
    assert jo.journal_validation(journal).first()["abnormal_amounts"] == 1
    assert jo.journal_validation(journal.drop("period")).first()["missing_columns"] == "period"


def test_zero_lines_may_be_skipped(wide):
    kept = jo.full_journal(wide, P.with_(skip_zero_amount=True))
    assert kept.where("amount = 0").count() == 0 and kept.count() > 0


def test_the_first_opening_row_counts_and_a_missing_one_is_an_error(spark):
    import datetime as dt

    import pytest

    from ledgerloom.plans import journal as jo

    schema = "accounting_date string, transaction_type string, account_no string, amount decimal(28,4), n int"
    make = lambda rows: spark.createDataFrame([(d, t, "104171", __import__("decimal").Decimal(a), n) for d, t, a, n in rows], schema)
    daily = spark.createDataFrame([(dt.date(2024, 1, 1), __import__("decimal").Decimal(130))], "Date date, balance decimal(28,4)")
    moves = [("2024/01/01", "01.x", 10, 3)]
    opened = make([("2024/01/02", "00.期初數", 900, 1), ("2024/01/01", "00.期初數", 120, 2), *moves])
    assert [float(r.balance_entry) for r in jo.ledger_check(opened, daily).collect()] == [130.0]
    assert [float(r.balance_entry) for r in jo.ledger_check(opened, daily, order=("n",)).collect()] == [910.0]
    with pytest.raises(Exception, match="no opening row"):
        jo.ledger_check(make(moves), daily).collect()
