"""Daily results to balanced double-entry journal lines, and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.masks import matches
from ledgerloom.functions.scalars import half_even, recode
from ledgerloom.operators.joins import date_spine
from ledgerloom.operators.literals import literal_table
from ledgerloom.operators.pivots import pivot_with_margins, row_total, unpivot_columns
from ledgerloom.operators.rowwise import running_balance
from ledgerloom.operators.tieout import difference_summary
from ledgerloom.params import ReconParams
from ledgerloom.session import settle
from ledgerloom.reference_data import (
    ACCOUNTS, ENTRY_MAPPING, MOVEMENT_TYPES, PERIOD_END_LABEL, PERIOD_END_LINES, TYPE_LABELS, ZERO_CHECK_EXCLUDED,
)

AMOUNT = "decimal(28,4)"
JOURNAL = ["accounting_date", "transaction_type", "account_no", "account_desc", "amount", "period"]
DAY_TEXT = "yyyy/MM/dd"


def account_table(spark: SparkSession, accounts=None) -> DataFrame:
    return literal_table(spark, accounts or ACCOUNTS, "account_no string, desc_key string, account_desc string")


def mapping_table(spark: SparkSession, mapping=None) -> DataFrame:
    ddl = "column string, account_no string, transaction_type string, desc_key string"
    return literal_table(spark, mapping or ENTRY_MAPPING, ddl)


def with_descriptions(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Description by account, or by account and key; an unknown pair reads as empty text.

    An account with one description has it whatever the key.
    """
    plain = accounts.where(F.col("desc_key").isNull()).select("account_no", F.col("account_desc").alias("_plain"))
    keyed = accounts.where(F.col("desc_key").isNotNull()).select("account_no", "desc_key", F.col("account_desc").alias("_keyed"))
    return (
        rows.join(plain, "account_no", "left")
        .join(keyed, ["account_no", "desc_key"], "left")
        .withColumn("account_desc", F.coalesce(F.col("_plain"), F.col("_keyed"), F.lit("")))
        .drop("_plain", "_keyed", "desc_key")
    )


def journal_wide(workpaper: DataFrame, interest: DataFrame, rebate: DataFrame, receipts: DataFrame, p: ReconParams) -> DataFrame:
    """One row per day with the account columns; paired columns make each day net to zero.

    The series are joined on the day; a day that a series lacks counts as zero.
    """
    spine = date_spine(workpaper.sparkSession, p.beg, p.end)
    days = (
        spine.join(workpaper, "Date", "left")
        .join(interest.select("Date", F.col("interest").alias("_interest")), "Date", "left")
        .join(rebate.select("Date", F.col("amount").alias("_rebate")), "Date", "left")
        .join(receipts.select("Date", F.col("amount").alias("_receipt")), "Date", "left")
    )

    taken = {"rem": "remittance_fee", "inb": "Inbound", "ach": "Unsuccessful_ACH", "outb": "Outbound", "fee": "handing_fee",
             "i": "_interest", "reb": "_rebate", "spt": "_receipt"}
    series = days.selectExpr("Date", *[f"CAST(coalesce({c}, 0) AS {AMOUNT}) AS {n}" for n, c in taken.items()])
    behalf = "fee + inb - rem - reb - spt"
    columns = {
        "acc_101150_Received_CTBC_SPT": "-spt",
        "acc_104171_內扣CTBCCC匯費": "rem",
        "acc_104171_ReceivedCTBCSPT": "inb - rem - reb",
        "acc_104171_ReceivedCTBCSPT退匯": "ach",
        "acc_104171_OutCTBCSPT": "outb + i * 0.1",
        "acc_104171_others": "reb",
        "acc_999995_others": "-reb",
        "acc_530006_內扣CTBCCC匯費": "-rem",
        "acc_530006_收單_SPE": "fee",
        "acc_200701_ReceivedCTBCSPT退匯": "-ach",
        "acc_200701_OutCTBCSPT": "-outb - i * 0.1",
        "acc_440001_interest": "-i",
        "acc_104171_others_利息": "i * 0.9",
        "acc_111302_interest": "i * 0.1",
        "acc_200208_ReceivedCTBCSPT_positive": behalf,
        "acc_200208_ReceivedCTBCSPT_negative": f"-({behalf})",
        "acc_200701_ReceivedCTBCSPT_negative": f"-({behalf})",
    }
    return series.selectExpr("Date", *[f"CAST({c} AS {AMOUNT}) AS `{n}`" for n, c in columns.items()])


def day_balance(wide: DataFrame) -> DataFrame:
    """Debit/credit balance: total, largest day, days off by one or more."""
    day = row_total([c for c in wide.columns if c.startswith("acc_")])
    return wide.select(day.alias("_day")).agg(
        (F.abs(F.sum("_day")) < 1).alias("is_balanced"),
        F.sum("_day").alias("total_diff"),
        F.max(F.abs("_day")).alias("daily_max_diff"),
        F.count_if(F.abs("_day") >= 1).alias("unbalanced_days"),
    )


LINE = ["accounting_date", "transaction_type", "account_no", "desc_key", "given_desc", "amount", "period"]


def daily_lines(wide: DataFrame, mapping: DataFrame, columns: list[str], date: str = "Date") -> DataFrame:
    """Account columns to lines by the mapping table; one column may feed several lines."""
    long = unpivot_columns(wide, [date], columns, "column", "amount", "decimal(28,4)")
    return long.join(mapping, "column", "inner").select(
        F.date_format(date, DAY_TEXT).alias("accounting_date"),
        "transaction_type",
        "account_no",
        "desc_key",
        F.lit(None).cast("string").alias("given_desc"),
        F.coalesce(F.col("amount"), F.lit(0)).cast(AMOUNT).alias("amount"),
        F.date_format(date, "yyyy-MM").alias("period"),
    )


def described(lines: DataFrame, accounts: DataFrame) -> DataFrame:
    """Journal rows: a description given with the line goes before the one of its account."""
    named = with_descriptions(lines, accounts)
    return named.withColumn("account_desc", F.coalesce("given_desc", "account_desc")).select(*JOURNAL)


def to_journal(wide: DataFrame, mapping: DataFrame, accounts: DataFrame, columns: list[str], date: str = "Date") -> DataFrame:
    """Wide account columns to journal rows."""
    return described(daily_lines(wide, mapping, columns, date), accounts)


def special_lines(wide: DataFrame, p: ReconParams, date: str = "Date") -> DataFrame:
    """Lines set for single dates, kept if the date is in the data."""
    rows = []
    for day, entries in p.special_entries.items():
        for e in entries:
            lacking = [k for k in ("account_no", "transaction_type", "amount") if k not in e]
            if lacking:
                raise ValueError(f"special entry of {day} lacks {lacking}")
            rows.append((day, e["transaction_type"], e["account_no"], e.get("desc_key"), e.get("account_desc"), str(e["amount"])))
    ddl = "day string, transaction_type string, account_no string, desc_key string, given_desc string, amount string"
    given = literal_table(wide.sparkSession, rows, ddl)
    present = wide.select(F.date_format(date, "yyyy-MM-dd").alias("day")).distinct()
    return given.join(present, "day", "left_semi").select(
        F.replace("day", F.lit("-"), F.lit("/")).alias("accounting_date"),
        "transaction_type",
        "account_no",
        "desc_key",
        "given_desc",
        F.col("amount").cast(AMOUNT).alias("amount"),
        F.lit(p.period).alias("period"),
    )


def allowance_of_month(documents: DataFrame, p: ReconParams) -> DataFrame:
    """Tax and negated gross of the last document numbered as this month's allowance total."""
    pattern = f"{p.beg:%Y/%m}.*折讓總計"
    return documents.where(F.col("doc_no").rlike(pattern)).agg(
        F.max_by("vat", "seq").alias("vat"), (-F.max_by("gross", "seq")).alias("neg_gross")
    )


def service_fee_of_month(documents: DataFrame, p: ReconParams) -> DataFrame:
    """Gross of the last invoice-numbered document whose date text holds the year and the month."""
    day = F.col("issued").cast("string")
    hit = day.contains(f"{p.beg:%m}") & F.col("doc_no").rlike("[A-Z][A-Z]\\d{8}") & day.contains(f"{p.beg:%Y}")
    return documents.where(hit).agg(F.max_by("gross", "seq").alias("gross"))


def period_end_lines(
    spark: SparkSession, p: ReconParams, commission: DataFrame | None = None, documents: DataFrame | None = None
) -> DataFrame:
    """Month-end lines: opening balances, reversals, fees and rebates; they carry no date.

    ``commission`` is a one-row table with the commission of the period, ``documents`` the fee
    documents; both enter as scalar subqueries.
    """
    fixed = {
        **p.opening_balances,
        "112002_reversal": p.reversal_amounts.get("112002_reversal", -p.opening_balances.get("112002", 0)),
        "ach": p.ach_expense,
        "cod": p.cod_remittance_fee,
        "rebate": p.ctbc_rebate,
        "cod_less_rebate": p.cod_remittance_fee - p.ctbc_rebate,
    }
    rows = [(acc, kind, key, str(sign * fixed.get(part, 0)), *factors)
            for acc, kind, key, part, sign, *factors in PERIOD_END_LINES]
    ddl = ("account_no string, transaction_type string, desc_key string, fixed string, "
           "f_vat int, f_gross int, f_service int, f_commission int")
    lines = literal_table(spark, rows, ddl)

    def scalar(df: DataFrame | None, col: str) -> Column:
        zero = F.lit(0).cast(AMOUNT)
        return F.coalesce(df.select(F.col(col).cast(AMOUNT)).scalar(), zero) if df is not None else zero

    allowance = allowance_of_month(documents, p) if documents is not None else None
    service = service_fee_of_month(documents, p) if documents is not None else None
    amount = (
        F.col("fixed").cast(AMOUNT)
        + F.col("f_vat") * scalar(allowance, "vat")
        + F.col("f_gross") * scalar(allowance, "neg_gross")
        + F.col("f_service") * scalar(service, "gross")
        + F.col("f_commission") * scalar(commission, commission.columns[0] if commission is not None else "")
    )
    none = F.lit(None).cast("string")
    return lines.withColumns(
        {"amount": amount.cast(AMOUNT), "accounting_date": none, "given_desc": none, "period": F.lit(p.period)}
    ).select(*LINE)


def apply_rules(journal: DataFrame, p: ReconParams) -> DataFrame:
    """Drop zero lines if set, and round."""
    kept = journal.where(F.col("amount") != 0) if p.skip_zero_amount else journal
    return kept.withColumn("amount", half_even(F.col("amount"), p.amount_places))


def sorted_journal(journal: DataFrame) -> DataFrame:
    """By date and account, undated lines last."""
    return journal.orderBy(F.asc_nulls_last("accounting_date"), F.asc_nulls_last("account_no"))


def journal_rows(wide: DataFrame, p: ReconParams, commission: DataFrame | None = None, documents: DataFrame | None = None) -> DataFrame:
    """Daily, special and period-end lines together, described and rounded."""
    spark = wide.sparkSession
    columns = list(dict.fromkeys(m[0] for m in ENTRY_MAPPING))
    lines = (
        daily_lines(wide, mapping_table(spark), columns)
        .unionByName(special_lines(wide, p))
        .unionByName(period_end_lines(spark, p, commission, documents))
    )
    return apply_rules(described(lines, account_table(spark)), p)


def full_journal(wide: DataFrame, p: ReconParams, commission: DataFrame | None = None, documents: DataFrame | None = None) -> DataFrame:
    return sorted_journal(journal_rows(wide, p, commission, documents))


def labelled(journal: DataFrame) -> DataFrame:
    """Ordered type labels, and a label for lines without a date."""
    return journal.withColumns(
        {
            "transaction_type": recode(F.col("transaction_type"), TYPE_LABELS),
            "accounting_date": F.coalesce(F.col("accounting_date"), F.lit(PERIOD_END_LABEL)),
        }
    )


def period_dates(p: ReconParams) -> list[str]:
    days = (p.end - p.beg).days + 1
    return [(p.beg.fromordinal(p.beg.toordinal() + i)).strftime("%Y/%m/%d") for i in range(days)] + [PERIOD_END_LABEL]


def journal_pivot(lines: DataFrame, dates: list[str] | None = None) -> DataFrame:
    """Account, description and type by date with totals; empty cells stay empty."""
    return pivot_with_margins(
        lines, ["account_no", "account_desc", "transaction_type"], "accounting_date", "amount", dates, "Total", fill=None
    )


def type_pivot(lines: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Date by type with totals, without the types that need not net to zero."""
    kept = lines.where(~F.col("transaction_type").isin(*ZERO_CHECK_EXCLUDED))
    shown = types or [t for t in dict.fromkeys(TYPE_LABELS.values()) if t not in ZERO_CHECK_EXCLUDED]
    return pivot_with_margins(kept, ["accounting_date"], "transaction_type", "amount", shown, "Total", fill=None)


def ending_balance(journal: DataFrame, pattern: str = "^1|2") -> DataFrame:
    """Ending balance of the accounts whose number matches ``pattern``, in whole units."""
    return journal.where(matches(F.col("account_no"), pattern)).groupBy("account_no").agg(
        F.lit(None).cast("string").alias("accounting_date"),
        F.lit("調整後期末餘額").alias("transaction_type"),
        F.max("account_desc").alias("account_desc"),
        F.sum("amount").cast("bigint").alias("amount"),
        F.min("period").alias("period"),
    )


def ledger_check(
    lines: DataFrame, daily: DataFrame, account_no: str = "104171", types: str = "0[1-5]", opening_type: str = "00.期初數",
    order: tuple[str, ...] = (),
) -> DataFrame:
    """Ledger movement of one account against the bank balance, joined on the day.

    The balance starts from the first opening row: by ``order``, columns that number the rows, else by date. Without an opening row the
    result is an error when it is read, since every balance after it would be wrong.
    """
    of_account = lines.where(F.col("account_no") == account_no)
    moved = of_account.where(matches(F.col("transaction_type"), types)).groupBy("accounting_date").agg(
        F.sum("amount").alias("daily_movement")
    )
    external = daily.select(
        F.date_format("Date", DAY_TEXT).alias("accounting_date"), F.col("balance").alias("balance_dfr")
    )
    missing = F.raise_error(F.lit(f"account {account_no} has no opening row of type {opening_type}")).cast(AMOUNT)
    first = F.min_by("amount", F.struct(*order)) if order else F.min_by("amount", "accounting_date")
    opening = of_account.where(F.col("transaction_type") == opening_type).agg(F.coalesce(first, F.max("amount"), missing).alias("opening"))
    return text_balance(moved.join(external, "accounting_date", "left"), opening.scalar())


def text_balance(daily: DataFrame, opening, movement: str = "daily_movement", order: str = "accounting_date") -> DataFrame:
    """Running balance from amounts that may be text (``-``, blanks, thousands commas count as zero),
    with the difference to the external balance and its percentage."""
    text = F.translate(F.trim(F.col(movement).cast("string")), ",", "")
    clean = daily.withColumn("_m", F.coalesce(text.try_cast(AMOUNT), F.lit(0).cast(AMOUNT)))
    out = running_balance(clean, "_m", order, opening=opening, out="balance_entry").drop("_m")
    check = F.col("balance_dfr") - F.col("balance_entry")
    pct = F.bround(F.try_divide(check.cast("double"), F.col("balance_dfr").cast("double")) * 100, 2)
    return out.withColumns({"check": check, "check_pct": pct}) if "balance_dfr" in daily.columns else out


def ledger_check_summary(checked: DataFrame, tolerance: float = 0.01) -> DataFrame:
    return difference_summary(checked, "check", "check_pct", tolerance)


def journal_report(journal: DataFrame, top: int = 10) -> DataFrame:
    """Counts and sums of a journal as (section, item, value) rows."""
    amount, moving = F.col("amount"), F.col("transaction_type").isin(*MOVEMENT_TYPES)
    num = lambda c: c.cast("double")
    totals = journal.agg(
        num(F.count(F.lit(1))).alias("lines"),
        num(F.countDistinct("account_no")).alias("accounts"),
        num(F.countDistinct("transaction_type")).alias("types"),
        num(F.sum(F.when(amount > 0, amount))).alias("debit"),
        num(F.sum(F.when(amount < 0, amount))).alias("credit"),
        num(F.sum(F.when((amount > 0) & moving, amount))).alias("movement_debit"),
        num(F.sum(F.when((amount < 0) & moving, amount))).alias("movement_credit"),
        num(F.max(amount)).alias("max"),
        num(F.min(amount)).alias("min"),
    )
    overview = totals.unpivot([], totals.columns, "item", "value").withColumn("section", F.lit("totals"))
    types = journal.groupBy(F.col("transaction_type").alias("item")).agg(num(F.count(F.lit(1))).alias("value")).withColumn(
        "section", F.lit("types")
    )
    accounts = (
        journal.groupBy(F.col("account_no").alias("item")).agg(num(F.count(F.lit(1))).alias("value"))
        .orderBy(F.desc("value"), "item").limit(top).withColumn("section", F.lit("top_accounts"))
    )
    movement = journal.where(moving).groupBy(F.col("account_no").alias("item")).agg(
        num(F.sum("amount").cast("bigint")).alias("value")
    ).withColumn("section", F.lit("movement"))
    return overview.unionByName(types).unionByName(accounts).unionByName(movement).select("section", "item", "value")


def journal_validation(journal: DataFrame, limit: float = 1e12) -> DataFrame:
    """One row: missing columns, amount type, missing keys, amounts of abnormal size."""
    missing = [c for c in JOURNAL if c not in journal.columns]
    kind = dict(journal.dtypes).get("amount", "")
    numeric = kind.startswith("decimal") or kind in ("double", "bigint")
    keys = [c for c in ("transaction_type", "account_no", "amount") if c in journal.columns]
    return journal.agg(
        F.lit(",".join(missing)).alias("missing_columns"),
        F.lit(numeric).alias("amount_is_numeric"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in keys],
        F.count_if(F.abs(F.col("amount")) > limit).alias("abnormal_amounts"),
    )


def abnormal_lines(journal: DataFrame, limit: float = 1e12) -> DataFrame:
    return journal.where(F.abs(F.col("amount")) > limit).select("accounting_date", "account_no", "amount")


def journal_step(
    workpaper: DataFrame, daily: DataFrame, rebate: DataFrame, receipts: DataFrame, p: ReconParams,
    commission: DataFrame | None = None, documents: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All journal results of a period; the daily lines and the journal are written once."""
    wide = settle(journal_wide(workpaper, daily, rebate, receipts, p), "entry_temp")
    journal = settle(journal_rows(wide, p, commission, documents), "entry_long")
    lines = labelled(journal)
    check = ledger_check(lines, daily)
    return {
        "entry_temp": wide,
        "entry_validation": day_balance(wide),
        "entry_long": sorted_journal(journal),
        "entry_long_temp": lines,
        "entry_report": journal_report(journal),
        "entry_checks": journal_validation(journal),
        "dfr_balance_check": check,
        "dfr_balance_summary": ledger_check_summary(check),
        "category_validation": type_pivot(lines),
        "big_entry": journal_pivot(lines, period_dates(p)),
        "ending_balance": ending_balance(journal),
    }
