"""Pivot, unpivot, tie-out and fee invariants."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins as jn
from ledgerloom.operators import pivots as pv
from ledgerloom.operators.tieout import check_status, difference_summary, tie_out
from ledgerloom.params import ReconParams
from ledgerloom.plans import fees as fe
from ledgerloom.plans import trust as tr

P = ReconParams(dt.date(2024, 2, 1), dt.date(2024, 2, 29), dt.date(2024, 1, 1), dt.date(2024, 1, 31))


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(5)
    data = [(rng.choice("abc") if i % 11 else None, rng.choice(["x", "y's", 'z"']) if i % 13 else None, rng.randint(-50, 50) if i % 7 else None)
            for i in range(400)]
    return spark.createDataFrame(data, "r string, c string, v int")


def test_margins_equal_direct_sums(facts):
    out = {r["r"]: r.asDict() for r in pv.pivot_with_margins(facts, ["r"], "c", "v", ["x", "y's", 'z"']).collect()}
    keyed = [(r["r"], r["c"], r["v"] or 0) for r in facts.collect() if r["r"] and r["c"]]
    for r in "abc":
        for c in ("x", "y's", 'z"'):
            assert out[r][c] == sum(v for a, b, v in keyed if a == r and b == c)
        assert out[r]["Grand Total"] == sum(v for a, _, v in keyed if a == r)
    assert out["Grand Total"]["Grand Total"] == sum(v for _, _, v in keyed)


def test_pivot_then_unpivot_is_the_aggregate(facts, rows):
    values = ["x", "y's", 'z"']
    wide = pv.pivot_with_margins(facts, ["r"], "c", "v", values).where("r <> 'Grand Total'").drop("Grand Total")
    back = pv.unpivot_columns(wide, ["r"], values, "c", "v")
    direct = facts.where("r IS NOT NULL AND c IS NOT NULL").groupBy("r", "c").agg(F.coalesce(F.sum("v"), F.lit(0)).cast("decimal(28,4)").alias("v"))
    assert rows(back) == rows(direct)


def test_post_applies_after_the_margins(spark):
    df = spark.createDataFrame([("d1", "b", -5), ("d2", "b", 3)], "d string, b string, v int")
    out = {r["d"]: r["b"] for r in pv.pivot_with_margins(df, ["d"], "b", "v", ["b"], post=F.abs).collect()}
    assert out == {"d1": 5, "d2": 3, "Grand Total": 2}


def test_pivot_without_fill_keeps_gaps(spark):
    df = spark.createDataFrame([("d1", "b", 1), ("d2", "c", 2)], "d string, b string, v int")
    out = {r["d"]: (r["b"], r["c"]) for r in pv.pivot_with_margins(df, ["d"], "b", "v", ["b", "c"], fill=None).collect()}
    assert out["d1"] == (1, None) and out["Grand Total"] == (1, 2)


def test_empty_pivot_has_no_total_row(spark):
    df = spark.createDataFrame([], "d string, b string, v int")
    assert pv.pivot_with_margins(df, ["d"], "b", "v", ["b"]).count() == 0


def test_long_margins_hold_any_number_of_columns(spark):
    df = spark.range(12_000).select(F.expr("concat('r', id % 3)").alias("r"), F.col("id").alias("c"), F.lit(2).alias("v"))
    out = pv.long_margins(df, ["r"], "c", "v")
    assert out.count() == 2 * 12_000 + 3 + 1
    totals = {r["r"]: r["v"] for r in out.where("c = 'Grand Total'").collect()}
    assert totals == {"r0": 8_000, "r1": 8_000, "r2": 8_000, "Grand Total": 24_000}
    assert pv.long_margins(df.limit(0), ["r"], "c", "v").count() == 0


def test_tie_out_with_itself_is_zero(spark):
    df = spark.createDataFrame([("a", Decimal("1.50")), ("b", Decimal("2.00"))], "k string, v decimal(18,2)")
    out = tie_out(df, df, ["k"], "v").collect()
    assert all(r["diff"] == 0 and r["ok"] for r in out) and len(out) == 2


def test_tie_out_shows_one_sided_keys(spark):
    left = spark.createDataFrame([("a", 10), ("b", 5)], "k string, v int")
    right = spark.createDataFrame([("a", 12), ("c", 1)], "k string, v int")
    out = {r["k"]: (r["left_amount"], r["right_amount"], r["diff"], r["ok"]) for r in tie_out(left, right, ["k"], "v").collect()}
    assert out == {"a": (10, 12, -2, False), "b": (5, None, None, False), "c": (None, 1, None, False)}
    status = check_status(tie_out(left, right, ["k"], "v"), "item").first()
    assert (status["status"], status["n_off"], status["n_unmatched"]) == ("有差異", 1, 2)


def test_difference_summary_counts_unknown_as_different(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 3.0), (None, None)], "d double, p double")
    r = difference_summary(df, "d", "p").first()
    assert (r["n_rows"], r["n_equal"], r["n_different"], r["max_abs_diff"], r["mean_abs_diff"], r["n_over_tolerance"]) == (3, 1, 2, 2.0, 1.0, 1)


def test_merge_matches_missing_keys_and_suffixes(spark, rows):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([(None, 9), ("b", 8)], "k string, v int")
    out = jn.merge(left, right, on=["k"], how="outer")
    assert out.columns == ["k", "v", "v_aux"]
    assert rows(out) == [("a", 1, None), ("b", None, 8), (None, 2, 9)]
    other = jn.merge(left, right.withColumnRenamed("k", "key"), left_on=["k"], right_on=["key"], how="inner")
    assert other.columns == ["k", "v", "key", "v_aux"] and other.count() == 1


def test_add_aggregates_equals_outer_merge(spark, rows):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("y", 5), ("z", None)], "k string, v int")
    assert rows(jn.add_aggregates(a, b, ["k"], ["v"])) == [("x", 1), ("y", 7), ("z", 0)]


def test_spine_keeps_every_day_and_last_entry(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2024, 2, 2), 5, 1), (d(2024, 2, 2), 7, 2), (d(2024, 3, 9), 1, 3)], "day date, amt int, seq int")
    out = {r["Date"]: r["amount"] for r in jn.sparse_to_spine(df, "day", "amt", "seq", d(2024, 2, 1), d(2024, 2, 3)).collect()}
    assert out == {d(2024, 2, 1): 0, d(2024, 2, 2): 7, d(2024, 2, 3): 0}


def matrix(spark, value=100):
    cells = [(t, b, Decimal(value * (i + 1)), Decimal(i + 1)) for i, t in enumerate(["normal", "3期", "6期", "12期", "24期"])
             for b in ["台新", "NCCC", "國泰", "CTBC", "聯邦"]]
    df = spark.createDataFrame(cells, "transaction_type string, bank string, total_claimed decimal(24,4), total_service_fee decimal(24,4)")
    return pv.add_subtotal(df, "transaction_type", "小計", ["bank"], tr.MEASURES)


def test_subtotal_is_the_sum_of_terms(spark):
    out = {(r["transaction_type"], r["bank"]): r["total_claimed"] for r in matrix(spark).collect()}
    assert out["小計", "台新"] == 1500 and len(out) == 30


def test_adjustment_goes_to_the_row_of_the_bank(spark):
    out = {(r["transaction_type"], r["bank"]): r["total_claimed"]
           for r in fe.apply_claimed_adjustments(matrix(spark), {"NCCC": Decimal(7), "國泰": Decimal(-3)}).collect()}
    assert out["3期", "NCCC"] == 207 and out["normal", "NCCC"] == 100 and out["小計", "NCCC"] == 1507
    assert out["normal", "國泰"] == 97 and out["小計", "國泰"] == 1497 and out["小計", "台新"] == 1500


def test_commission_subtotal_is_not_counted_twice(spark):
    once = {r["transaction_type"]: r["commission_fee"] for r in fe.commission_by_term(matrix(spark), P).collect()}
    twice = {r["transaction_type"]: r["commission_fee"] for r in fe.commission_by_term(matrix(spark), P, True).collect()}
    terms = sum(v for t, v in once.items() if t != "小計")
    assert once["小計"] == terms and twice["小計"] == terms + 139  # 7500 * 0.0185 = 138.75


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(Decimal("10.5"),), (Decimal("11.5"),), (Decimal("-2.5"),)], "f decimal(24,4)")
    p = P.with_(tax_rate=Decimal(0))
    assert [int(r["o"]) for r in fe.with_tax(df, p, "f", "o").collect()] == [10, 12, -2]


def test_wide_and_long_matrix_round_trip(spark, rows):
    m = matrix(spark)
    back = tr.matrix_from_wide(tr.trust_wide(m)).where("metric = 'total_claimed'").select("transaction_type", "bank", F.col("amount").cast("decimal(24,4)"))
    assert rows(back) == rows(m.select("transaction_type", "bank", F.col("total_claimed").cast("decimal(24,4)")))
    assert [c for c in tr.trust_wide(m, claimed_only=True).columns if "service" in c] == []


def test_fee_pipeline_hangs_together(spark, sf_dir):
    from ledgerloom.registry.q_fees import END, pipeline_of

    results = pipeline_of(spark, sf_dir)
    long = results["apcc_summary_long"].collect()
    assert len(long) == 60 and {r["period"] for r in long} == {END}
    report = {r["transaction_type"]: r.asDict() for r in results["payment_report"].collect()}
    terms = [v for k, v in report.items() if k.startswith(("Non-", "Installment"))]
    assert len(report) == 8 and report["小計"]["Total Transaction"] == pytest.approx(sum(t["Total Transaction"] for t in terms))
    shares = [report["Percentage"][b] for b in ("TSB", "NCCC", "Cathay", "CTBC", "UBOT")]
    assert sum(shares) == pytest.approx(1.0) and report["OCP"]["TSB"] is None
    assert results["apcc_acquiring_charge_DW"].columns[-1] == "end_date"
