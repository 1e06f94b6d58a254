"""Casts, column mapping, silver pass, breaker, reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import masks, scalars as sc
from ledgerloom.functions.text import literal
from ledgerloom.operators import quality as qu
from ledgerloom.operators import shaping as sh
from ledgerloom.sources import writers as wr


def one(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_integer_cast(spark):
    got = one(spark, sc.to_integer, ["1,234", " $5 ", "12元", "12.9", "-7", "-", "N/A", "", None, "abc", "NT$5", "99999999999999999999", "1e3"])
    assert got == [1234, 5, 12, 12, -7, None, None, None, None, None, None, None, 1000]


def test_number_cast(spark):
    got = one(spark, sc.to_number, ["1,234.5", "5%", " 12.5% ", "$3", "nan", "NaN", "-", "x", None, "-2"])
    assert got == [1234.5, 0.05, 0.125, 3.0, None, None, None, None, None, -2.0]


def test_date_cast(spark):
    got = one(spark, sc.to_date, ["2024-01-05", "2024/1/5", "20240105", "01/05/2024", " 2024.01.05 ", "2024-01-05 10:30:00", "2024-13-01", "12345", "nan", None])
    day = dt.date(2024, 1, 5)
    assert got == [day, day, day, day, day, day, None, None, None, None]


def test_date_cast_by_format(spark):
    assert one(spark, lambda c: sc.to_date(c, "%d/%m/%Y"), ["05/01/2024", "2024-01-05", "99/99/2024"]) == [dt.date(2024, 1, 5), None, None]
    assert one(spark, lambda c: sc.to_date(c, "%Y.%m.%d"), ["2024.01.05", "2024x01x05"]) == [dt.date(2024, 1, 5), None]


def test_timestamp_cast(spark):
    got = one(spark, sc.to_timestamp, ["2024-01-05 10:30:15", "2024/01/05 10:30", "20240105", "x"])
    assert got == [dt.datetime(2024, 1, 5, 10, 30, 15), dt.datetime(2024, 1, 5, 10, 30), dt.datetime(2024, 1, 5), None]


def test_boolean_cast(spark):
    assert one(spark, sc.to_boolean, ["YES", " t ", "有", "0", "無", "maybe", None]) == [True, True, True, False, False, None, None]


def test_format_and_ratio(spark):
    df = spark.createDataFrame([(1234567.0, 0.0), (None, 2.0)], "a double, b double")
    got = df.select(sc.grouped_digits(F.col("a")).alias("t"), sc.ratio(F.col("b"), F.col("a"), 0).alias("r"), sc.ratio(F.col("a"), F.col("b")).alias("n")).collect()
    assert [tuple(r) for r in got] == [("1,234,567", 0.0, None), ("N/A", 0.0, None)]


def test_recode_and_literals(spark):
    got = one(spark, lambda c: sc.recode(c, {"a'b": "it's", "x\\y": "back"}), ["a'b", "x\\y", "other", None])
    assert got == ["it's", "back", "other", None]
    assert one(spark, lambda c: sc.known_or(c, ["a"], "normal"), ["a", "b", None]) == ["a", "normal", "normal"]
    assert literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'" and literal(None) == "NULL" and literal(True) == "true"


def test_masks_never_give_null(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2024, 2, 1),), (None,)], "d date")
    beg, end = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
    got = df.select(masks.in_period(F.col("d"), beg, end).alias("p"), (~masks.in_period(F.col("d"), beg, end)).alias("n"),
                    masks.in_month(F.col("d"), beg).alias("m")).collect()
    assert [tuple(r) for r in got] == [(True, False, True), (False, True, False), (False, True, False)]


def test_column_match_order():
    cols = ["Amount", "amount", "交易金額(元)", "x"]
    assert sh.match_column(cols, "amount") == "amount"
    assert sh.match_column(cols, "AMOUNT") == "Amount"
    assert sh.match_column(cols, ".*金額.*") == "交易金額(元)"
    assert sh.match_column(cols, "金額") is None
    assert sh.match_column(cols, "^x$") == "x" and sh.match_column(cols, "zz|yy") is None and sh.match_column(cols, "(.*") is None


def test_mapping_rules(spark):
    df = spark.createDataFrame([("1", "2", "m")], "a string, b string, _batch string")
    specs = [sh.ColumnSpec("a", "first"), sh.ColumnSpec("A", "second"), sh.ColumnSpec("nope", "third", default="d")]
    mapped = sh.apply_defaults(sh.map_columns(df, specs), specs)
    assert mapped.columns == ["second", "_batch", "third"] and mapped.first()["third"] == "d" or "first" in mapped.columns
    assert sh.map_columns(df, specs[:1], preserve_unmapped=True).columns == ["first", "b", "_batch"]
    with pytest.raises(sh.MissingColumnsError) as err:
        sh.map_columns(df, [sh.ColumnSpec("q", "q", required=True), sh.ColumnSpec("r", "r", required=True)])
    assert err.value.missing == ["q", "r"]
    with pytest.raises(ValueError):
        sh.ColumnSpec("a", "b", "DECIMAL")


def test_name_normalisation(spark):
    assert [sh.normal_name(n) for n in [" a  b ", "交易 日期(民國)", "__x__y__", "$$$", "請款\n月"]] == ["a_b", "交易_日期民國", "x_y", "unnamed", "請款_月"]
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "a_b", "A  b"])
    assert sh.normalize_names(df).columns == ["a_b", "a_b_2", "A_b_3"]


def test_positions_and_ranges(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["x", "y", "z"])
    assert sh.rename_by_position(df, ["a", "b"]).columns == ["a", "b", "z"]
    assert sh.rename_by_position(df, ["a", "b", "c", "d"]).columns == ["a", "b", "c"]
    assert sh.column_range(["a", "b", "c", "d"], "b", "c", ["d", "c", "q"]) == ["b", "c", "d"]
    assert sh.column_range(["a"], "a", "zz") == []
    report = {r["side"]: (r["valid"], r["missing"]) for r in sh.check_column_order(
        df, {"free": (["x", "y", "z"], True), "order": (["y", "x"], False), "gone": (["x", "q"], False)}).collect()}
    assert report == {"free": (True, ""), "order": (False, ""), "gone": (False, "q")}


def test_empty_rows_go(spark, rows):
    df = spark.createDataFrame([("", None, 1), (" ", 5, 2), ("x", None, 3), (None, None, 4)], "a string, b int, k int")
    assert rows(sh.drop_empty_rows(df, ["a", "b", "missing"]), "k") == [(2,), (3,)]


def test_breaker_trips_above_the_threshold_only(spark):
    df = spark.createDataFrame([(None, 1), (2, 1), (3, None), (4, None)], "a int, b int")
    assert qu.breaker(df, 0.25, columns=["a"]).ok
    result = qu.breaker(df, 0.25)
    assert not result.ok and result.tripped == {"b": 0.5}
    with pytest.raises(qu.BreakerError):
        qu.require_breaker(df, 0.3)
    empty = df.limit(0)
    assert qu.breaker(empty, 0.0).ok


def test_silver_counts_while_writing(spark, tmp_path):
    raw = spark.createDataFrame([("1", "2024-01-01"), ("x", "bad"), ("3", "2024-01-03")], "k string, d string")
    schema = sh.SchemaConfig([sh.ColumnSpec("k", "k", "BIGINT"), sh.ColumnSpec("d", "d", "DATE")], null_threshold=0.5)
    verdict = qu.write_silver(raw, schema, str(tmp_path / "v1"))
    wr.point_table(spark, "silver_published", str(tmp_path / "v1"))
    # the row with nothing readable is dropped, so no missing value is left
    assert verdict.ok and spark.table("silver_published").count() == 2
    tight = sh.SchemaConfig([sh.ColumnSpec("k", "k"), sh.ColumnSpec("d", "d", "DATE")], null_threshold=0.1)
    with pytest.raises(qu.BreakerError):
        qu.write_silver(raw, tight, str(tmp_path / "v2"))
    assert spark.table("silver_published").count() == 2
    qu.write_silver(raw.limit(1), schema, str(tmp_path / "v3"))
    wr.point_table(spark, "silver_published", str(tmp_path / "v3"))
    assert spark.table("silver_published").count() == 1


def test_dry_run_reports_missing(spark):
    df = spark.createDataFrame([("1",)], "a string")
    report = qu.silver_dry_run(df, sh.SchemaConfig([sh.ColumnSpec("b", "b", required=True)]))
    assert report == {"valid": False, "missing": ["b"], "breaker": None}
    assert qu.silver_dry_run(df, sh.SchemaConfig([sh.ColumnSpec("a", "a", "BIGINT")]))["valid"]


def test_conversion_is_all_or_nothing(spark, rows):
    df = spark.createDataFrame([("1,000",), (" ",), (None,)], "v string")
    assert rows(qu.clean_and_convert(df, "v", "bigint")) == [(1000,), (None,)] + [(None,)]
    with pytest.raises(ValueError, match="1 values of v"):
        qu.convert_column(spark.createDataFrame([("1",), ("q",)], "v string"), "v", "bigint")


def test_cleaning_runs_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("$1", "a"), ("x", "b")], "amount string, note string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("amount string, note string").parquet(str(tmp_path / "in"))
    specs = [sh.ColumnSpec("amount", "amount", "BIGINT"), sh.ColumnSpec("note", "note")]
    out = qu.silver(stream, sh.SchemaConfig(specs))
    run = out.writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "cp")).start()
    run.awaitTermination(120)
    got = {r["note"]: r["amount"] for r in spark.table("cleaned").collect()}
    assert got == {"a": 1, "b": None}


def test_table_validation_counts(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "x"), (None, "y")], "k int, s string")
    got = {(r["rule"], r["item"]): (r["severity"], r["failures"], r["ok"]) for r in qu.validate_table(
        df, ["k", "zz"], ["k"], ["s"], {"k positive": F.col("k") > 0}).collect()}
    assert got[("unique", "k")] == ("warning", 2, False) and got[("not_null", "s")] == ("error", 1, False)
    assert got[("required", "zz")] == ("error", 1, False) and got[("validator", "k positive")] == ("error", 2, False)


def test_previews_and_column_choice(spark, rows):
    df = spark.createDataFrame([("$1", 1), ("2", 2), (None, 3)], "amount_text string, bank_total_claimed int")
    assert rows(qu.clean_preview(df, "amount_text")) == [("$1", "1")]
    assert sh.select_matching(df, "claimed|type").columns == ["bank_total_claimed"]
    assert qu.value_frequency(df, "amount_text", 5, unique=False).count() == 2


def test_dates_in_the_first_of_several_formats(spark):
    from ledgerloom.functions.scalars import to_date

    df = spark.createDataFrame([("05.03.2024",), ("2024-03-05",), ("Mar 5 2024",), ("20240305",), ("5th of March",), (None,)], "t string")
    out = [r[0] for r in df.select(to_date(F.col("t"), ["dd.MM.yyyy", "yyyy-MM-dd", "MMM d yyyy", "yyyyMMdd"]).cast("string")).collect()]
    assert out == ["2024-03-05"] * 4 + [None, None]


def scans(df):
    """Scans of a plan after it has run, without those that another part of it reuses."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan")


def test_validation_reads_the_table_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 10 AS a", "id AS b", "nullif(id % 3, 0) AS c", "string(id % 7) AS d").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = qu.validate_table(df, ["a", "x"], ["a", "b", "c", "d"], ["c"], {"small": F.col("b") < 900})
    assert scans(report) == 1
    assert {(r["rule"], r["item"]): r["failures"] for r in report.collect()} == {
        ("required", "a"): 0, ("required", "x"): 1, ("not_null", "c"): 334, ("validator", "small"): 100, ("unique", "a"): 990, ("unique", "b"): 0, ("unique", "c"): 997, ("unique", "d"): 993,
    }
    assert scans(qu.integrity_profile(df, "t")) == 1
    assert [r.failures for r in qu.validate_table(df.limit(0), unique=["a"], not_null=["c"]).collect()] == [0, 0]
    assert {r.item: r.value for r in qu.integrity_profile(df.limit(0), "t").where("section <> 'type'").collect()} == {"t": "0", "a": "0", "b": "0", "c": "0", "d": "0"}


def test_failing_values_come_from_one_scan(spark, tmp_path):
    spark.range(1000).selectExpr("CASE WHEN id % 4 = 0 THEN 'bad' || lpad(id % 40, 2, '0') ELSE string(id) END AS a", "string(id) AS b", "if(id = 5, 'x', null) AS c").repartition(3).write.parquet(str(tmp_path / "t"))
    df = qu.lost_by_type(spark.read.parquet(str(tmp_path / "t")), {"a": "bigint", "b": "int", "c": "date"}, 3)
    assert scans(df) == 1
    got = {r["item"]: (r["invalid_count"], r["distinct_count"], [tuple(x) for x in r["samples"]]) for r in df.collect()}
    assert got == {"a": (250, 10, [("bad00", 25), ("bad04", 25), ("bad08", 25)]), "b": (0, 0, []), "c": (1, 1, [("x", 1)])}
    one = qu.unconvertible(spark.read.parquet(str(tmp_path / "t")), "a", "bigint").first()
    assert one.samples == ["bad00", "bad04", "bad08", "bad12", "bad16"] and one.invalid_count == 250


def test_failing_casts_of_specifications(spark):
    df = spark.createDataFrame([("1,5", "x"), ("abc", "2024-01-01"), (None, None)], "a string, d string")
    found = qu.lost_by_cast(df, [sh.ColumnSpec("a", "a", "DOUBLE"), sh.ColumnSpec("d", "d", "DATE"), sh.ColumnSpec("z", "z", "DATE")])
    assert {r["item"]: [x["value"] for x in r["samples"]] for r in found.collect()} == {"a": ["abc"], "d": ["x"]}


def test_heavy_values_equal_a_full_count(spark):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 4 = 0 THEN 'h' || id % 5 WHEN id % 4 = 1 THEN NULL ELSE 'u' || id END AS v", "'v' || id AS w").repartition(6)
    for column, n, candidates in (("v", 5, 100), ("v", 6, 100), ("v", 5, 3), ("w", 4, 50)):
        assert qu.heavy_values(df, column, n, candidates).collect() == qu.value_frequency(df, column, n).collect()
    heavy = qu.heavy_values(df, "v", 5, 100)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" not in heavy  # read from the counts of the candidates
    assert qu.heavy_values(df.limit(0), "v").count() == 0
