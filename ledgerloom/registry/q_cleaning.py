"""Queries: safe casts, cleaning passes, quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import masks, scalars as sc
from ledgerloom.operators import quality as qu
from ledgerloom.operators import shaping as sh
from ledgerloom.operators.joins import merge
from ledgerloom.operators.tables import delete_where
from ledgerloom.registry.core import register
from ledgerloom.registry.views import table, view
from ledgerloom.session import scratch_path
from ledgerloom.sources import readers as rd

AMT = "CAST(amt AS DOUBLE)"
WHOLE = "CAST(trunc(amt) AS BIGINT)"

CTES = {
    "o_int": f"""
SELECT k, CASE k % 12 WHEN 0 THEN {WHOLE} WHEN 1 THEN {WHOLE} WHEN 8 THEN {WHOLE} WHEN 10 THEN -{WHOLE} WHEN 11 THEN {WHOLE} END AS n FROM {{dirty}}""",
    "o_num": f"""
SELECT k, CASE k % 12 WHEN 0 THEN {AMT} WHEN 1 THEN CAST(trunc(amt) AS DOUBLE) WHEN 4 THEN CAST(0.05 AS DOUBLE) WHEN 10 THEN -{AMT} WHEN 11 THEN {AMT} END AS x
FROM {{dirty}}""",
    "o_day": """
SELECT d.k, CASE WHEN d.k % 7 IN (0, 1, 2, 5) THEN CAST(o.o_orderdate AS DATE) END AS day FROM {dirty} d JOIN {orders} o ON o.o_orderkey = d.k""",
    "o_flag": "SELECT k, CASE WHEN k % 8 IN (0, 1, 2) THEN TRUE WHEN k % 8 IN (3, 4, 5) THEN FALSE END AS flag FROM {dirty}",
    "o_silver": """
SELECT d.k, i.n AS amount, x.x AS ratio, y.day, f.flag, d.note FROM {dirty} d JOIN {o_int} i ON i.k = d.k JOIN {o_num} x ON x.k = d.k
JOIN {o_day} y ON y.k = d.k JOIN {o_flag} f ON f.k = d.k""",
}

SPECS = [
    sh.ColumnSpec("K", "key", "BIGINT", required=True),
    sh.ColumnSpec("amount_.*", "amount", "BIGINT"),
    sh.ColumnSpec("date_text|day_text", "day", "DATE"),
    sh.ColumnSpec("flag_text", "flag", "BOOLEAN"),
    sh.ColumnSpec("absent", "channel", "VARCHAR", default="bank"),
    sh.ColumnSpec("note", "note"),
]
SCHEMA = sh.SchemaConfig(SPECS, null_threshold=0.7)


def bronze_of(spark, sf):
    raw = view(spark, sf, "dirty").select("k", "amount_text", "date_text", "flag_text", "note")
    return rd.bronze(rd.as_text(raw), "batch-1", "orders.csv", "S1")


@register("safe_cast_int", "F1", "SELECT k, n AS value FROM {o_int}", CTES, {"value": "DOUBLE"})
def safe_cast_int(spark, sf):
    return view(spark, sf, "dirty").select("k", sc.to_integer(F.col("amount_text")).alias("value"))


@register("safe_cast_num", "F2", "SELECT k, x AS value FROM {o_num}", CTES)
def safe_cast_num(spark, sf):
    return view(spark, sf, "dirty").select("k", sc.to_number(F.col("amount_text")).alias("value"))


@register("safe_cast_date", "F3", "SELECT k, CAST(day AS STRING) AS value, CAST(CASE WHEN k % 7 = 1 THEN day END AS STRING) AS by_format FROM {o_day}", CTES)
def safe_cast_date(spark, sf):
    text = F.col("date_text")
    return view(spark, sf, "dirty").select("k", sc.to_date(text).alias("value"), sc.to_date(text, "%Y/%m/%d").alias("by_format"))


@register("safe_cast_timestamp", "F3", "SELECT k, strftime(day, '%Y-%m-%d %H:%M:%S') AS value FROM {o_day}", CTES)
def safe_cast_timestamp(spark, sf):
    value = F.date_format(sc.to_timestamp(F.col("date_text")), "yyyy-MM-dd HH:mm:ss")
    return view(spark, sf, "dirty").select("k", value.alias("value"))


@register("safe_cast_bool", "F4", "SELECT k, flag AS value FROM {o_flag}", CTES, {"value": "STRING"})
def safe_cast_bool(spark, sf):
    return view(spark, sf, "dirty").select("k", sc.to_boolean(F.col("flag_text")).alias("value"))


_STRIP = "translate(amount_text, ',$€¥ ￥₩£_-', '')"


@register("clean_translate", "F5", f"SELECT k, {_STRIP} AS amount_text FROM {{dirty}}")
def clean_translate(spark, sf):
    return qu.clean_numeric(view(spark, sf, "dirty").select("k", "amount_text"), "amount_text")


@register("dirty_counts", "F5", f"""
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE regexp_matches(amount_text, '[,$€¥ ￥₩£_-]')) AS dirty_count, CAST(0 AS BIGINT) AS remaining_dirty FROM {{dirty}}""")
def dirty_counts(spark, sf):
    return qu.dirty_report(view(spark, sf, "dirty"), "amount_text")


@register("clean_convert", "F6", """
SELECT k, CAST(CASE k % 12 WHEN 2 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL WHEN 1 THEN trunc(amt) ELSE amt END AS DOUBLE) AS amount_text
FROM {dirty} WHERE k % 12 NOT IN (3, 4, 5, 8, 9)""")
def clean_convert(spark, sf):
    # values that cannot be read at all are filtered by their form first: the conversion is all or nothing
    rows = view(spark, sf, "dirty").where(~masks.matches(F.col("amount_text"), "[A-Za-z%元]")).select("k", "amount_text")
    return qu.clean_and_convert(rows, "amount_text", "double")


@register("type_guard", "F7", """
SELECT COUNT(*) FILTER (WHERE amount_text IS NOT NULL AND TRY_CAST(amount_text AS DECIMAL(18,2)) IS NULL) AS invalid_count FROM {dirty}""")
def type_guard(spark, sf):
    return qu.unconvertible(view(spark, sf, "dirty"), "amount_text", "decimal(18,2)").select("invalid_count")


@register("conversion_samples", "F6 F7 Q3", """
SELECT i.item, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS invalid_count, COUNT(v) AS distinct_count, COALESCE(STRING_AGG(v || ' x' || CAST(n AS STRING), '|' ORDER BY v) FILTER (WHERE r <= 5), '') AS samples
FROM (VALUES ('amount_text'), ('note'), ('k')) i(item) LEFT JOIN (
  SELECT item, v, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY item ORDER BY v) AS r FROM (
    SELECT 'amount_text' AS item, amount_text AS v FROM {dirty} WHERE amount_text IS NOT NULL AND TRY_CAST(amount_text AS DECIMAL(18,2)) IS NULL
    UNION ALL SELECT 'note', note FROM {dirty} WHERE note IS NOT NULL) f GROUP BY 1, 2) g ON g.item = i.item
GROUP BY i.item""")
def conversion_samples(spark, sf):
    """All columns that are to change their type in one pass: how many values fail, how many different ones, and the least five."""
    found = qu.lost_by_type(view(spark, sf, "dirty"), {"amount_text": "decimal(18,2)", "note": "bigint", "k": "int"})
    shown = F.transform("samples", lambda x: F.concat(x["value"], F.lit(" x"), x["n"].cast("string")))
    return found.select("item", "invalid_count", "distinct_count", F.array_join(shown, "|").alias("samples"))


@register("alter_columns", "F8", "SELECT k AS key, 'bank' AS channel, CAST(7 AS BIGINT) AS weight FROM {dirty}")
def alter_columns(spark, sf):
    df = view(spark, sf, "dirty").select("k", "note")
    df = sh.add_column(sh.add_column(df, "channel", "string", "bank"), "weight", "bigint", 7)
    return df.withColumnRenamed("k", "key").drop("note")


@register("number_format", "F13", """
SELECT k, CASE WHEN k % 12 IN (0, 1, 4, 10, 11) THEN format('{{:,d}}', CAST(round_even(x, 0) AS BIGINT)) ELSE 'N/A' END AS text FROM {o_num}""", CTES)
def number_format(spark, sf):
    value = sc.to_number(F.col("amount_text"))
    return view(spark, sf, "dirty").select("k", sc.grouped_digits(value).alias("text"))


@register("text_functions", "F10", """
SELECT k, lower(trim(note)) AS low, replace(note, 'H', '_') AS rep, regexp_replace(note, '[0-9]-', '', 'g') AS rx, split_part(trim(note), '-', 2) AS part,
  substr(trim(note), 3, 4) AS sub, lpad(CAST(k % 100 AS STRING), 3, '0') AS pad, COALESCE(contains(note, 'LOW'), FALSE) AS has FROM {dirty}""")
def text_functions(spark, sf):
    note = F.col("note")
    return view(spark, sf, "dirty").select(
        "k", F.lower(F.trim(note)).alias("low"), F.replace(note, F.lit("H"), F.lit("_")).alias("rep"),
        F.regexp_replace(note, "[0-9]-", "").alias("rx"), F.split_part(F.trim(note), F.lit("-"), F.lit(2)).alias("part"),
        F.substring(F.trim(note), 3, 4).alias("sub"), F.lpad((F.col("k") % 100).cast("string"), 3, "0").alias("pad"),
        masks.has_text(note, "LOW").alias("has"))


@register("date_functions", "F11 P10", """
SELECT k, strftime(day, '%Y%m') AS ym, strftime(day, '%m%d') AS md, strftime(day, '%Y/%m/%d') AS slash, COALESCE(strftime(day, '%Y%m') = '199810', FALSE) AS in_month
FROM {o_day}""", CTES)
def date_functions(spark, sf):
    day = sc.to_date(F.col("date_text"))
    return view(spark, sf, "dirty").select(
        "k", F.date_format(day, "yyyyMM").alias("ym"), F.date_format(day, "MMdd").alias("md"), F.date_format(day, "yyyy/MM/dd").alias("slash"),
        masks.month_text_is(day, "199810").alias("in_month"))


@register("numeric_functions", "F9 Q6", """
SELECT o_orderkey AS k, CAST(trunc(t) AS BIGINT) AS whole, CAST(round_even(t / 1, 0) AS DOUBLE) AS even, CAST(abs(200000 - t) AS DOUBLE) AS gap,
  CASE WHEN o_custkey % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(t AS DOUBLE) / (o_custkey % 10) END AS ratio,
  t BETWEEN 1000 AND 400000 AS in_bounds, abs(t - 200000) <= 1000 AS near FROM (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS t FROM {orders}) x""".replace("round_even(t / 1, 0)", "round_even(t, 0)"))
def numeric_functions(spark, sf):
    t = F.col("o_totalprice").cast("decimal(18,2)")
    return view(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), sc.cut(t).alias("whole"), sc.half_even(t).alias("even"), F.abs(200000 - t).alias("gap"),
        sc.ratio(t.cast("double"), (F.col("o_custkey") % 10).cast("double"), 0).alias("ratio"),
        masks.amount_ok(t, 1000, 400000).alias("in_bounds"), masks.within_tolerance(t, F.lit(200000), 1000).alias("near"))


@register("null_ratio", "Q1 Q2", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) AS null_ratio, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) > 0.15 AS exceeds_threshold FROM {{dirty}}"
    for c in ("k", "amount_text", "date_text", "flag_text", "note")))
def null_ratio(spark, sf):
    return qu.null_summary(view(spark, sf, "dirty").drop("amt"), 0.15)


@register("breaker_verdict", "Q1", """
SELECT 'amount' AS "column", COUNT(*) FILTER (WHERE n IS NULL) / COUNT(*) AS null_ratio, COUNT(*) FILTER (WHERE n IS NULL) / COUNT(*) > 0.5 AS tripped FROM {o_int}
UNION ALL SELECT 'day', COUNT(*) FILTER (WHERE day IS NULL) / COUNT(*), COUNT(*) FILTER (WHERE day IS NULL) / COUNT(*) > 0.5 FROM {o_day}""", CTES)
def breaker_verdict(spark, sf):
    from ledgerloom.operators.literals import literal_table

    table = view(spark, sf, "dirty").select(sc.to_integer(F.col("amount_text")).alias("amount"), sc.to_date(F.col("date_text")).alias("day"))
    result = qu.breaker(table, 0.5)
    return literal_table(spark, [(c, r, c in result.tripped) for c, r in result.ratios.items()], "column string, null_ratio double, tripped boolean")


@register("cast_failures", "Q3", """
SELECT 'amount' AS "column", COUNT(*) FILTER (WHERE i.n IS NULL) AS null_after, COUNT(*) FILTER (WHERE i.n IS NULL AND d.amount_text IS NOT NULL) AS failed
FROM {dirty} d JOIN {o_int} i ON i.k = d.k
UNION ALL SELECT 'day', COUNT(*) FILTER (WHERE i.day IS NULL), COUNT(*) FILTER (WHERE i.day IS NULL AND d.date_text IS NOT NULL) FROM {dirty} d JOIN {o_day} i ON i.k = d.k
UNION ALL SELECT 'flag', COUNT(*) FILTER (WHERE i.flag IS NULL), COUNT(*) FILTER (WHERE i.flag IS NULL AND d.flag_text IS NOT NULL) FROM {dirty} d JOIN {o_flag} i ON i.k = d.k""", CTES)
def cast_failures(spark, sf):
    mapped = sh.map_columns(bronze_of(spark, sf), SPECS)
    return qu.cast_failures(mapped, [s for s in SPECS if s.target in ("amount", "day", "flag")]).drop("n_rows")


@register("empty_rows", "P6", """
SELECT k FROM {dirty} WHERE COALESCE(trim(amount_text), '') <> '' OR COALESCE(trim(note), '') <> ''""")
def empty_rows(spark, sf):
    return sh.drop_empty_rows(view(spark, sf, "dirty"), ["amount_text", "note"]).select("k")


@register("column_mapping", "P1 P2 P3", "SELECT CAST(k AS STRING) AS key, amount_text AS amount, date_text AS day, flag_text AS flag, 'bank' AS channel, note, 'batch-1' AS _batch_id FROM {dirty}")
def column_mapping(spark, sf):
    bronze = bronze_of(spark, sf).drop("_source_file", "_sheet_name", "_ingested_at")
    return sh.apply_defaults(sh.map_columns(bronze, SPECS), SPECS)


@register("bronze_lineage", "P4 P5", """
SELECT CAST(k AS STRING) AS "order_key", note AS "note_2", note, 'batch-1' AS _batch_id, 'orders.csv' AS _source_file, 'S1' AS _sheet_name, TRUE AS stamped FROM {dirty}""")
def bronze_lineage(spark, sf):
    raw = view(spark, sf, "dirty").select(F.col("k").cast("string").alias(" order  (key) ".replace("(key)", "key")), "note", F.col("note").alias("note!"))
    out = rd.bronze(raw, "batch-1", "orders.csv", "S1")
    return out.withColumn("stamped", F.col("_ingested_at").isNotNull()).drop("_ingested_at")


@register("silver_pass", "Q7 Q8", """
SELECT k AS key, amount, CAST(day AS STRING) AS day, flag, note, 'bank' AS channel, 'batch-1' AS _batch_id FROM {o_silver}""", CTES, {"amount": "DOUBLE", "flag": "STRING"})
def silver_pass(spark, sf):
    # cast, counted and written in one pass; read only if the breaker held
    path = scratch_path(spark, "silver")
    qu.write_silver(bronze_of(spark, sf), SCHEMA, path)
    return spark.read.parquet(path).drop("_source_file", "_sheet_name", "_ingested_at")


@register("generic_clean", "P7 U2", """
SELECT DISTINCT o_orderstatus AS status, COALESCE(n, 'none') AS note FROM (SELECT o.o_orderstatus, trim(COALESCE(d.note, 'none')) AS n, d.amount_text
FROM {dirty} d JOIN {orders} o ON o.o_orderkey = d.k) t WHERE amount_text IS NOT NULL""")
def generic_clean(spark, sf):
    joined = view(spark, sf, "dirty").join(view(spark, sf, "orders"), F.col("k") == F.col("o_orderkey"))
    # the amount is needed for the required-value rule only: reduce it to a mark before taking distinct rows
    slim = joined.select("o_orderstatus", "note", F.when(F.col("amount_text").isNotNull(), F.lit("x")).alias("amount_text"))
    return sh.clean_frame(slim, distinct=True, require=["amount_text"], fill={"note": "none"}, strip=["note"],
                          rename={"o_orderstatus": "status"}, drop=["amount_text"])


@register("filter_expr", "P8 X2", "SELECT k FROM {dirty} WHERE amt > 100000 AND note IS NOT NULL")
def filter_expr(spark, sf):
    return sh.filter_frame(view(spark, sf, "dirty"), "amt > 100000", lambda df: df.where(F.col("note").isNotNull())).select("k")


@register("user_transform", "X1", "SELECT k, CAST(amt * 3 AS DOUBLE) AS scaled FROM {dirty}")
def user_transform(spark, sf):
    def scale(df, factor):
        return df.select("k", (F.col("amt") * factor).alias("scaled"))

    return view(spark, sf, "dirty").transform(scale, 3)


@register("delete_rows", "K8", "SELECT k, note FROM {dirty} WHERE NOT COALESCE(note LIKE '%LOW%', FALSE)")
def delete_rows(spark, sf):
    return delete_where(view(spark, sf, "dirty").select("k", "note"), "note LIKE '%LOW%'")


@register("merge_step", "J1", """
SELECT COALESCE(a.flag_text, b.flag_text) AS flag_text, a.n AS n_left, b.n AS n_right FROM (SELECT flag_text, COUNT(*) AS n FROM {dirty} WHERE amt < 300000 AND flag_text IS DISTINCT FROM 'TRUE' GROUP BY 1) a
FULL OUTER JOIN (SELECT flag_text, COUNT(*) AS n FROM {dirty} WHERE amt > 100000 AND flag_text IS DISTINCT FROM '0' GROUP BY 1) b ON a.flag_text IS NOT DISTINCT FROM b.flag_text""", nullable={"n_left": "DOUBLE", "n_right": "DOUBLE"})
def merge_step(spark, sf):
    d = view(spark, sf, "dirty")
    count = F.count(F.lit(1)).alias("n")
    left = d.where((F.col("amt") < 300000) & ~F.col("flag_text").eqNullSafe("TRUE")).groupBy("flag_text").agg(count)
    right = d.where((F.col("amt") > 100000) & ~F.col("flag_text").eqNullSafe("0")).groupBy("flag_text").agg(count)
    return merge(left, right, on=["flag_text"], how="outer", suffixes=("_left", "_right"))


@register("dup_keys", "A23", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS duplicate_count FROM {lineitem} GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def dup_keys(spark, sf):
    return qu.duplicate_keys(view(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dup_rows", "A23", """
SELECT COUNT(*) AS duplicate_groups FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS d FROM {events} GROUP BY ALL HAVING COUNT(*) > 1) t""")
def dup_rows(spark, sf):
    return qu.duplicate_rows(view(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("d")))


@register("null_counts", "A24", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS null_count FROM {{statements}}"
    for c in ("disbursement_date", "request_date", "store_name", "adjustment_handling_fee")))
def null_counts(spark, sf):
    return qu.null_counts(view(spark, sf, "statements"), ["disbursement_date", "request_date", "store_name", "adjustment_handling_fee"])


@register("value_freq", "A26 O4", """SELECT p_brand AS value, COUNT(*) AS count FROM {part} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7""")
def value_freq(spark, sf):
    return qu.value_frequency(view(spark, sf, "part"), "p_brand", 7)


@register("heavy_values", "A26 O4", """
SELECT 'brand' AS item, * FROM (SELECT CAST(l_quantity AS STRING) AS value, COUNT(*) AS count FROM {lineitem} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7) a
UNION ALL SELECT 'skewed', * FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' || CAST(l_linenumber AS STRING) ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS value, COUNT(*) AS count FROM {lineitem} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 4) b
UNION ALL SELECT 'unique', * FROM (SELECT CAST(o_orderkey AS STRING) AS value, COUNT(*) AS count FROM {orders} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3) c""")
def heavy_values(spark, sf):
    """Frequent values from a summary and a second count: few values, some that stand out among many, and none that does."""
    items = table(spark, sf, "lineitem").select(
        F.col("l_quantity").cast("string").alias("brand"), F.expr("CASE WHEN l_orderkey % 3 = 0 THEN 'hot' || l_linenumber ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS skewed")
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("unique"))
    parts = [qu.heavy_values(df, c, n).select(F.lit(c).alias("item"), "value", "count") for df, c, n in ((items, "brand", 7), (items, "skewed", 4), (orders, "unique", 3))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("table_validation", "Q4 X2", """
SELECT * FROM (
  SELECT 'required' AS rule, 'k' AS item, 'error' AS severity, CAST(0 AS BIGINT) AS failures, TRUE AS ok
  UNION ALL SELECT 'required', 'absent', 'error', 1, FALSE
  UNION ALL SELECT 'not_null', 'note', 'error', COUNT(*) - COUNT(note), COUNT(*) = COUNT(note) FROM {dirty}
  UNION ALL SELECT 'validator', 'amount below 400000', 'error', COUNT(*) FILTER (WHERE NOT COALESCE(amt < 400000, FALSE)), COUNT(*) FILTER (WHERE NOT COALESCE(amt < 400000, FALSE)) = 0 FROM {dirty}
  UNION ALL SELECT 'unique', 'k', 'warning', COUNT(*) - COUNT(DISTINCT k), COUNT(*) = COUNT(DISTINCT k) FROM {dirty}
  UNION ALL SELECT 'unique', 'flag_text', 'warning', COUNT(*) - COUNT(DISTINCT flag_text) - 1, FALSE FROM {dirty}) t""")
def table_validation(spark, sf):
    return qu.validate_table(view(spark, sf, "dirty"), ["k", "absent"], ["k", "flag_text"], ["note"], {"amount below 400000": F.col("amt") < 400000})


@register("uniqueness", "Q4 A23", """
SELECT 'unique' AS rule, x.item, 'warning' AS severity, x.failures, x.failures = 0 AS ok FROM (
  SELECT 'l_orderkey' AS item, COUNT(*) - COUNT(DISTINCT l_orderkey) AS failures FROM {lineitem} UNION ALL SELECT 'l_partkey', COUNT(*) - COUNT(DISTINCT l_partkey) FROM {lineitem}
  UNION ALL SELECT 'l_quantity', COUNT(*) - COUNT(DISTINCT l_quantity) FROM {lineitem} UNION ALL SELECT 'l_shipdate', COUNT(*) - COUNT(DISTINCT l_shipdate) FROM {lineitem}
  UNION ALL SELECT 'flag', COUNT(*) - COUNT(DISTINCT nullif(l_returnflag, 'N')) - 1 FROM {lineitem}) x""")
def uniqueness(spark, sf):
    """Rows beyond the first of each value, for many columns at once; one of them has missing values."""
    rows = table(spark, sf, "lineitem").withColumn("flag", F.expr("nullif(l_returnflag, 'N')"))
    return qu.validate_table(rows, unique=["l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "flag"])


@register("integrity_of_equal_rows", "Q5 A23 A24", """
SELECT 'rows' AS section, 'lineitem' AS item, CAST(COUNT(*) AS STRING) AS value FROM {lineitem}
UNION ALL SELECT 'nulls', 'q', CAST(COUNT(*) FILTER (WHERE l_linenumber % 3 = 0) AS STRING) FROM {lineitem} UNION ALL SELECT 'nulls', 'l_returnflag', '0'
UNION ALL SELECT 'duplicates', 'lineitem', CAST(COUNT(*) AS STRING) FROM (SELECT CASE WHEN l_linenumber % 3 > 0 THEN l_linenumber END AS q, l_returnflag FROM {lineitem} GROUP BY ALL HAVING COUNT(*) > 1) t
UNION ALL SELECT 'type', x.c, x.t FROM (VALUES ('q', 'int'), ('l_returnflag', 'string')) x(c, t)""")
def integrity_of_equal_rows(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("CAST(CASE WHEN l_linenumber % 3 > 0 THEN l_linenumber END AS INT) AS q", "l_returnflag")
    return qu.integrity_profile(rows, "lineitem")


@register("integrity", "Q5", """
SELECT 'rows' AS section, 'customer' AS item, CAST(COUNT(*) AS STRING) AS value FROM {customer}
UNION ALL SELECT 'nulls', x.c, '0' FROM (VALUES ('c_custkey'), ('c_nationkey'), ('c_mktsegment')) x(c) WHERE (SELECT COUNT(*) FROM {customer} WHERE c_custkey IS NULL) = 0
UNION ALL SELECT 'duplicates', 'customer', CAST(COUNT(*) AS STRING) FROM (SELECT c_custkey, c_nationkey, c_mktsegment FROM {customer} GROUP BY ALL HAVING COUNT(*) > 1) t
UNION ALL SELECT 'type', x.c, x.t FROM (VALUES ('c_custkey', 'bigint'), ('c_nationkey', 'int'), ('c_mktsegment', 'string')) x(c, t)""")
def integrity(spark, sf):
    return qu.integrity_profile(view(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "customer")


@register("custom_check", "Q5 S11", "SELECT COUNT(*) AS negative FROM {customer} WHERE c_acctbal < 0")
def custom_check(spark, sf):
    checks = qu.custom_checks(view(spark, sf, "customer"), {"negative": "SELECT COUNT(*) AS negative FROM {table_name} WHERE c_acctbal < 0"})
    return checks["negative"]


@register("table_info", "Q14", """
SELECT 'orders' AS table_name, COUNT(*) AS row_count, CAST(6 AS BIGINT) AS column_count FROM {orders}
UNION ALL SELECT 'customer', COUNT(*), 5 FROM {customer} UNION ALL SELECT 'nation', COUNT(*), 3 FROM {nation}""")
def table_info(spark, sf):
    return qu.table_info({n: view(spark, sf, n) for n in ("orders", "customer", "nation")})
