"""Plans must hold at scale: filters reach the scan, no cross joins, no Python, no unpartitioned window over facts."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import rowwise as rw
from ledgerloom.operators.pivots import pivot_with_margins
from ledgerloom.operators.tables import upsert
from ledgerloom.plans import journal as jo
from ledgerloom.plans import statements as st
from ledgerloom.registry.views import PERIOD as P
from ledgerloom.registry.views import view
from ledgerloom.session import scratch_path
from ledgerloom.sources.writers import write_statements


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def statements(spark, sf_dir):
    path = scratch_path(spark, "statements")
    write_statements(view(spark, sf_dir, "statements"), path)
    return spark.read.parquet(path)


def test_period_filter_reaches_the_scan(statements):
    text = plan(st.period_sums(statements, P))
    assert re.search(r"PushedFilters: \[Or\(.*disbursement_date.*request_date", text)
    assert "PartitionFilters: [bank" in text and "transaction_type" not in text.split("ReadSchema")[1].split("\n")[0]


def test_store_subtotals_read_one_bank(statements):
    text = plan(st.store_subtotals(statements, P))
    assert re.search(r"PartitionFilters: \[.*bank.* = ub", text) and "tax_amount" not in text


def test_whole_table_pass_aggregates_by_hash(statements):
    text = plan(st.statement_profile(statements, P))
    assert "SortAggregate" not in text and "HashAggregate" in text and "handling_fee" not in text


def test_one_shuffle_per_measure_pass(statements):
    assert plan(st.period_sums(statements, P)).count("Exchange hashpartitioning") == 1


def test_pivot_shuffles_sums_not_facts(spark, sf_dir):
    text = plan(pivot_with_margins(view(spark, sf_dir, "daily"), ["d"], "e", "v", ["click", "view"]))
    # the expansion for the margins stands above the first aggregation
    assert text.index("Expand") < text.index("Scan parquet") and text.count("partial_sum(v") == 1


def test_forward_fill_windows_are_blocked(spark, sf_dir):
    text = plan(rw.forward_fill(view(spark, sf_dir, "plain_report"), ["term"], ["file_no"], "seq"))
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_upsert_has_no_hint_and_no_product(spark, sf_dir):
    df = upsert(view(spark, sf_dir, "target_customers"), view(spark, sf_dir, "customer_updates"), ["c_custkey"])
    assert "hint" not in df._jdf.queryExecution().analyzed().toString().lower()
    assert "LeftAnti" in plan(df) and "CartesianProduct" not in plan(df)


def test_settings_tables_have_a_known_size(spark):
    # small by statistics, so Spark broadcasts them without being told
    facts = spark.range(10_000_000).select(F.concat(F.lit("acc_"), F.col("id").cast("string")).alias("column"), "id")
    joined = facts.join(jo.mapping_table(spark), "column")
    assert "BroadcastHashJoin" in plan(joined)


def test_no_python_in_the_hot_paths(spark, sf_dir, statements):
    from ledgerloom.registry.q_cleaning import SCHEMA, bronze_of
    from ledgerloom.operators.quality import silver

    for df in (st.period_measures(statements, P), silver(bronze_of(spark, sf_dir), SCHEMA)):
        assert not re.search(r"Python|ArrowEval|MapInPandas", plan(df))


def test_library_has_no_forbidden_shortcuts():
    import pathlib

    code = "\n".join(p.read_text(encoding="utf-8") for p in pathlib.Path("ledgerloom").rglob("*.py"))
    for word in ("localCheckpoint", "crossJoin", ".toPandas(", "F.udf", "broadcast("):
        assert word not in code, word


def test_small_sides_have_a_known_size(spark, sf_dir):
    from ledgerloom.operators.shaping import number_file_rows

    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cards = view(spark, sf_dir, "card_report")
    for df in (number_file_rows(rows), rw.rows_before_marker(cards, F.col("card") == "總筆數", ["sheet", "file_no"], "seq")):
        assert "BroadcastHashJoin" in plan(df) and "Exchange hashpartitioning" not in plan(df)


def test_partition_upsert_reads_and_writes_in_place(spark, sf_dir, tmp_path):
    from ledgerloom.sources.writers import upsert_dataset, write_parquet

    path = str(tmp_path / "t")
    write_parquet(spark.range(10).selectExpr("id", "id % 2 AS g", "'old' AS v"), path, partition_by=["g"])
    upsert_dataset(spark.range(4).selectExpr("id", "0L AS g", "'new' AS v").where("id % 2 = 0"), path, ["id", "g"], partition_by=["g"])
    got = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 10 and {k for k, v in got.items() if v == "new"} == {0, 2}
