"""Upsert, schema evolution, writers and readers."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from ledgerloom.operators import tables as tb
from ledgerloom.operators.shaping import number_file_rows
from ledgerloom.sources import readers as rd
from ledgerloom.sources import writers as wr


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "a", 12), (2, "b", 13), (None, "a", 14)], "k bigint, g string, v int")


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(1, "a", 90), (2, "b", 91), (3, "c", 92)], "k bigint, g string, v int")


def test_tuple_upsert_replaces_matching_tuples(target, source, rows):
    out = tb.upsert(target, source, ["k", "g"])
    assert rows(out) == rows(target.where("k IS NULL OR (k = 1 AND g = 'b') OR (k = 2 AND g = 'a')").unionByName(source))


def test_columnwise_upsert_takes_the_cross_product(target, source, rows):
    assert rows(tb.upsert(target, source, ["k", "g"], "columnwise")) == rows(target.where("k IS NULL").unionByName(source))


def test_upsert_is_idempotent(target, source, rows):
    once = tb.upsert(target, source, ["k", "g"])
    assert rows(tb.upsert(once, source, ["k", "g"])) == rows(once)


def test_upsert_touches_only_the_partitions_of_the_source(spark, source, tmp_path, rows):
    path = str(tmp_path / "t")
    start = spark.createDataFrame([(1, "a", 10), (7, "z", 70)], "k bigint, g string, v int")
    wr.write_parquet(start, path, partition_by=["g"])
    untouched = sorted(p.name for p in (tmp_path / "t" / "g=z").glob("*.parquet"))
    wr.upsert_dataset(source, path, ["k", "g"], partition_by=["g"])
    assert sorted(p.name for p in (tmp_path / "t" / "g=z").glob("*.parquet")) == untouched
    assert rows(spark.read.parquet(path), "k", "g", "v") == [(1, "a", 90), (2, "b", 91), (3, "c", 92), (7, "z", 70)]


def test_delete_keeps_rows_where_the_condition_is_unknown(target, rows):
    assert rows(tb.delete_where(target, "k = 1"), "v") == [(12,), (13,), (14,)]


def test_schema_diff_knows_alias_types():
    a = T.StructType([T.StructField("A", T.DoubleType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])
    b = T.StructType([T.StructField("a", T.DecimalType(18, 2)), T.StructField("b", T.LongType()), T.StructField("d", T.DateType())])
    folded = tb.schema_diff(a, b, ignore_case=True)
    assert [(c.column, c.change) for c in folded.changes] == [("d", "added"), ("c", "removed"), ("b", "type_changed")]
    assert ("A", "removed") in [(c.column, c.change) for c in tb.schema_diff(a, b).changes]
    assert tb.types_compatible("INT", "integer") and not tb.types_compatible("INTEGER", "BIGINT")


def test_plans_by_strategy():
    diff = tb.Diff([tb.Change("n", "added", None, "VARCHAR"), tb.Change("o", "removed", "VARCHAR"), tb.Change("t", "type_changed", "VARCHAR", "BIGINT")])
    safe, force, backup, dry = (tb.migration_plan(diff, s) for s in tb.STRATEGIES)
    assert [s[0] for s in safe.steps] == ["add"] and len(safe.warnings) == 3 and safe.will_execute
    assert [s[0] for s in force.steps] == ["add", "drop", "retype"] and not force.backup_required
    assert backup.backup_required and not dry.will_execute
    assert not tb.migration_plan(tb.Diff([tb.Change("o", "removed", "X")]), "safe").will_execute
    with pytest.raises(ValueError):
        tb.migration_plan(diff, "brave")


def test_evolve_retypes_what_converts(spark, rows):
    df = spark.createDataFrame([("1", "x"), ("q", "y")], "n string, old string")
    want = T.StructType([T.StructField("n", T.LongType()), T.StructField("new", T.StringType())])
    out, plan = tb.evolve(df, want, "force")
    assert out.columns == ["n", "new"] and rows(out) == [(1, None), (None, None)] and plan.will_execute
    same, _ = tb.evolve(df, want, "dry_run")
    assert same.columns == ["n", "old"]


def test_auto_migrate_actions(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = a.selectExpr("x", "'t' AS tier")
    assert [tb.auto_migrate(*p)[0] for p in [(None, a), (a, a), (a, b), (b, a)]] == ["created", "no_change", "auto_migrated", "requires_review"]
    assert tb.auto_migrate(None, a, create=False) == ("skipped", None)
    assert tb.auto_migrate(a, b)[1].columns == ["x", "tier"]


def test_csv_options(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text("title\n\nmade,today\na;b;d\n1;NA;2024/01/05\n2;x;bad\n3;-;2024/02/01\n", encoding="utf-8")
    out = rd.read_csv(spark, str(path), sep=";", skip_rows=3, null_values=["NA", "-"], dates={"d": "yyyy/MM/dd"}, where="a >= 2")
    assert rows(out) == [("2", "x", None), ("3", None, dt.date(2024, 2, 1))]
    assert rd.read_csv(spark, str(path), sep=";", skip_rows=3, columns=["b"], limit=2).count() == 2
    typed = rd.read_csv(spark, str(path), sep=";", skip_rows=3, schema="a int, b string, d string")
    assert typed.dtypes[0] == ("a", "int") and rows(typed, "a") == [(1,), (2,), (3,)]


def test_bad_condition_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n1\n", encoding="utf-8")
    with pytest.raises(Exception):
        rd.read_csv(spark, str(tmp_path / "x.csv"), where="no_such_column > 1").count()


def test_dirty_csv_and_encodings(spark, tmp_path, rows):
    path = tmp_path / "big5.csv"
    path.write_bytes("名稱,金額\n台新,1\n國泰,2,3,4\n聯邦\n".encode("cp950"))
    assert rd.detect_encoding(spark, str(path)) == "cp950"
    out = rd.read_dirty_csv(spark, str(path), rd.SourceSpec(encoding="auto"))
    assert rows(out, "名稱", "金額") == [("台新", "1"), ("聯邦", None)]


def test_row_numbers_follow_the_file_across_splits(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(str(i) for i in range(1, 5001)) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = number_file_rows(spark.read.text(str(path)))
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 4
        assert df.where("CAST(value AS BIGINT) <> _row_num").count() == 0 and df.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))


@pytest.mark.parametrize("cuts", [("2000", "700"), ("700", "2000"), ("2000", "1300"), ("2000", str(128 * 1024 * 1024))])
def test_skipped_rows_when_splits_change_before_the_run(spark, tmp_path, cuts):
    (tmp_path / "in").mkdir()
    for k, n in enumerate((3000, 900, 1)):
        body = [f"{k},{i}" for i in range(n)]
        (tmp_path / "in" / f"{k}.csv").write_text("\n".join(["title", "as of,today", "k,n", *body]) + "\n", encoding="utf-8")
    want = sorted((str(k), str(i)) for k, n in enumerate((3000, 900, 1)) for i in range(n))
    path = str(tmp_path / "in")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", cuts[0])
        frames = [rd.read_csv(spark, path, skip_rows=2), rd.read_dirty_csv(spark, path, rd.SourceSpec(skip_rows=2))]
        numbered = number_file_rows(spark.read.text(path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", cuts[1])
        for df in frames:
            assert df.columns == ["k", "n"] and sorted(map(tuple, df.collect())) == want
        assert numbered.where("_row_num > 3").count() == len(want) and numbered.where("value = 'k,n' and _row_num = 3").count() == 3
        assert numbered.where("_row_num > 3 and split(value, ',')[1] != _row_num - 4").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))


def test_reader_by_suffix(spark, tmp_path):
    assert rd.file_type("a/b.PQ") == "parquet" and rd.file_type("x.txt") == "csv" and rd.file_type("dir/part", "json") == "json"
    with pytest.raises(ValueError):
        rd.read_any(spark, str(tmp_path / "a.xlsx"))
    with pytest.raises(ValueError):
        rd.read_any(spark, str(tmp_path / "a.bin"), rd.SourceSpec(file_type="bin"))


def test_sheets_are_tagged_and_chosen(spark, tmp_path, rows):
    wr.write_csv(spark.createDataFrame([("1", "x")], "a string, b string"), str(tmp_path / "0105.csv"))
    wr.write_csv(spark.createDataFrame([("2",)], "a string"), str(tmp_path / "分-0106.csv"))
    wr.write_csv(spark.createDataFrame([("9",)], "a string"), str(tmp_path / "notes.csv"))
    assert rd.sheet_names(spark, str(tmp_path)) == ["0105", "notes", "分-0106"]
    assert rows(rd.read_sheets(spark, str(tmp_path), r"\d{4}"), "source", "a", "b") == [("0105", "1", "x"), ("分-0106", "2", None)]


def test_table_modes(spark, target, tmp_path):
    wr.create_table(target, "t_modes", path=str(tmp_path / "m"))
    with pytest.raises(Exception):
        wr.create_table(target, "t_modes", path=str(tmp_path / "m"))
    wr.create_table(target, "t_modes", "append", str(tmp_path / "m"))
    assert spark.table("t_modes").count() == 10
    wr.create_table(target, "t_modes", "replace", str(tmp_path / "m"))
    assert spark.table("t_modes").count() == 5
    with pytest.raises(ValueError):
        wr.insert_table(target, "t_absent")


def test_replace_may_read_its_own_target(spark, tmp_path):
    path = str(tmp_path / "self")
    spark.range(10).write.parquet(path)
    wr.replace_dataset(spark.read.parquet(path).where("id < 3"), path)
    assert spark.read.parquet(path).count() == 3
    wr.truncate_dataset(spark, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["id"]


def test_stage_snapshot_keeps_labels_and_variables(spark, target, tmp_path, rows):
    wr.save_stage(str(tmp_path), "s1", {"t": target}, {"end": dt.date(2024, 1, 31), "rate": 0.05}, spark)
    tables, variables = wr.load_stage(spark, str(tmp_path), "s1", ["t"])
    assert rows(tables["t"]) == rows(target) and variables == {"end": "2024-01-31", "rate": "0.05"}


def test_upsert_keeps_text_partition_keys_and_missing_keys(spark, tmp_path, rows):
    from ledgerloom.operators.tables import upsert
    from ledgerloom.sources.writers import upsert_dataset

    path = f"{tmp_path}/terms"
    spark.createDataFrame([("03", 1, "old"), ("06", 2, "old")], "term string, id int, v string").write.partitionBy("term").parquet(path)
    upsert_dataset(spark.createDataFrame([("03", 1, "new")], "term string, id int, v string"), path, ["term", "id"], partition_by=["term"])
    assert rows(spark.read.schema("term string, id int, v string").parquet(path), "term", "id", "v") == [("03", 1, "new"), ("06", 2, "old")]
    target = spark.createDataFrame([(None, "old"), (1, "old")], "k int, v string")
    assert rows(upsert(target, spark.createDataFrame([(None, "new")], "k int, v string"), ["k"]), "k", "v") == [(1, "old"), (None, "new")]


def test_files_without_a_header_keep_their_first_row(spark, tmp_path, rows):
    from ledgerloom.sources.readers import SourceSpec, read_csv, read_dirty_csv

    path = f"{tmp_path}/plain.csv"
    with open(path, "w", encoding="utf-8") as out:
        out.write("title\n1,x\n2,y\n")
    df = read_dirty_csv(spark, path, SourceSpec(encoding="utf-8", header=False, skip_rows=1))
    assert df.columns == ["_c0", "_c1"] and rows(df) == [("1", "x"), ("2", "y")]
    assert rows(read_csv(spark, path, header=False, skip_rows=1), "_c0", "_c1") == [("1", "x"), ("2", "y")]


def test_backup_first_copies_and_stops_on_lost_values(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "k string, v string")
    want = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    with pytest.raises(ValueError, match="'k': 1"):
        tb.evolve(df, want, "backup_first", backup=str(tmp_path / "old"))
    assert spark.read.parquet(str(tmp_path / "old")).count() == 3
    out, _ = tb.evolve(df.where("k is null or k != 'x'"), want, "backup_first", backup=str(tmp_path / "older"))
    assert dict(out.dtypes)["k"] == "bigint" and sorted(r[1] for r in out.collect()) == ["a", "c"]
    assert tb.evolve(df, want, "force")[0].where("k is null").count() == 2


def files_of(path):
    return {str(p.relative_to(path)): (p.stat().st_mtime_ns, p.stat().st_ino) for p in path.rglob("part-*.parquet")}


def test_upsert_keeps_the_rows_of_the_missing_partition(spark, tmp_path, rows):
    schema = "k int, p string, v string"
    path = str(tmp_path / "t")
    spark.createDataFrame([(2, None, "a"), (3, None, "b"), (4, "q", "c")], schema).repartition(3).write.partitionBy("p").parquet(path)
    wr.upsert_dataset(spark.createDataFrame([(2, None, "new")], schema), path, ["k", "p"], partition_by=["p"])
    assert rows(spark.read.schema(schema).parquet(path), "k", "p", "v") == [(2, None, "new"), (3, None, "b"), (4, "q", "c")]


@pytest.mark.parametrize("match", ["tuple", "columnwise"])
def test_upsert_rewrites_only_files_with_replaced_rows(spark, tmp_path, rows, match):
    path = tmp_path / "t"
    target = spark.range(1000).selectExpr("id AS k", "id % 7 AS g", "'old' AS v")
    target.repartitionByRange(10, "k").write.parquet(str(path))
    before = files_of(path)
    source = spark.createDataFrame([(5, 5, "new"), (20, 6, "new"), (950, 5, "new"), (5000, 1, "new")], "k bigint, g bigint, v string")
    touched = wr.upsert_dataset(source, str(path), ["k", "g"] if match == "tuple" else ["k"], match)
    after = files_of(path)
    assert len(touched) == 2 and len(before.keys() - after.keys()) == 2 and all(after[f] == before[f] for f in before.keys() & after.keys())
    assert rows(spark.read.parquet(str(path))) == rows(tb.upsert(target, source, ["k", "g"] if match == "tuple" else ["k"], match))
    assert wr.upsert_dataset(source.where("k = 5000"), str(path), ["k"]) and wr.upsert_dataset(source.where("k > 9000"), str(path), ["k"]) == []


def test_upsert_finds_files_with_odd_names(spark, tmp_path, rows):
    schema = "k int, p string, v string"
    odd = ["a b", "100%", "x/y", "[a]{b}*?", "é", "+", "a%20b", "_hidden"]
    spark.createDataFrame([(i, p, "old") for i, p in enumerate(odd)], schema).write.partitionBy("p").parquet(str(tmp_path / "t"))
    wr.upsert_dataset(spark.createDataFrame([(i, p, "new") for i, p in enumerate(odd)], schema), str(tmp_path / "t"), ["p"], partition_by=["p"])
    assert rows(spark.read.schema(schema).parquet(str(tmp_path / "t")), "k", "p", "v") == [(i, p, "new") for i, p in enumerate(odd)]


def test_a_failed_change_leaves_the_dataset(spark, tmp_path, rows):
    path = tmp_path / "t"
    spark.range(10).selectExpr("id AS k", "'old' AS v").repartition(2).write.parquet(str(path))
    before = files_of(path)
    bad = spark.range(1).selectExpr("id AS k", "raise_error('broken') AS v")
    with pytest.raises(Exception, match="broken"):
        wr.upsert_dataset(bad, str(path), ["k"])
    assert files_of(path).keys() >= before.keys() and rows(spark.read.parquet(str(path)), "v") == [("old",)] * 10
    wr.upsert_dataset(spark.createDataFrame([(1, "new")], "k bigint, v string"), str(path), ["k"])
    assert not list(path.glob("_change-*")) and spark.read.parquet(str(path)).where("v = 'new'").count() == 1 and spark.read.parquet(str(path)).count() == 10


@pytest.mark.parametrize("moved", [0, 1])
def test_a_decided_change_is_completed_later(spark, tmp_path, rows, monkeypatch, moved):
    from ledgerloom.sources import changes

    path = tmp_path / "t"
    spark.range(10).selectExpr("id AS k", "'old' AS v").repartition(2).write.parquet(str(path))
    publish, source = changes._publish, spark.createDataFrame([(1, "new"), (2, "new")], "k bigint, v string")

    def stop(spark, folder, change):
        for found, below in folder.files(change, "data")[:moved]:
            folder.fs.rename(found, folder.at(*below))
        raise KeyboardInterrupt

    monkeypatch.setattr(changes, "_publish", stop)
    with pytest.raises(KeyboardInterrupt):
        wr.upsert_dataset(source, str(path), ["k"])
    monkeypatch.setattr(changes, "_publish", publish)
    assert len(changes.finish_changes(spark, str(path))) == 1 and changes.finish_changes(spark, str(path)) == []
    spark.catalog.refreshByPath(str(path))
    assert rows(spark.read.parquet(str(path)), "k", "v") == [(k, "new" if k in (1, 2) else "old") for k in range(10)]


def lines_in(folder, **files):
    folder.mkdir()
    for stem, text in files.items():
        (folder / f"{stem}.csv").write_bytes(text.encode())
    return str(folder)


@pytest.mark.parametrize("cut", ["700", "128m"])
def test_head_lines_are_physical_and_go_once(spark, tmp_path, rows, cut):
    body = "".join(f"{i},x{i}\n" for i in range(300))
    path = lines_in(
        tmp_path / "in", a="title\n\nk,n\n1,x\n2,y\n" + body, b="other title\r\n\r\n\r\nk,n\r\n7,z\r\n", c="title\n\nk,n\ntitle\nk,n\nk,n\n\n3,\n" + body, d="title\n\n", e="", f="t\n \nk,n\n",
    )
    want = [("1", "x"), ("2", "y"), ("7", "z"), ("title", None), ("k", "n"), ("k", "n"), ("3", None)] + 2 * [(str(i), f"x{i}") for i in range(300)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
    try:
        for df in (rd.read_csv(spark, path, skip_rows=2), rd.read_dirty_csv(spark, path, rd.SourceSpec(skip_rows=2))):
            assert df.columns == ["k", "n"] and rows(df) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))


def test_skipping_takes_one_scan_and_no_copy(spark, tmp_path):
    path = lines_in(tmp_path / "in", a="title\n\nk,n\n1,x\n", b="title\n\nk,n\n2,y\n")
    plan = rd.read_csv(spark, path, skip_rows=2, multi_line=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Window" not in plan


@pytest.mark.parametrize("skip", [0, 2])
def test_quoted_cells_may_hold_line_breaks(spark, tmp_path, rows, skip):
    head = "report, made today\n\n"[: None if skip else 0]
    path = lines_in(tmp_path / "in", a=head + 'k,"amount\n(net)",c\n1,"two\nlines",x\n2,"a ""q""\n\nend",y\n', b=head + 'k,"amount\n(net)",c\n3,plain,z\n4,"5, six"\n5,a,b,c,d\n')
    want = [("1", "two\nlines", "x"), ("2", 'a "q"\n\nend', "y"), ("3", "plain", "z"), ("4", "5, six", None)]
    df = rd.read_dirty_csv(spark, path, rd.SourceSpec(skip_rows=skip))
    assert df.columns == ["k", "amount\n(net)", "c"]
    assert rows(df) == want and rd.read_csv(spark, path, skip_rows=skip).count() == 5
    assert rd.has_open_quotes(spark, path) and not rd.has_open_quotes(spark, lines_in(tmp_path / "plain", a='k,n\n1,"x, y"\n'))


def test_heads_of_packed_files(spark, tmp_path, rows):
    import gzip

    path = lines_in(tmp_path / "in", a="t\n\nk,n\n1,x\n")
    (tmp_path / "in" / "b c%.csv.gz").write_bytes(gzip.compress("été\n\nk,n\n2,ü\n".encode()))
    assert rd.header_names(spark, path, skip_rows=2) == ["k", "n"] and rows(rd.read_csv(spark, path, skip_rows=2)) == [("1", "x"), ("2", "ü")]


def test_conditions_see_no_head_cells(spark, tmp_path, rows):
    path = lines_in(tmp_path / "in", a="title\nk,n\n1,x\n12,y\n")
    assert rows(rd.read_csv(spark, path, skip_rows=1, where="CAST(k AS INT) > 5")) == [("12", "y")]


def test_quotes_survive_a_round_trip(spark, tmp_path, rows):
    data = [("1", 'say "hi"', "back\\slash"), ("2", "a,b\nc", '"'), ("3", None, "\\\"")]
    wr.write_csv(spark.createDataFrame(data, "k string, a string, b string"), str(tmp_path / "q"))
    assert rows(rd.read_csv(spark, str(tmp_path / "q"))) == data


def test_metadata_and_lineage_tell_files_apart(spark, tmp_path, rows):
    from ledgerloom.operators.shaping import ColumnSpec, SchemaConfig

    for folder, n in (("x", 2), ("y", 3)):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "same.csv").write_text("t\nk\n" + "".join(f"{i}\n" for i in range(n)), encoding="utf-8")
    (tmp_path / "in" / "y" / "other é+.csv").write_text("t\nk\n7\n", encoding="utf-8")
    meta = rd.source_metadata(spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "in")))
    assert rows(meta, "file", "n_rows") == [("other é+.csv", 3), ("same.csv", 4), ("same.csv", 5)]
    made = rd.build_table(spark, str(tmp_path / "in" / "y"), SchemaConfig([ColumnSpec("k", "k", "BIGINT")]), "b1", rd.SourceSpec(skip_rows=1))
    assert rows(made, "k", "_source_file") == [(0, "same.csv"), (1, "same.csv"), (2, "same.csv"), (7, "other é+.csv")]
    (tmp_path / "p").mkdir()
    made.select("k").coalesce(1).write.parquet(str(tmp_path / "p" / "d.parquet"))
    again = rd.build_table(spark, str(tmp_path / "p" / "d.parquet"), SchemaConfig([ColumnSpec("k", "k", "BIGINT")]), "b1")
    assert all(f.startswith("part-") for _, f in rows(again, "k", "_source_file"))


@pytest.mark.parametrize("header_row", [0, 2])
def test_sheets_align_by_name_in_one_scan(spark, tmp_path, rows, header_row):
    top = "made today,x\n\n" if header_row else ""
    for sheet, files in {"a b": ["k,v\n1,x\n", "v,k\ny,2\n"], "c[1]": ['v,w,"k\n(n)"\nz,5,7\n', "k,k\n8,9\n"], "d": ["k\n"], "other": ["q\n1\n"]}.items():
        folder = tmp_path / f"{sheet}.csv"
        folder.mkdir()
        for i, text in enumerate(files):
            (folder / f"f{i}.csv").write_text(top + text, encoding="utf-8")
    df = rd.read_sheets(spark, str(tmp_path), "^[acd]", header_row=header_row)
    assert set(df.columns) == {"k", "v", "w", "k\n(n)", "source"}
    want = [("1", "x", None, None, "a b"), ("2", "y", None, None, "a b"), ("8", None, None, None, "c[1]"), (None, "z", "5", "7", "c[1]")]
    assert rows(df, "k", "v", "w", "`k\n(n)`", "source") == want
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_plans_follow_the_data(spark):
    want = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.IntegerType()), T.StructField("new", T.StringType())])
    schema = "n string, d decimal(9,2), gone string, held string"
    from decimal import Decimal

    whole = spark.createDataFrame([("1", Decimal(5), None, None), ("22", Decimal(7), None, None), (None, None, None, None)], schema)
    assert tb.harmless_changes(whole, want) == {"n", "d", "gone", "held"}
    out, plan = tb.evolve(whole, want, "safe", by_data=True)
    assert out.dtypes == [("n", "bigint"), ("d", "int"), ("new", "string")] and plan.warnings == []
    assert tb.evolve(whole, want, "safe")[0].columns == ["n", "d", "gone", "held", "new"]
    for row, kept in ((("07", None, None, None), {"d", "gone", "held"}), ((None, Decimal("5.50"), None, None), {"n", "gone", "held"}), ((None, None, None, "x"), {"n", "d", "gone"})):
        df = whole.union(spark.createDataFrame([row], schema))
        assert tb.harmless_changes(df, want) == kept
        assert len(tb.evolve(df, want, "safe", by_data=True)[1].warnings) == 2
    profile = {r["column"]: r for r in tb.profile_changes(whole, want).collect()}
    assert profile["n"].max_length == 2 and profile["n"].low == "1" and profile["new"].n_values == 0 and profile["gone"].n_rows == 3
    assert tb.profile_changes(whole, whole.schema).count() == 0


def test_stages_restore_the_last_whole_version(spark, tmp_path, rows):
    root = str(tmp_path / "stages")
    a = spark.createDataFrame([(1, "x", [1, 2]), (2, None, None)], "k int, v string, l array<int>")
    b = spark.range(5).selectExpr("id", "CAST(NULL AS DATE) AS d")
    with pytest.raises(ValueError, match="no snapshot"):
        wr.load_stage(spark, root, "s", ["a"])
    assert wr.save_stage(root, "s", {"a": a, "b": b}, {"n": 1}, spark) == 1
    assert wr.save_stage(root, "s", {"a": a.orderBy("v"), "b": b.where("id > 2")}, {"n": 2}, spark) == 2
    assert not (tmp_path / "stages" / "s" / "v000002" / "tables" / "a").exists()  # as it was: the files of version 1 serve
    with pytest.raises(Exception, match="stopped"):
        wr.save_stage(root, "s", {"a": a.limit(0), "b": b.selectExpr("raise_error('stopped') AS x")}, {"n": 3}, spark)
    assert wr.stage_versions(spark, root, "s") == [1, 2]
    tables, variables = wr.load_stage(spark, root, "s", ["a", "b"], verify=True)
    assert variables == {"n": "2"} and rows(tables["b"], "id") == [(3,), (4,)] and rows(tables["a"], "k") == [(1,), (2,)] and tables["b"].dtypes[1] == ("d", "date")
    assert wr.load_stage(spark, root, "s", ["b"], version=1)[0]["b"].count() == 5
    assert wr.save_stage(root, "s", {"a": a.limit(0)}, {}, spark) == 4 and wr.load_stage(spark, root, "s", ["a"])[0]["a"].columns == ["k", "v", "l"]
    with pytest.raises(ValueError, match="no tables"):
        wr.load_stage(spark, root, "s", ["b"])
    next((tmp_path / "stages" / "s" / "v000001" / "tables" / "b").glob("part-*.parquet")).unlink()
    spark.catalog.refreshByPath(root)
    with pytest.raises(ValueError, match="not as it was saved"):
        wr.load_stage(spark, root, "s", ["b"], version=1, verify=True)
