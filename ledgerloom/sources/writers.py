"""Writers: files, workpaper sets, catalog tables, stage snapshots."""

from __future__ import annotations

import datetime as dt
import json
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import name
from ledgerloom.operators.literals import literal_table
from ledgerloom.operators.tables import matching, upsert
from ledgerloom.reference_data import WORKPAPER_SHEETS
from ledgerloom.sources import changes
from ledgerloom.sources.changes import change_files

# What happens when a table exists, and the save mode for it.
SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, sep: str = ",", encoding: str = "UTF-8") -> None:
    df.write.mode(mode).option("header", header).option("sep", sep).option("escape", '"').option("encoding", encoding).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, compression: str = "snappy") -> None:
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_any(df: DataFrame, path: str, file_type: str | None = None, mode: str = "overwrite") -> None:
    """Format by suffix, or as named."""
    kind = file_type or path.rsplit(".", 1)[-1].lower()
    if kind == "csv":
        write_csv(df, path, mode)
    elif kind in ("parquet", "pq"):
        write_parquet(df, path, mode)
    elif kind == "json":
        df.write.mode(mode).option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"no writer for {kind}")


def write_workpapers(results: dict[str, DataFrame], folder: str, fmt: str = "parquet", order: list[tuple[str, str]] | None = None) -> list[str]:
    """One dataset ``<sheet>.<fmt>`` per known result, in the fixed order; missing results are skipped."""
    written = []
    for key, sheet in order or WORKPAPER_SHEETS:
        if key in results:
            write_any(results[key], f"{folder}/{sheet}.{fmt}", fmt)
            written.append(sheet)
    return written


def create_table(df: DataFrame, table: str, if_exists: str = "fail", path: str | None = None) -> None:
    """Catalog table from a frame: fail, replace or append when it exists."""
    writer = df.write.mode(SAVE_MODES[if_exists]).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def insert_table(df: DataFrame, table: str) -> None:
    """Insert by position; the table must exist."""
    if not df.sparkSession.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    df.write.insertInto(table)


def clone_schema(spark: SparkSession, source: str, target: str, path: str | None = None) -> None:
    """Empty table with the schema of another."""
    create_table(spark.table(source).limit(0), target, path=path)


def replace_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Put the rows of ``df``, which may itself read the dataset, in place of a dataset's rows (see ``changes.change_files``)."""
    change_files(df, path, changes.data_files(df.sparkSession, path), partition_by)


def upsert_dataset(source: DataFrame, path: str, keys: list[str], match: str = "tuple", partition_by: list[str] | None = None) -> list[str]:
    """Upsert into a Parquet dataset; gives back the files that were rewritten.

    One scan of the key columns finds the files that hold replaced rows. Only these are read in full and rewritten, together with the
    source and without the replaced rows; all other files stay as they are, whatever partitions they are in. What is written is
    written once and then published (see ``changes.change_files``): a job that fails leaves the dataset as it was. Missing keys and missing partition
    values equal each other in ``tuple`` matching. Partition columns are read with the types they have in the source: inferred from folder names, a
    text key such as ``03`` would come back as a number and match nothing.
    """
    spark = source.sparkSession
    changes.finish_changes(spark, path)
    found = spark.read.parquet(path).schema
    own = {f.name: f.dataType for f in source.schema.fields if f.name in (partition_by or [])}
    schema = T.StructType([T.StructField(f.name, own.get(f.name, f.dataType)) for f in found.fields])
    target = spark.read.schema(schema).parquet(path)
    replaced = matching(target.select("*", F.col("_metadata.file_path").alias("_upsert_file")), source, keys, match)
    # names of files, as many as the dataset has at most
    touched = sorted(r[0] for r in replaced.select("_upsert_file").distinct().collect())
    rows = source.select(*[name(f.name) for f in schema.fields])
    if touched:
        rewritten = spark.read.schema(schema).option("basePath", path).parquet(*changes.readable(spark, path, touched))
        rows = upsert(rewritten, source, keys, match)
    change_files(rows, path, touched, partition_by)
    return touched


def write_statements(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Statement facts, one folder per table, in date order inside.

    Range partitioning by table, date and row number splits a large bank over many files and keeps
    each file to a few dates, so a period query skips the others by their footers.
    """
    order = ["bank", "category", "disbursement_date", "seq"]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode(mode).partitionBy("bank", "category").parquet(path)


def point_table(spark: SparkSession, table: str, path: str) -> None:
    """Let a catalog table read a finished dataset: publishing moves no data."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path, "parquet")


def truncate_dataset(spark: SparkSession, path: str) -> None:
    """No rows, same schema: a file without rows in place of all others."""
    replace_dataset(spark.createDataFrame([], spark.read.parquet(path).schema), path)


def backup_table(df: DataFrame, folder: str, table: str, fmt: str = "parquet", stamp: dt.datetime | None = None) -> str:
    """Copy under a time-stamped name; gives the path back."""
    path = f"{folder}/{table}_backup_{(stamp or dt.datetime.now()):%Y%m%d_%H%M%S}.{fmt}"
    write_any(df, path, fmt, "error")
    return path


def append_history(df: DataFrame, path: str, stamp: dt.datetime | None = None) -> None:
    """Append with the time of the update."""
    at = F.lit(f"{stamp:%Y-%m-%d %H:%M:%S}") if stamp else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    df.withColumn("updated_at", at).write.mode("append").parquet(path)


def write_display(df: DataFrame, path: str) -> None:
    """The latest state only."""
    df.write.mode("overwrite").parquet(path)


def _fingerprint(df: DataFrame) -> list:
    """Counts that tell tables apart whatever the order of their rows: rows, and two sums over a hash of each row."""
    cells = [F.to_json(F.struct(F.col(name(f.name)))) if isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)) else F.col(name(f.name)) for f in df.schema.fields]
    whole = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return [F.count(F.lit(1)).alias("n_rows"), F.concat_ws(":", whole(1), whole(2)).alias("mark")]


MANIFEST = "label string, path string, n_rows bigint, schema string, mark string"


def save_stage(root: str, stage: str, tables: dict[str, DataFrame], variables: dict[str, Any], spark: SparkSession) -> int:
    """Snapshot of a stage under a new version, whose number it gives back: one dataset per named table, a table of its variables, and last a
    manifest that says where each table lies, how many rows it has and of which schema.

    Only a version with a manifest counts, so one that broke off is never restored. Rows are counted and marked while they are written. A table
    that is as it was in the last version is not kept twice: the manifest points at the old files.
    """
    folder = changes.Folder(spark, f"{root}/{stage}")
    known = {r["label"]: r for r in _manifest(spark, root, stage)}
    version = max([int(v[1:]) for v in folder.names() if v.startswith("v") and v[1:].isdigit()], default=0) + 1
    top, rows = f"{root}/{stage}/v{version:06d}", []
    for label, df in tables.items():
        path, seen = f"{top}/tables/{label}", Observation()
        df.observe(seen, *_fingerprint(df)).write.parquet(path)
        n_rows, mark = seen.get["n_rows"], seen.get["mark"]
        old, schema = known.get(label), df.schema.json()
        if old and (old["n_rows"], old["schema"], old["mark"]) == (n_rows, schema, mark):
            folder.fs.delete(folder.at(f"v{version:06d}", "tables", label), True)
            path = old["path"]
        rows.append((label, path, n_rows, schema, mark))
    kept = [(k, type(v).__name__, str(v)) for k, v in sorted(variables.items())]
    literal_table(spark, kept, "name string, kind string, value string").write.parquet(f"{top}/variables")
    literal_table(spark, rows, MANIFEST).coalesce(1).write.parquet(f"{top}/manifest")
    return version


def _manifest(spark: SparkSession, root: str, stage: str, version: int | None = None) -> list[Row]:
    """The manifest of a version, by default the last that is whole; nothing if there is none."""
    number = stage_versions(spark, root, stage)[-1:] if version is None else [version]
    return spark.read.schema(MANIFEST).parquet(f"{root}/{stage}/v{number[0]:06d}/manifest").collect() if number else []


def stage_versions(spark: SparkSession, root: str, stage: str) -> list[int]:
    """Versions of a stage that are whole, in order."""
    folder = changes.Folder(spark, f"{root}/{stage}")
    return sorted(int(v[1:]) for v in folder.names() if v.startswith("v") and v[1:].isdigit() and folder.exists(v, "manifest", "_SUCCESS"))


def load_stage(
    spark: SparkSession, root: str, stage: str, labels: list[str], version: int | None = None, verify: bool = False
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Tables and variables of a stage as they were saved, by default of the last version that is whole. ``verify`` reads the tables and
    holds rows and values against the manifest."""
    number = version or (stage_versions(spark, root, stage) or [None])[-1]
    if number is None:
        raise ValueError(f"stage {stage} has no snapshot that is whole")
    saved = {r["label"]: r for r in _manifest(spark, root, stage, number)}
    if absent := [x for x in labels if x not in saved]:
        raise ValueError(f"stage {stage} has no tables {absent}")
    tables = {x: spark.read.schema(T.StructType.fromJson(json.loads(saved[x]["schema"]))).parquet(saved[x]["path"]) for x in labels}
    for x, df in tables.items() if verify else ():
        found = df.agg(*_fingerprint(df)).first()
        if (found["n_rows"], found["mark"]) != (saved[x]["n_rows"], saved[x]["mark"]):
            raise ValueError(f"table {x} of stage {stage} is not as it was saved")
    stored = spark.read.parquet(f"{root}/{stage}/v{number:06d}/variables").collect()
    return tables, {r["name"]: r["value"] for r in stored}
