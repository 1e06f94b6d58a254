"""Readers: CSV, Parquet, JSON, sheet extracts, file listings, SQL."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import name
from ledgerloom.operators.literals import literal_table
from ledgerloom.operators.quality import silver
from ledgerloom.operators.shaping import SchemaConfig, add_lineage, normalize_names
from ledgerloom.sources.heads import Head, file_heads, without_heads

# Reader by file suffix, and the charsets Spark reads without the legacy setting.
READER_OF_SUFFIX = {".csv": "csv", ".txt": "csv", ".parquet": "parquet", ".pq": "parquet", ".json": "json",
                    ".xlsx": "sheet", ".xls": "sheet", ".xlsm": "sheet"}
PLAIN_CHARSETS = {"UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32"}
CP950 = "x-windows-950"
# Fixed value: a quote inside a quoted cell is written twice.
QUOTES = {"quote": '"', "escape": '"'}


@dataclass(frozen=True)
class SourceSpec:
    file_type: str = "csv"
    encoding: str = "UTF-8"
    delimiter: str = ","
    header: bool = True
    skip_rows: int = 0
    as_text: bool = True
    sheet: str | None = None
    multi_line: bool | None = None


def _charset(spark: SparkSession, encoding: str) -> str:
    """Java name of a charset; one outside the plain set needs the legacy setting for the session."""
    java = CP950 if encoding.lower() in ("cp950", "big5", "ms950") else encoding.upper()
    if java not in PLAIN_CHARSETS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return java


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if every line decodes, else cp950. Stops at the first line that does not."""
    bad = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1)
    return "cp950" if bad.count() else "UTF-8"


def has_open_quotes(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> bool:
    """Whether a line has a quote that a later line closes. Stops at the first such line."""
    lines = spark.read.option("encoding", _charset(spark, encoding)).csv(path, sep="\u0001", header=False, quote="", schema="value string")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).limit(1).isEmpty()


def _file_name() -> Column:
    """A scan gives the names of files with URI escapes, in which a plus is a plus."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _names(heads: list[Head], sep: str, header: bool) -> list[str]:
    """Names from the header of the first file that has one, or ``_c0``, ``_c1``, ... if there is none."""
    first = next((h.names(sep) for h in heads if h.header is not None), [])
    return first if header else [f"_c{i}" for i in range(len(first))]


def header_names(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", skip_rows: int = 0, multi_line: bool = True) -> list[str]:
    """Column names from the header, found below ``skip_rows`` physical lines; blank lines before it do not count as one."""
    return _names(file_heads(spark, path, skip_rows, _charset(spark, encoding), multi_line), sep, True)


def _text_rows(
    spark: SparkSession, path: str, sep: str, encoding: str, header: bool, skip_rows: int, multi_line: bool | None, more: tuple[str, ...] = (),
    source: str | None = None,
) -> DataFrame:
    """All cells as text, without the lines down to the header; ``more`` names columns for cells beyond the header's, ``source`` one for the name
    of each row's file."""
    charset = _charset(spark, encoding)
    whole = has_open_quotes(spark, path, encoding) if multi_line is None else multi_line
    heads = file_heads(spark, path, skip_rows, charset, whole)
    names = [*_names(heads, sep, header), *more]
    held = [f"_c{i}" for i in range(len(names))]  # names that can be compared, whatever the header says
    schema = T.StructType([T.StructField(c, T.StringType()) for c in held])
    options = {"sep": sep, "mode": "PERMISSIVE", **QUOTES}
    reader = spark.read.options(**options).option("encoding", charset).option("multiLine", whole).schema(schema)
    file = [source] if source else []
    if not skip_rows:
        rows = reader.option("header", header).option("enforceSchema", True).csv(path)
        return rows.select("*", *[_file_name().alias(c) for c in file]).toDF(*names, *file)
    rows = reader.option("header", False).csv(path).select("*", F.col("_metadata.file_path").alias("_file"))
    rows = without_heads(rows, heads, header, options)
    last = F.url_decode(F.replace(F.regexp_extract("_file", "([^/]*)$", 1), F.lit("+"), F.lit("%2B")))
    return rows.select(*held, *[last.alias(c) for c in file]).toDF(*names, *file)


def read_csv(
    spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True, schema: T.StructType | str | None = None,
    null_values: list[str] | None = None, dates: dict[str, str] | None = None, columns: list[str] | None = None,
    limit: int | None = None, skip_rows: int = 0, where: str | Column | None = None, multi_line: bool | None = None,
) -> DataFrame:
    """CSV scan. Without a schema every column is text, so no inference pass is made.

    ``skip_rows`` physical lines above the header, blank ones included, are dropped per file. ``multi_line`` says whether quoted cells hold line
    breaks; such files are read whole by one task each. If it is not given, the lines are searched for an open quote first, which
    takes one more pass over the text. ``where`` must be a valid condition.
    """
    if schema is None or skip_rows:
        df = _text_rows(spark, path, sep, encoding, header, skip_rows, multi_line)
        if schema is not None:
            want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            df = df.select(*[F.col(name(c)).try_cast(f.dataType).alias(f.name) for c, f in zip(df.columns, want.fields)])
    else:
        whole = has_open_quotes(spark, path, encoding) if multi_line is None else multi_line
        reader = spark.read.options(**QUOTES).option("encoding", _charset(spark, encoding)).option("sep", sep).option("multiLine", whole)
        df = reader.option("header", header).schema(schema).csv(path)
    if columns:
        df = df.select(*[name(c) for c in columns])
    if null_values:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: F.when(~F.col(name(c)).isin(*null_values), F.col(name(c))) for c in texts})
    if dates:
        df = df.withColumns({c: F.try_to_timestamp(F.col(name(c)).cast("string"), F.lit(p)).cast("date") for c, p in dates.items()})
    if where is not None:
        df = df.where(where)
    return df.limit(limit) if limit is not None else df


def read_dirty_csv(spark: SparkSession, path: str, spec: SourceSpec = SourceSpec(), source: str | None = None) -> DataFrame:
    """All-text CSV; records with too many fields are left out, short ones are filled with NULL.

    ``encoding='auto'`` tries UTF-8 and falls back to cp950. ``source`` names a column for the file of each row.
    """
    encoding = detect_encoding(spark, path) if spec.encoding == "auto" else spec.encoding
    rows = _text_rows(spark, path, spec.delimiter, encoding, spec.header, spec.skip_rows, spec.multi_line, ("_overflow",), source)
    return rows.where(F.col("_overflow").isNull()).drop("_overflow")


def read_parquet(
    spark: SparkSession, path: str, columns: list[str] | None = None, where: str | Column | None = None
) -> DataFrame:
    """Parquet scan; the filter and the column list reach the reader."""
    df = spark.read.parquet(path)
    df = df.where(where) if where is not None else df
    return df.select(*[name(c) for c in columns]) if columns else df


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(name(c)).cast("string").alias(c) for c in df.columns])


def read_json(spark: SparkSession, path: str, text: bool = True, multi_line: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """JSON documents; ``multi_line`` off reads one document per line and splits large files."""
    df = _json(spark, path, text, multi_line, encoding)
    return as_text(df) if text else df


def _json(spark: SparkSession, path: str, text: bool, multi_line: bool = True, encoding: str = "UTF-8") -> DataFrame:
    reader = spark.read.option("multiLine", multi_line).option("primitivesAsString", text)
    if encoding.upper() != "UTF-8":
        reader = reader.option("encoding", _charset(spark, encoding))
    return reader.json(path)


def file_type(path: str, hint: str = "csv") -> str:
    found = re.search(r"\.[A-Za-z]+$", path.rstrip("/"))
    return READER_OF_SUFFIX.get(found.group(0).lower(), hint) if found else hint


def read_any(spark: SparkSession, path: str, spec: SourceSpec = SourceSpec(), source: str | None = None) -> DataFrame:
    """Reader by suffix, else by the hint of the specification. ``source`` names a column for the file of each row."""
    kind = file_type(path, spec.file_type)
    told = [_file_name().alias(source)] if source else []
    if kind == "csv":
        return read_dirty_csv(spark, path, spec, source)
    if kind == "parquet":
        df = spark.read.parquet(path).select("*", *told)
        return as_text(df) if spec.as_text else df
    if kind == "json":
        df = _json(spark, path, spec.as_text).select("*", *told)
        return as_text(df) if spec.as_text else df
    if kind == "sheet":
        raise ValueError(f"{path}: binary workbooks are not read; give one extract per sheet to read_sheet")
    raise ValueError(f"no reader for {path}")


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """Files by glob as (path, length, modified); file contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
        .load(folder).select("path", "length", F.col("modificationTime").alias("modified"))
    )


def sheet_names(spark: SparkSession, folder: str) -> list[str]:
    """Sheets of an extract folder: one sub-folder ``<sheet>.<format>`` each."""
    sheet = F.regexp_extract(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), r"([^/]+)\.(?:csv|parquet)/[^/]+$", 1)
    rows = list_files(spark, folder).select(sheet.alias("s")).where("s <> ''").distinct().orderBy("s").collect()
    return [r["s"] for r in rows]


def read_sheet(
    spark: SparkSession, folder: str, sheet: str, fmt: str = "csv", header_row: int = 0, columns: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One sheet of an extract folder as text, its header ``header_row`` lines down."""
    path = f"{folder}/{sheet}.{fmt}"
    if fmt == "parquet":
        df = as_text(read_parquet(spark, path, columns))
        return df.limit(limit) if limit is not None else df
    return read_csv(spark, path, columns=columns, skip_rows=header_row, limit=limit)


def read_sheets(
    spark: SparkSession, folder: str, pattern: str = ".", fmt: str = "csv", header_row: int = 0, multi_line: bool | None = None, tag: str = "source"
) -> DataFrame:
    """Sheets whose name matches ``pattern``, united by column name, tagged with their name.

    Text sheets are read by one scan however many they are: every file's own header says which name stands at which place, and cells come under
    their names through that table. Of columns with the same name in one file the first counts; a sheet without a column has NULL there.
    """
    from ledgerloom.operators.joins import union_tagged

    chosen = [s for s in sheet_names(spark, folder) if re.search(pattern, s)]
    if not chosen:
        raise ValueError(f"no sheet of {folder} matches {pattern}")
    if fmt != "csv":
        return union_tagged({s: read_sheet(spark, folder, s, fmt, header_row) for s in chosen}, tag)

    paths = [f"{folder}/" + re.sub(r"([\\{}\[\]*?])", r"\\\1", s) + f".{fmt}" for s in chosen]
    whole = has_open_quotes(spark, paths) if multi_line is None else multi_line
    heads = [h for h in file_heads(spark, paths, header_row, "UTF-8", whole) if h.header is not None]
    order = {s: i for i, s in enumerate(chosen)}
    found = sorted(((h, h.names(","), unquote(h.file.split("/")[-2]).removesuffix(f".{fmt}")) for h in heads), key=lambda x: order[x[2]])
    names = list(dict.fromkeys(n for _, given, _ in found for n in given))
    places = [(h.file, sheet, [given.index(n) if n in given else -1 for n in names]) for h, given, sheet in found]
    held = [f"_c{i}" for i in range(max([len(given) for _, given, _ in found], default=1))]

    options = {"sep": ",", "mode": "PERMISSIVE", **QUOTES}
    schema = T.StructType([T.StructField(c, T.StringType()) for c in held])
    reader = spark.read.options(**options).option("multiLine", whole).option("header", not header_row).option("enforceSchema", True).schema(schema)
    rows = reader.csv(paths).select("*", F.col("_metadata.file_path").alias("_file"))
    rows = without_heads(rows, heads, True, options) if header_row else rows
    table = literal_table(spark, places, "_of string, _sheet string, _at array<int>")
    cell = lambda i: F.when(F.col("_at")[i] >= 0, F.get(F.array(*held), F.col("_at")[i]))
    return rows.join(table, F.col("_file") == F.col("_of")).select(*[cell(i).alias(n) for i, n in enumerate(names)], F.col("_sheet").alias(tag))


def preview(df: DataFrame, n_rows: int = 10, order: list[str] | None = None) -> dict:
    """Columns with types, also as a table, the first rows, by ``order`` or as the scan gives them, and the shape."""
    types = [(i, c, t) for i, (c, t) in enumerate(df.dtypes)]
    return {
        "columns": df.dtypes,
        "types": literal_table(df.sparkSession, types, "position int, column string, type string"),
        "rows": (df.orderBy(*[name(c) for c in order]) if order else df).limit(n_rows),
        "shape": df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")),
    }


def source_metadata(df: DataFrame) -> DataFrame:
    """Per source file of a scan, told apart by the whole path: its name, rows, bytes, change time. Files without rows do not show."""
    meta = df.select(
        F.col("_metadata.file_path").alias("path"), _file_name().alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    return meta.groupBy("path", "file").agg(F.count(F.lit(1)).alias("n_rows"), F.max("size").alias("size"), F.max("modified").alias("modified"))


def query(spark: SparkSession, sql: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL text over named DataFrames (``{name}``) with bound values (``:name``)."""
    return spark.sql(sql, args=args, **tables) if args else spark.sql(sql, **tables)


def query_row(spark: SparkSession, sql: str, **tables: DataFrame) -> Row | None:
    return query(spark, sql, **tables).first()


def query_value(spark: SparkSession, sql: str, **tables: DataFrame):
    row = query_row(spark, sql, **tables)
    return row[0] if row else None


def count_rows(df: DataFrame, where: str | None = None) -> int:
    return (df.where(where) if where else df).count()


def bronze(df: DataFrame, batch_id: str, source_file: str | Column = "unknown", sheet: str = "", normalize: bool = True) -> DataFrame:
    """Raw text under clean names with lineage columns."""
    return add_lineage(normalize_names(df) if normalize else df, batch_id, source_file, sheet)


def build_table(spark: SparkSession, path: str, schema: SchemaConfig, batch_id: str, spec: SourceSpec = SourceSpec(),
                validate: bool = True) -> DataFrame:
    """File or folder of files to clean table: read as text, bronze with the name of each row's file, silver."""
    raw = read_any(spark, path, spec, "ledgerloom_source_file")
    named = bronze(raw, batch_id, F.col("ledgerloom_source_file"), spec.sheet or "").drop("ledgerloom_source_file")
    return silver(named, schema, validate)
