"""Lines above the data of text files: titles, blank lines, the header.

A head is counted in physical lines, blank ones included, and read from the start of each file. The scan of the data does not number
rows: a row is a head row if its file and all its cells are those of one of the file's head lines. Where a data row looks the
same, as many rows as the file has head lines of that kind go, and the other copies stay; since equal rows cannot be told
apart it does not matter which. So the result does not depend on how files are cut into splits, and no row is copied.
"""

from __future__ import annotations

import csv
import io
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import name
from ledgerloom.operators.literals import literal_table
from ledgerloom.session import settle

#: files opened at once
READERS = 16


def is_open(text: str) -> bool:
    """A quoted cell goes on behind the end of the text."""
    return text.count('"') % 2 == 1


@dataclass(frozen=True)
class Head:
    """The first lines of a file, as records: those above the header, and the header (None if the file ends before)."""

    file: str
    above: tuple[str, ...]
    header: str | None

    def names(self, sep: str) -> list[str]:
        return next(csv.reader(io.StringIO(self.header or "", newline=""), delimiter=sep), [])


def _lines(spark: SparkSession, file: str, charset: str):
    """Physical lines of a file from its start, unpacked if its name tells a codec."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, charset))
    try:
        first = True
        while (line := reader.readLine()) is not None:
            yield line.removeprefix("﻿") if first else line
            first = False
    finally:
        reader.close()


def read_head(spark: SparkSession, file: str, skip: int, charset: str, multi_line: bool) -> Head:
    """``skip`` physical lines, and the record behind them and behind blank lines, the header. With ``multi_line`` a record whose quotes are
    open at the end of its line goes on."""
    above: list[str] = []
    held, n = "", 0
    for line in _lines(spark, file, charset):
        n += 1
        held = f"{held}\n{line}" if held else line
        if multi_line and is_open(held) and n != skip:
            continue
        if n > skip and held.strip():
            return Head(file, tuple(above), held)
        above.append(held)
        held = ""
    return Head(file, tuple([*above, held] if held else above), None)


def file_heads(spark: SparkSession, path: str | list[str], skip: int, charset: str, multi_line: bool) -> list[Head]:
    """The heads of all files of a path, by file name: a few lines of each file."""
    # names as scans write them, where an empty host has no slashes
    files = sorted(re.sub("^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", f) for f in spark.read.text(path).inputFiles())
    one = inheritable_thread_target(spark)(lambda f: read_head(spark, f, skip, charset, multi_line))
    with ThreadPoolExecutor(READERS) as pool:
        return list(pool.map(one, files))


def _alike(columns: list[str], prefix: str) -> Column:
    same = F.col("_file") == F.col(f"{prefix}file")
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(prefix + c))
    return same


def without_heads(rows: DataFrame, heads: list[Head], with_header: bool, options: dict[str, str]) -> DataFrame:
    """``rows`` (text columns and ``_file``, the file's path as in ``heads``) without those of the heads.

    One count over the first column tells whether any other row could look like a head row; only then the other columns are compared too.
    Cells of head rows are NULL before the rows go: a condition on the result may be evaluated first.
    """
    spark, columns = rows.sparkSession, [c for c in rows.columns if c != "_file"]
    texts = [(h.file, t) for h in heads for t in [*h.above, *([h.header] if with_header and h.header else [])] if t.strip()]
    if not texts:
        return rows
    shape = ", ".join(f"{name(c)} string" for c in columns)
    parsed = literal_table(spark, texts, "_file string, _text string").select("_file", F.from_csv("_text", shape, options).alias("_x"))
    parsed = parsed.select(F.col("_file").alias("_h_file"), *[F.col(f"_x.{c}").alias(f"_h_{c}") for c in columns])
    known = parsed.groupBy(*parsed.columns).agg(F.count(F.lit(1)).alias("_h_n"))

    looks = parsed.select("_h_file", f"_h_{columns[0]}").distinct()
    if rows.join(looks, _alike(columns[:1], "_h_"), "left_semi").count() == len(texts):
        more = None
    else:
        found = rows.join(known, _alike(columns, "_h_")).groupBy("_file", *columns).agg((F.count(F.lit(1)) - F.first("_h_n")).alias("_more"))
        found = settle(found, "rows_like_heads")
        if found.where("_more >= 0").count() != known.count():
            raise ValueError("lines above the header do not read as records of their own; a quoted cell may go on below them")
        more = found.where("_more > 0")
        more = None if more.isEmpty() else more.select(*columns, "_file", F.explode(F.sequence(F.lit(1), F.col("_more").cast("int"))).alias("_i")).drop("_i")
    marked = rows.join(known.withColumn("_is_head", F.lit(True)), _alike(columns, "_h_"), "left")
    body = F.col("_is_head").isNull()
    kept = marked.where(body).select(*[F.when(body, F.col(c)).alias(c) for c in columns], "_file")
    return kept if more is None else kept.union(more)
