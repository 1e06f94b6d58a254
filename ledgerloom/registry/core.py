"""The registry: name -> (query over the given tables, check SQL, operators covered)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.registry.views import checked_by


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    check: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def shown(df: DataFrame, nullable: tuple[str, ...] = ()) -> DataFrame:
    """Result types that both engines print alike: doubles for decimals, text for dates. Whole numbers
    and flags that may be missing are named, they become doubles and text."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("bigint")
        if f.name in nullable:
            col = col.cast("string" if isinstance(f.dataType, T.BooleanType) else "double")
        out.append(col.alias(f.name))
    return df.select(*out)


def _with_types(sql: str, nullable: dict[str, str]) -> str:
    if not nullable:
        return sql
    casts = ", ".join(f'CAST("{c}" AS {t}) AS "{c}"' for c, t in nullable.items())
    return f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) shown"


def register(
    name: str, covers: str, check: str | None = None, ctes: dict[str, str] | None = None, nullable: dict[str, str] | None = None
):
    """Add a query. ``check`` is DuckDB SQL over the given tables and the views of ``ctes``;
    ``nullable`` maps whole numbers and flags that may be missing to their type in the check."""
    missing = nullable or {}

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise KeyError(name)
        sql = _with_types(checked_by(check, ctes), missing) if check else None
        REGISTRY[name] = Entry(lambda spark, sf: shown(fn(spark, sf), tuple(missing)), sql, tuple(covers.split()))
        return fn

    return wrap
