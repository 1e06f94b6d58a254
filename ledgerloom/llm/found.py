"""Matches of regular expressions in text columns with their places in code points, by column functions only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCH = "array<struct<s:int,e:int,v:string,c:string>>"
SPAN = "array<struct<s:int,k:int,e:int,kind:string>>"


def _whole(gap: Column) -> Column:
    return gap


def matches(text: Column, pattern: str, gate: str | None = None, context: Callable[[Column], Column] = _whole) -> Column:
    """Leftmost matches without overlap: start, end (exclusive), value, and what ``context`` takes of the text between the match before and this one.
    The text between matches comes from splitting at the pattern, so the lengths of both add up to the places. Texts without
    ``gate`` (by default the pattern) are not split."""
    parts = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(F.char_length(gap).alias("g"), context(gap).alias("c"), value.alias("v")),
    )

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + part["g"]
        end = start + F.coalesce(F.char_length(part["v"]), F.lit(0))
        one = F.array(F.struct(start.alias("s"), end.alias("e"), part["v"].alias("v"), part["c"].alias("c")))
        return F.struct(end.alias("at"), F.when(part["v"].isNull(), state["out"]).otherwise(F.concat(state["out"], one)).alias("out"))

    none = F.array().cast(MATCH)
    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda state: state["out"])
    return F.when(text.rlike(gate or pattern), found).otherwise(none)


def spans(kind: str, order: int, found: Column) -> Column:
    """Matches as spans of a kind; ``order`` is its place among spans with the same start."""
    return F.transform(found, lambda m: F.struct(m["s"].alias("s"), F.lit(order).alias("k"), m["e"].alias("e"), F.lit(kind).alias("kind"))).cast(SPAN)


def listed(*parts: Column) -> Column:
    """All spans by start, then by kind."""
    return F.array_sort(F.concat(*parts)) if len(parts) > 1 else F.array_sort(parts[0])


def written(all_spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(all_spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def apart(found: Column, *others: Column) -> Column:
    """Matches that overlap none of the others."""
    test: Callable[[Column], Column] = lambda m: ~reduce(lambda a, b: a | b, [F.exists(o, lambda x: (x["s"] < m["e"]) & (m["s"] < x["e"])) for o in others])
    return F.filter(found, test)
