"""Secret scan with multipart credential linking, by DataFrame functions only.

Strong patterns are reported wherever they stand. Weaker parts of a credential (an identifier, a value that looks like a key, an
endpoint) say nothing alone: they are reported only if a part of another role stands within the same scope, ``SCOPE`` code points of
the same text. Parts are joined by interval: a part lies in the bin of its start, and is joined, as a
semi-join, with the parts of its own and the two neighbouring bins that are near enough. A bin holds few parts, whatever the size of the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import found
from ledgerloom.session import settle

#: fixed values: the base patterns, in the order of kinds
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
MIN_VALUE, MIN_ACCESS = 8, 16
#: fixed values: weak parts by role
WEAK = {
    "identifier": r"""(?<![A-Za-z0-9_])(?i:user(?:name)?|login|account(?:_?id)?|client_?id|key_?id|access_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    "value": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
    "endpoint": r"""(?<![A-Za-z])(?i:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ftp)://[^\s"'<>]{4,}+|(?<![A-Za-z0-9_])(?i:host|hostname|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:/-]{4,}""",
}
#: what a whole weak match must hold besides
HOLDS = {"value": ("[0-9]", "[A-Za-z]")}
#: what must stand in a text that a weak pattern is tried on
GATES = {"identifier": r"(?i)(?:user|login|account|client|key|access)[a-z_]*[\"']?\x20*[:=]", "value": r"[0-9]", "endpoint": r"(?i)://|(?:host|endpoint|server)"}
#: code points between the starts of two linked parts, at most
SCOPE = 240

KINDS = ("assign", "access", "hex", "weak_identifier", "weak_value", "weak_endpoint")
#: the role of each strong kind
ROLES = {"assign": "value", "access": "identifier", "hex": "value"}


def _found(text: Column, pattern: str, gate: str | None = None) -> Column:
    return found.matches(text, pattern, gate, lambda gap: F.lit(""))


def _weak(text: Column, role: str) -> Column:
    every = _found(text, WEAK[role], GATES[role])
    return reduce(lambda some, sign: F.filter(some, lambda m: m["v"].rlike(sign)), HOLDS.get(role, ()), every)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, txt, base, spans): for every row the strong spans and all spans, as (start, order, end, kind) by start and kind, in code
    points. ``txt``, a hash of the text, tells rows apart that share a doc_id.

    Null and empty texts have no spans. Rows that share a doc_id are judged by their own texts; equal rows
    get equal results. A weak part that overlaps a strong span is left out. An empty table gives no rows.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("txt"), F.col(text).alias("text"))
    strong = rows.select(
        "doc", "txt", "text",
        F.filter(_found(t, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["v"], ASSIGN, 2)) >= MIN_VALUE).alias("assign"),
        F.filter(_found(t, ACCESS), lambda m: F.char_length(m["v"]) >= MIN_ACCESS).alias("access"),
        _found(t, HEX).alias("hex"),
    )
    weak = strong.select("doc", "txt", "assign", "access", "hex", *[_weak(t, r).alias(r) for r in WEAK])
    each = [F.col(k) for k in ("assign", "access", "hex")]
    base = found.listed(*[found.spans(k, i, F.col(k)) for i, k in enumerate(KINDS[:3])])
    parts = [found.spans(f"weak_{r}", 3 + i, found.apart(F.col(r), *each)) for i, r in enumerate(WEAK)]
    rows = settle(weak.select("doc", "txt", base.alias("base"), found.listed(*parts).alias("weak")), "secret-parts")

    role = F.element_at(F.create_map(*[F.lit(x) for kind in KINDS for x in (kind, ROLES.get(kind, kind.removeprefix("weak_")))]), F.col("part.kind"))
    some = rows.where(F.size("weak") > 0).where(F.size("base") + F.size("weak") > 1).distinct()
    every = some.select("doc", "txt", F.explode(F.concat("base", "weak")).alias("part")).withColumn("role", role)
    weak = every.where(F.col("part.k") >= 3).withColumn("bin", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.floor(F.col("part.s") / scope) + d)))
    other = every.withColumn("bin", F.floor(F.col("part.s") / scope))
    near = "w.doc <=> o.doc and w.txt <=> o.txt and w.bin = o.bin and w.role != o.role and abs(w.part.s - o.part.s) <= " + str(int(scope))
    linked = weak.alias("w").join(other.alias("o"), F.expr(near), "left_semi").select("doc", "txt", "part").distinct()
    linked = linked.groupBy("doc", "txt").agg(F.collect_list("part").alias("more"))
    joined = rows.alias("r").join(linked.alias("l"), F.expr("r.doc <=> l.doc and r.txt <=> l.txt"), "left")
    spans = F.array_sort(F.concat("r.base", F.coalesce(F.col("l.more"), F.array().cast(found.SPAN))))
    return joined.select(F.col("r.doc").alias("doc_id"), "r.txt", "r.base", spans.alias("spans"))
