"""A Merkle manifest of a dataset: a tree over the rows of each source, and a tree over the sources.

Nodes are rows (tree, idx, n, digest): the place of a node in its level and how many nodes that level has. Each level is equi-joined
with itself on computed sibling places (a node in slot k of its run of ``arity`` has its siblings in the slots k+1, k+2, ... modulo
``arity``; for two that is idx XOR 1), and the rows in slot zero, which have all of their run beside them, emit the parents.
A level is written once, parents are made from the written rows. The way back down hands every node the siblings of its ancestors.

A tree is numbered by its place among the sources, nodes are joined on (tree, idx), so a source with most of the rows is no hot
key. Levels shrink by ``arity``, so all of them together shuffle little more than the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.ranks import alike, placed
from ledgerloom.llm.texts import held
from ledgerloom.session import settle

ARITY = 3
_NOTHING = b""
_STEP = "struct<before:binary,after:binary>"


def _sha(parts: Column) -> Column:
    """Digest of raw digests, which go in as lowercase hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(parts)).cast("binary"), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf(*fields: Column) -> Column:
    """Digest of a row, as hex text: each field as ``-`` if it is missing, else as its UTF-8 byte count, ``:`` and its text."""
    written = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in written]).cast("binary"), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root, as hex text, that a leaf's digest (hex text) and its path give."""
    return hex_text(F.aggregate(path, F.unhex(digest), lambda got, step: _sha(F.concat(step["before"], got, step["after"]))))


def proof(path: Column) -> Column:
    """All digests of a path, hex text, level by level and from left to right."""
    return hex_text(F.aggregate(path, F.lit(_NOTHING), lambda got, step: F.concat(got, step["before"], step["after"])))


def _level(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with the digests of their siblings to the left and to the right."""
    slot, out = F.col("idx") % arity, nodes
    found: list[tuple[int, Column]] = []
    for step in range(1, arity):
        beside = nodes.select(F.col("tree").alias(f"_tree{step}"), F.col("idx").alias(f"_idx{step}"), F.col("digest").alias(f"_digest{step}"))
        at = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + (slot + step) % arity
        out = out.join(beside, (F.col("tree") == F.col(f"_tree{step}")) & (at == F.col(f"_idx{step}")), "left")
        found.append((step, F.col(f"_digest{step}")))

    def side(inside: Column, j: int) -> Column:
        held_by = [F.when((slot + step) % arity == j, digest) for step, digest in found]
        return F.when(inside, F.coalesce(*held_by, F.lit(_NOTHING))).otherwise(F.lit(_NOTHING))

    before = F.concat(*[side(slot > j, j) for j in range(arity - 1)])
    after = F.concat(*[side(slot < j, j) for j in range(1, arity)])
    return out.select(*nodes.columns, before.alias("before"), after.alias("after"))


def levels(nodes: DataFrame, arity: int = ARITY) -> list[DataFrame]:
    """All levels of the trees whose leaves are ``nodes`` (tree, idx, n, digest and any more), from the leaves up. A tree ends with
    its only node; the last level holds the roots of the highest trees. No nodes give no levels."""
    out: list[DataFrame] = []
    most = nodes.agg(F.max("n")).first()[0]
    while most:
        out.append(settle(_level(nodes, arity), f"merkle-{len(out)}"))
        heads = out[-1].where((F.col("n") > 1) & (F.col("idx") % arity == 0))
        whole = _sha(F.concat("digest", "after")).alias("digest")
        nodes = heads.select("tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), whole)
        most = -(-most // arity) if most > 1 else 0
    return out


def paths(found: list[DataFrame], above: DataFrame | None = None, arity: int = ARITY) -> DataFrame:
    """The leaves with ``path``, the siblings on the way up as (before, after) for each level, and ``subroot``, the root of their tree.

    ``above`` (up_tree, up_path) carries on from the roots of the trees."""
    done = None
    for depth in reversed(range(len(found))):
        rows = found[depth]
        given = [c for c in rows.columns if c not in ("before", "after")]
        ends = rows.where("n = 1")
        on = F.expr(f"cast(array() as array<{_STEP}>)") if above is None else F.col("up_path")
        ends = ends if above is None else ends.join(above, F.col("tree") == F.col("up_tree"))
        out = ends.select(*given, on.alias("path"), F.col("digest").alias("subroot"))
        if done is not None:
            up = done.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("path").alias("_path"), F.col("subroot").alias("_subroot"))
            inner = rows.where("n > 1").join(up, (F.col("tree") == F.col("_tree")) & (F.expr(f"idx div {arity}") == F.col("_idx")))
            out = out.union(inner.select(*given, F.concat(F.array(F.struct("before", "after")), "_path"), "_subroot"))
        done = settle(out, f"paths-{depth}") if depth else out
    return done


def manifest(rows: DataFrame, digest: str = "leaf", tree: str = "source", order: str = "doc_id", arity: int = ARITY) -> DataFrame:
    """``rows``, each a leaf with its ``digest`` (hex text, see ``leaf``), with ``path`` (see ``paths``; from its leaf to the root of all),
    ``subroot`` and ``root`` (hex text).

    The leaves of a tree ascend by ``order``, rows that tie there by digest; rows equal in both are leaves of their own, whose order makes no
    difference. A missing order value comes first. Trees ascend by name, bytewise, the missing name first. A lone leaf is its own subroot,
    a lone subroot the root. An empty table gives no rows. Input columns called like the new ones give way to them.
    """
    rows = rows.drop("path", "subroot", "root")
    columns = rows.columns
    rows = settle(held(rows), "leaves")
    name, mark, by = (f"_in_{c}" for c in (tree, digest, order))
    trees = placed(rows.groupBy(F.col(f"`{name}`").alias("_name")).agg(F.count(F.lit(1)).alias("n")), [], ["_name"])
    trees = settle(trees.select("_name", "n", F.col("place").alias("tree")), "trees")
    leaves = placed(rows, [name], [by, mark])
    leaves = leaves.join(trees, alike([(F.col(f"`{name}`"), F.col("_name"))]))
    leaves = settle(leaves.select(*rows.columns, "tree", F.col("place").alias("idx"), "n", F.unhex(F.col(f"`{mark}`")).alias("digest")), "leaves")

    found = levels(leaves, arity)
    new = ["path", "subroot", "root"]
    if not found:
        return leaves.selectExpr("*", f"cast(null as array<{_STEP}>) as path", "'' as subroot", "'' as root").select(*[F.col(f"`_in_{c}`").alias(c) for c in columns], *new)
    ends = [x.where("n = 1").select("tree", "digest") for x in found]
    subroots = ends[0]
    for more in ends[1:]:
        subroots = subroots.union(more)
    top = levels(settle(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(trees.count()).cast("long").alias("n"), "digest"), "subroots"), arity)
    root = top[-1].where("n = 1").select(hex_text(F.col("digest"))).first()[0]
    above = settle(paths(top, None, arity).select(F.col("idx").alias("up_tree"), F.col("path").alias("up_path")), "top_paths")
    done = paths(found, above, arity)
    return done.select(*[F.col(f"`_in_{c}`").alias(c) for c in columns], "path", hex_text(F.col("subroot")).alias("subroot"), F.lit(root).alias("root"))
