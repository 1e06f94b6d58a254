"""Queries of the operators over the given tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import alignment, chats, found, leaks, linedups, lines, merkle, mixing, passages, persons, pieces, secrets, similar, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def piece_digests(docs: DataFrame) -> DataFrame:
    done = pieces.encode_decode(docs.select("doc_id", "text"), os.environ.get("PIECE_MODEL") or vocabulary())
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )


@query
def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(documents(spark, sf_dir))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    done = toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score")
    return done.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = secrets.scan(documents(spark, sf_dir))
    base, every = found.written(F.col("base")), found.written(F.col("spans"))
    return done.select("doc_id", *map(_count, secrets.KINDS[:3]), F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))


@query
def op9_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = persons.scan(documents(spark, sf_dir))
    base, every = found.written(F.col("base")), found.written(F.col("spans"))
    return done.select("doc_id", *map(_count, persons.KINDS[:4]), F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))


@query
def op4_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = r"\### Assistant: </turn> ok"
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(extra).alias("text"))
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    talks = rows.union(added).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("messages"))
    records = talks.select("conv_id", F.to_json(F.struct(F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))).alias("record"))
    done = chats.read_back(chats.format_records(records).select("conv_id", "formatted", "loss_mask"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha(said).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), sha(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL["op4_chats"] = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '<', '\('), '>', '\)') AS body, replace(replace(replace(role, '\', '\\'), '<', '\('), '>', '\)') AS name FROM every
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn ' || name || '>' || body || '</turn>') + 1)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query
def op5_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.near_duplicates(documents(spark, sf_dir)).drop("txt")


@query
def op6_linedups(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linedups.drop_lines(documents(spark, sf_dir), min_words=1)
    return done.select(
        "doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed_lines"), F.sha2(F.encode(F.coalesce("left_text", F.lit("")), "UTF-8"), 256).alias("left_sha256"),
    )


@query
def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    n_hit = leaks.hit_words()
    return leaks.find_leaks(documents(spark, sf_dir), benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query
def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed"
    )


@query
def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.cut_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    done, _ = alignment.aligned(documents(spark, sf_dir), *paths, digest=True)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    whole = merkle.leaf(*fields, F.col("text"))
    rows = docs.select("doc_id", "source", whole.alias("leaf"), F.when(changed, merkle.leaf(*fields, F.replace("text", F.lit("\n"), F.lit("")))).otherwise(whole).alias("claimed"))
    done = merkle.manifest(rows)
    folded = done.withColumn("folded_root", merkle.fold(F.col("claimed"), F.col("path")))
    proof = F.sha2(merkle.proof(F.col("path")).cast("binary"), 256)
    return folded.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


SQL["op12_manifest"] = r"""
WITH RECURSIVE told AS (
  SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, text NULLS FIRST, lang NULLS FIRST, n_chars NULLS FIRST) AS k, doc_id, source,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    text, replace(text, chr(10), '') AS cut FROM documents
), leaves AS (
  SELECT k, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) AS cut_leaf FROM told
), crc AS (
  SELECT k, doc_id::VARCHAR AS s, 0 AS i, 4294967295::UBIGINT AS c, 0 AS bit FROM leaves WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT k, s, CASE WHEN bit = 8 THEN i + 1 ELSE i END,
    CASE WHEN bit = 0 THEN xor(c, ascii(s[i + 1])::UBIGINT) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END
  FROM (SELECT k, s, i, bit, c FROM crc WHERE i < length(s)) step
), even AS (
  SELECT k FROM crc WHERE i = length(s) AND xor(c, 4294967295::UBIGINT) % 2 = 0
), nodes AS (
  SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, 0 AS lvl, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n, leaf AS h, k, doc_id, cut_leaf FROM leaves
), up AS (
  SELECT tree, lvl, idx, n, h FROM nodes
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, max((n + 2) // 3), sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY tree, lvl, idx // 3
), top AS (
  SELECT 0 AS lvl, tree AS idx, (SELECT count(DISTINCT tree) FROM nodes) AS n, h FROM up WHERE n = 1
  UNION ALL
  SELECT lvl + 1, idx // 3, max((n + 2) // 3), sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 3
), every AS (
  SELECT FALSE AS above, tree, lvl, idx, n, h FROM up UNION ALL SELECT TRUE, -1, lvl, idx, n, h FROM top
), beside AS (
  SELECT a.above, a.tree, a.lvl, a.idx, string_agg(s.h, '' ORDER BY s.idx) FILTER (WHERE s.idx < a.idx) AS l, string_agg(s.h, '' ORDER BY s.idx) FILTER (WHERE s.idx > a.idx) AS r
  FROM every a JOIN every s ON s.above = a.above AND s.tree = a.tree AND s.lvl = a.lvl AND s.idx // 3 = a.idx // 3 AND s.idx <> a.idx WHERE a.n > 1 GROUP BY ALL
), way AS (
  SELECT k, tree, 0 AS lvl, idx, n, FALSE AS above, CASE WHEN k IN (SELECT k FROM even) THEN cut_leaf ELSE h END AS h, '' AS proof FROM nodes
  UNION ALL
  SELECT w.k, w.tree, CASE WHEN w.n = 1 THEN 0 ELSE w.lvl + 1 END, CASE WHEN w.n = 1 THEN w.tree ELSE w.idx // 3 END,
    CASE WHEN w.n = 1 THEN (SELECT count(DISTINCT tree) FROM nodes) ELSE (w.n + 2) // 3 END, w.above OR w.n = 1,
    CASE WHEN w.n = 1 THEN w.h ELSE sha256(coalesce(b.l, '') || w.h || coalesce(b.r, '')) END,
    CASE WHEN w.n = 1 THEN w.proof ELSE w.proof || coalesce(b.l, '') || coalesce(b.r, '') END
  FROM way w LEFT JOIN beside b ON b.above = w.above AND b.tree = (CASE WHEN w.above THEN -1 ELSE w.tree END) AND b.lvl = w.lvl AND b.idx = w.idx
  WHERE w.n > 1 OR NOT w.above
)
SELECT n.doc_id, n.h AS leaf, u.h AS subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = t.h AS verified
FROM way w JOIN nodes n ON n.k = w.k JOIN up u ON u.tree = n.tree AND u.n = 1 JOIN top t ON t.n = 1
WHERE w.above AND w.n = 1
"""


@query
def op13_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    rows, mixed = mixing.mix(docs, keep=["doc_id"], words=False)
    taken = mixed.groupBy(F.col("row").alias("_row")).agg(F.sum("n").alias("taken"))
    done = rows.join(taken, F.col("row") == F.col("_row"), "left")
    return done.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
