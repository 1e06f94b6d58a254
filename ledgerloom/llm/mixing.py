"""Mixing sources to target weights, by column functions only.

* The words of a source, document behind document, are packed into blocks of a fixed length; the last block may be shorter.
* Slots are counted per source from its target. Every output shard draws the sources of its slots from one multinomial
  distribution, whose weights are the slots; the draws are counted per shard and source.
* The draws are then held to the totals: what a source has drawn beyond its slots goes, slot by slot, to the sources that
  have drawn too few. The counts per shard are thus multinomial under the condition that each source gets its slots.
* The j-th slot of a source takes a block by a pseudorandom permutation of its block numbers, one for each time round. The
  permutation swaps or keeps a number and its mirror at a key, round by round (swap-or-not), so it is one for any number of
  blocks, without a table.
* Slots and blocks are joined on (source, block).

All draws are hashes of the seed, so a second run gives the same mix. Running sums over sources, shards and documents come from
``ranks.placed``; intervals are looked up by an equi-join on cells of ``CELL`` places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.ranks import alike, placed
from ledgerloom.llm.texts import held
from ledgerloom.session import settle

#: fixed value: a word
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: size of the mix in percent of all sources, times a source may be taken
SHARE, TIMES = 150, 2
#: words of a block, slots of an output shard
BLOCK, SHARD = 64, 4096
ROUNDS = 16
CELL = 64
SEED = 20240229


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, times: float = TIMES) -> DataFrame:
    """Sources (``source``, ``size``) with ``rank``, their place by code point with the missing one last, and ``target``.

    The targets share ``share`` percent of all sizes by weight, the weights repeating by rank. A target stops at ``times`` its source's size, and
    what is over is shared again by weight among the others, until none is above. Each round reads one row of sums.
    """
    ranked = placed(sizes.select("source", "size", F.col("source").isNull().alias("_last")), [], ["_last", "source"])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.select("source", "size", F.col("place").alias("rank"), weight.cast("double").alias("weight")), "mix-sources")
    most = F.col("size") * float(times)
    whole = ranked.agg(F.sum("size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # the level is the target of weight 1; sources that are full at it stay full, as it only rises
        stopped = (most <= F.lit(level) * F.col("weight")) if full >= 0 else F.lit(False)
        free, taken, n = ranked.agg(
            F.sum(F.when(~stopped, F.col("weight"))), F.sum(F.when(stopped, most)), F.count(F.when(stopped, 1))
        ).first()
        if n == full or not free:
            break
        level, full = (whole * share / 100 - (taken or 0.0)) / free, n
    return ranked.select("source", "size", "rank", F.least(most, F.lit(level) * F.col("weight")).alias("target"))


def permuted(place: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """The image of ``place`` under a pseudorandom permutation of 0 to ``n`` - 1 that the seed and ``key`` choose."""

    def step(x: Column, i: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), *key, i), n) - x, n)
        return F.when(F.xxhash64(F.lit(SEED + 1), *key, i, F.greatest(x, mirror)) % 2 == 0, x).otherwise(mirror)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), place, step)


def _looked_up(points: DataFrame, at: str, intervals: DataFrame) -> DataFrame:
    """``points`` beside the interval (``low`` to below ``high``) that ``at`` lies in. Intervals do not overlap; they and the points
    meet on cells of ``CELL`` places, so a point meets at most that many."""
    cells = F.explode(F.sequence(F.expr(f"low div {CELL}"), F.expr(f"(high - 1) div {CELL}"))).alias("_cell")
    spread = intervals.where("high > low").select("*", cells)
    return points.withColumn("_at", F.expr(f"`{at}` div {CELL}")).join(spread, (F.col("_at") == F.col("_cell")) & (F.col(at) >= F.col("low")) & (F.col(at) < F.col("high"))).drop("_at", "_cell")


def shard_counts(slots: DataFrame, shard: int = SHARD) -> DataFrame:
    """The slots of each output shard as runs (``shard``, ``rank``, ``first``, ``n``): ``n`` slots of the source, from its ``first`` on. ``slots`` has
    ``rank`` and ``n_slots``; every number below ``n_slots`` comes up once."""
    spark = slots.sparkSession
    lined = settle(placed(slots.select("rank", "n_slots"), [], ["rank"], "n_slots").select("rank", "n_slots", F.col("before").alias("low"), (F.col("before") + F.col("n_slots")).alias("high")), "mix-lined")
    total = lined.agg(F.max("high")).first()[0] or 0
    draw = F.pmod(F.xxhash64(F.lit(SEED + 2), "id"), F.lit(max(1, total)))
    drawn = _looked_up(spark.range(total).select(F.expr(f"id div {shard}").alias("shard"), draw.alias("draw")), "draw", lined)
    drawn = placed(drawn.groupBy("rank", "shard").agg(F.count(F.lit(1)).alias("n")), ["rank"], ["shard"], "n")
    wanted = lined.select(F.col("rank").alias("_rank"), "n_slots")
    kept = F.greatest(F.lit(0), F.least(F.col("n"), F.col("n_slots") - F.col("before")))
    counted = settle(drawn.join(wanted, F.col("rank") == F.col("_rank")).select("shard", "rank", F.col("before").alias("first"), kept.alias("n"), (F.col("n") - kept).alias("over")), "mix-draws")

    over = placed(counted.where("over > 0").select("shard", "rank", "over"), [], ["shard", "rank"], "over")
    over = over.select("shard", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("over") - 1)).alias("unit"))
    got = counted.groupBy("rank").agg(F.sum("n").alias("got"))
    short = wanted.join(got, F.col("_rank") == F.col("rank"), "left").select(F.col("_rank").alias("rank"), F.coalesce("got", F.lit(0)).alias("got"), (F.col("n_slots") - F.coalesce("got", F.lit(0))).alias("short"))
    short = placed(short.where("short > 0"), [], ["rank"], "short").select("rank", "got", F.col("before").alias("low"), (F.col("before") + F.col("short")).alias("high"))
    moved = _looked_up(over, "unit", settle(short, "mix-short")).select("shard", "rank", (F.col("got") + F.col("unit") - F.col("low")).alias("first"), F.lit(1).cast("long").alias("n"))
    return counted.where("n > 0").select("shard", "rank", "first", "n").union(moved)


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", order: str = "doc_id", keep: list[str] | None = None, words: bool = True,
    block: int = BLOCK, shard: int = SHARD, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, times: float = TIMES,
) -> tuple[DataFrame, DataFrame]:
    """The documents and the mix.

    The first frame has the columns of ``docs`` named in ``keep`` (all of them if none are) and ``row``, a number of its own for each document, ``size``
    (words), ``source_size``, ``target`` and ``rank`` (of its source). The second one has a row for every piece of a document in a slot of the mix:
    ``shard``, ``slot`` (order in the shard), ``rank``, ``block``, ``row``, ``first`` (word of the document, from 0), ``n`` (words) and, if ``words`` is
    set, ``piece``, the words joined by one space; ``slot_texts`` joins the pieces of a slot.

    A null or empty text has no words and no pieces. A missing source is a source like others. Documents of a source are packed in
    ``order``, ties by a hash of the text; equal rows are documents of their own. A long text spans many blocks, a block may hold many
    documents. An empty table gives no rows. Input columns called like the new ones give way to them.
    """
    new = ["row", "size", "source_size", "target", "rank"]
    keep = [c for c in keep or docs.columns if c not in new]
    said = F.col(f"`{text}`")
    mine = held(docs.select(*[F.col(f"`{c}`") for c in keep])).columns
    rows = docs.select(
        *[F.col(f"`{c}`").alias(h) for c, h in zip(keep, mine, strict=True)], F.col(f"`{source}`").alias("source"), F.col(f"`{order}`").alias("order"),
        word_count(said).alias("size"), F.xxhash64(said).alias("tie"), *([F.regexp_extract_all(said, F.lit(WORD), 0).alias("all_words")] if words else []),
    )
    rows = settle(rows, "mix-sizes")  # the ranges are cut from the written sizes, so words are counted once
    rows = settle(placed(rows, ["source"], ["order", "size", "tie"], "size").withColumnRenamed("before", "begin"), "mix-docs")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"))
    sources = targets(sizes, weights, share, times)
    n_blocks = F.expr(f"(size + {block - 1}) div {block}")
    round_trips = F.floor(F.try_divide("target", "size"))
    rest = F.round(F.try_divide((F.col("target") - round_trips * F.col("size")) * n_blocks, F.col("size")))
    sources = settle(sources.select("source", "size", "rank", "target", n_blocks.alias("n_blocks"), F.coalesce(round_trips * n_blocks + rest, F.lit(0)).cast("long").alias("n_slots")), "mix-targets")

    # the runs are few bytes that open out into all slots: dealt over all partitions, not packed into a few by size
    runs = shard_counts(sources, shard)
    runs = runs.repartition(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "rank")
    blocks = sources.select(F.col("rank").alias("_rank"), "n_blocks")
    each = runs.join(blocks, F.col("rank") == F.col("_rank")).select("shard", "rank", "n_blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("j"))
    turn, place = F.expr("j div n_blocks"), F.col("j") % F.col("n_blocks")
    taken = each.select("shard", F.xxhash64(F.lit(SEED + 3), "rank", "j").alias("slot"), "rank", permuted(place, F.col("n_blocks"), F.col("rank"), turn).alias("block"))

    told = sources.select(F.col("source").alias("_source"), F.col("size").alias("source_size"), "target", "rank")
    every = rows.join(told, alike([(F.col("source"), F.col("_source"))]))
    numbers = F.explode(F.sequence(F.expr(f"begin div {block}"), F.expr(f"(begin + size - 1) div {block}")))
    parts = every.where("size > 0").select("rank", "row", "begin", "size", *(["all_words"] if words else []), numbers.alias("block"))
    low, high = F.greatest(F.col("begin"), F.col("block") * block), F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block)
    parts = parts.select(F.col("rank").alias("_rank"), F.col("block").alias("_block"), "row", (low - F.col("begin")).alias("first"), (high - low).alias("n"), *(["all_words"] if words else []))
    if words:
        cut = F.slice("all_words", (F.col("first") + 1).cast("int"), F.col("n").cast("int"))
        parts = parts.withColumn("piece", F.array_join(cut, " ")).drop("all_words")
    mixed = taken.join(parts, (F.col("rank") == F.col("_rank")) & (F.col("block") == F.col("_block"))).drop("_rank", "_block")
    return every.select(*[F.col(f"`{h}`").alias(c) for c, h in zip(keep, mine, strict=True)], *new), mixed


def slot_texts(mixed: DataFrame) -> DataFrame:
    """One row per slot of the mix: ``shard``, ``slot``, ``rank``, ``block``, ``text``, the words of its block. A block has at most its fixed number of
    words, so a slot is a small group."""
    pieces = F.array_sort(F.collect_list(F.struct("row", "first", "piece")))
    return mixed.groupBy("shard", "slot", "rank", "block").agg(F.array_join(F.transform(pieces, lambda p: p["piece"]), " ").alias("text"))
