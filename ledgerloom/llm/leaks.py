"""Benchmark decontamination as a prefix-filtered containment join.

A window of an item is ``size`` consecutive words of it (a shorter item is one window), seen as its set of short
shingles. A document holds the window only if it holds every shingle, so the necessary prefix of a window, with its shingles
ordered by rarity over all documents, is the rarest one. Documents and windows are joined on these prefix shingles only; the
place of the shingle in the window gives the one start that is possible (positional bound), which must leave room for the whole
window (length bound); what is left is compared word by word. A candidate brings the words around its
shingle along, so no text moves.

Windows, counts and prefixes are tables, made and joined by Spark. Before documents give out their shingles, a filter of bits
drops those that no window can have; its size is bounded whatever the benchmark's, and what it lets through by chance the join
drops. A prefix shingle with a large share of all candidates is dealt into parts, and its windows are repeated for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.texts import ALNUM, chunks, held, map_batches, schema_of, windows, without, words
from ledgerloom.session import settle

#: words of a window, words of a shingle
SIZE, SHINGLE = 10, 3
#: bytes of the filter that goes to the tasks, at most
BLOCK = 8 << 20
#: parts that all candidates are dealt into by their shares; only shingles with more than one such share have several
PARTS = 256
#: windows in one batch
BATCH = 1 << 15


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of ``data`` up to each end as binary values."""
    bounds = np.concatenate([[0], ends]).astype(np.int64) * data.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _item_windows(items: DataFrame, size: int) -> DataFrame:
    """(item, words, shingles): the distinct windows of every item, as the hashes of their words and of their shingles in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in chunks(batches, "text"):
            h, first = words(data, bounds, ALNUM)
            ids = batch.column(0)
            for i in np.flatnonzero(np.diff(first)):
                own = h[first[i] : first[i + 1]]
                n = min(size, len(own))
                k = min(SHINGLE, n)
                rows = np.lib.stride_tricks.sliding_window_view(own, n)
                shingles = np.lib.stride_tricks.sliding_window_view(windows(own, k).view(np.int64), n - k + 1)
                for lo in range(0, len(rows), BATCH):
                    some = rows[lo : lo + BATCH]
                    parts = shingles[lo : lo + BATCH]
                    ends = np.arange(1, len(some) + 1)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1) * parts.shape[1], pa.int32()), pa.array(parts.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([ids[int(i)].as_py()] * len(some), pa.string()), _binaries(some.ravel(), ends * n), lists], ["item", "words", "shingles"])

    return map_batches(items, run, "item string, words binary, shingles array<bigint>").distinct()


class Sieve:
    """A filter of bits for shingles: two bits each, cut from both ends of the hash. Never turns a known one away."""

    def __init__(self, shingles: DataFrame, block: int) -> None:
        known = shingles.select("shingle").distinct()
        self.log = max(6, min((block * 8).bit_length() - 1, (known.count() * 64).bit_length()))
        slots = F.array(F.shiftrightunsigned("shingle", 64 - self.log), F.col("shingle").bitwiseAND(F.lit((1 << self.log) - 1)))
        slots = known.select(F.explode(slots).alias("slot"))
        bits = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        found = bits.toArrow()  # at most ``block`` bytes of bits
        self.bits = np.zeros(1 << (self.log - 6), np.uint64)
        self.bits[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)

    def _has(self, slot: np.ndarray) -> np.ndarray:
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)

    def places(self, h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of the shingles of ``k`` words that may be known, and these shingles."""
        keys = windows(h, k)
        at = np.flatnonzero(self._has(keys >> np.uint64(64 - self.log)))
        at = at[self._has(keys[at] & np.uint64((1 << self.log) - 1))]
        row = np.searchsorted(first, at, "right") - 1
        at = at[at + k <= first[row + 1]]
        return at, keys[at].view(np.int64)


def _counted(docs: DataFrame, sieve: Sieve, lengths: list[int]) -> DataFrame:
    """(shingle, seen): how often the shingles that may be known stand in all documents; summed in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in chunks(batches, "text"):
            h, first = words(data, bounds, ALNUM)
            for k in lengths:
                found, seen = np.unique(sieve.places(h, first, k)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(seen, pa.int64())], ["shingle", "seen"])

    return map_batches(docs.select("text"), run, "shingle bigint, seen bigint").groupBy("shingle").agg(F.sum("seen").alias("seen"))


def _candidates(docs: DataFrame, sieve: Sieve, lengths: list[int], size: int, parts: dict[int, int]) -> DataFrame:
    """(k1, k2, shingle, part, start, at, context): the places of prefix shingles with the words around them; ``start`` is the place of the
    first one in the text, ``at`` that of the shingle in the context."""
    hot = np.array(sorted(parts), np.int64)
    dealt = np.array([parts[s] for s in hot.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in chunks(batches, "text"):
            h, first = words(data, bounds, ALNUM)
            for k in lengths:
                every, keys = sieve.places(h, first, k)
                for cut in range(0, len(every), BATCH):
                    at, shingle = every[cut : cut + BATCH], keys[cut : cut + BATCH]
                    row = np.searchsorted(first, at, "right") - 1
                    lo = np.maximum(first[row], at - size + 1)
                    long = np.minimum(first[row + 1], at + size) - lo
                    ends = np.cumsum(long)
                    context = h[np.repeat(lo - (ends - long), long) + np.arange(long.sum())]
                    part = np.zeros(len(at), np.int64)
                    if len(hot):
                        place = np.minimum(np.searchsorted(hot, shingle), len(hot) - 1)
                        part = np.where(hot[place] == shingle, at % dealt[place], 0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(shingle, pa.int64()), pa.array(part, pa.int32()),
                         pa.array(lo - first[row], pa.int32()), pa.array(at - lo, pa.int32()), _binaries(context, ends)],
                        ["k1", "k2", "shingle", "part", "start", "at", "context"],
                    )

    return map_batches(docs.select("k1", "k2", "text"), run, "k1 bigint, k2 bigint, shingle bigint, part int, start int, at int, context binary")


def _prefixes(held_windows: DataFrame, docs: DataFrame, block: int) -> tuple[DataFrame, list[int]]:
    """(shingle, seen, place, words): the rarest shingle of every window that can occur, the first by hash and place among
    equals; and the numbers of words that shingles have."""
    distinct = held_windows.select("words", "shingles").distinct()
    shingles = distinct.select("words", F.posexplode("shingles").alias("place", "shingle"))
    lengths = [r["k"] for r in distinct.select(F.least(F.lit(SHINGLE), (F.octet_length("words") / 8).cast("int")).alias("k")).distinct().collect()]
    seen = _counted(docs, Sieve(shingles, block), lengths)
    ranked = shingles.join(seen, "shingle", "left").select("words", F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "shingle", "place").alias("r"))
    least = ranked.groupBy("words").agg(F.min("r").alias("r")).where("r.seen > 0")  # a shingle that no document has: nor has any the window
    return settle(least.select("r.shingle", "r.seen", "r.place", "words"), "leak-prefixes"), lengths


def _matches(prefixes: DataFrame, docs: DataFrame, lengths: list[int], size: int, block: int) -> DataFrame:
    """(k1, k2, words, begin, end): the windows that occur in texts, and where."""
    once = prefixes.select("shingle", "seen").distinct()
    total = once.agg(F.sum("seen")).first()[0] or 1
    share = F.ceil(F.lit(PARTS) * F.col("seen") / F.lit(total)).cast("int")
    parts = {r["shingle"]: r["parts"] for r in once.select("shingle", share.alias("parts")).where("parts > 1").collect()}  # fewer than PARTS
    dealt = prefixes.withColumn("part", F.explode(F.sequence(F.lit(0), share - 1)))
    found = _candidates(docs, Sieve(prefixes, block), lengths, size, parts).join(dealt, ["shingle", "part"])
    found = found.where("at >= place and 8 * (at - place) + octet_length(words) <= octet_length(context)")
    found = found.where("substring(context, 8 * (at - place) + 1, octet_length(words)) = words")
    begin = F.col("start") + F.col("at") - F.col("place")
    found = found.select("k1", "k2", "words", begin.alias("begin"), (begin + F.octet_length("words") / 8).cast("int").alias("end"))
    return settle(found.distinct(), "leak-matches")


def _merged(matches: DataFrame) -> DataFrame:
    """(k1, k2, hits): the ranges of a text, those that overlap or touch as one."""
    before = Window.partitionBy("k1", "k2").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("k1", "k2").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, 0)
    ranges = matches.select("k1", "k2", "begin", "end").distinct().withColumn("apart", F.coalesce(F.col("begin") > F.max("end").over(before), F.lit(True)))
    ranges = ranges.withColumn("run", F.sum(F.col("apart").cast("int")).over(upto))
    runs = ranges.groupBy("k1", "k2", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    listed = F.sort_array(F.collect_list(F.struct("begin", "end")))
    return runs.groupBy("k1", "k2").agg(F.flatten(F.transform(listed, lambda r: F.array(r["begin"], r["end"]))).alias("hits"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """All columns of ``docs`` with three more: ``n_words``; ``hits``, the word ranges that windows of items cover, as first words
    and ends in turn, merged; and ``items``, the ids, as text, of all items with a window in the document.

    Null and empty texts have no words, no hits and no items. An item without words is never found; a null item id is "". Repeated
    rows of documents give equal results, repeated items count once by id. Of shingles equally rare, the first by hash and place is the
    prefix, which changes no result. Texts of any length are worked off whole, in runs of bounded text where rows allow. With an
    empty benchmark nothing is hit. An input column called like a new one gives way to it.
    """
    docs = without(docs, "n_words", "hits", "items")
    columns, rows = docs.columns, held(docs)
    own = F.col(f"`_in_{text}`")
    # texts go by two hashes of 64 bits: equal texts are judged once
    keys = [F.xxhash64(own).alias("k1"), F.xxhash64(F.lit(7), own).alias("k2")]
    texts = rows.select(*keys, own.alias("text"))
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text")).distinct()
    held_windows = settle(_item_windows(items, size), "leak-windows")
    prefixes, lengths = _prefixes(held_windows, texts, block)
    matches = _matches(prefixes, texts, lengths, size, block)
    owners = matches.select("k1", "k2", "words").distinct().join(held_windows.select("words", "item"), "words").select("k1", "k2", "item").distinct()
    owners = owners.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = settle(_merged(matches).join(owners, ["k1", "k2"]), "leak-found")

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in chunks(batches, f"_in_{text}"):
            first = words(data, bounds, ALNUM)[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(first), pa.int64())], [*batch.schema.names, "n_words"])

    counted = map_batches(rows, sized, f"{schema_of(rows)}, n_words bigint").select("*", *keys)
    out = counted.join(found, ["k1", "k2"], "left")
    return out.select(
        *[F.col(f"`_in_{c}`").alias(c) for c in columns], "n_words",
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def hit_words(hits: str = "hits"):
    """The number of words in merged ranges."""
    return F.expr(f"aggregate({hits}, struct(0L AS n, 1L AS sign), (s, x) -> struct(s.n - s.sign * x AS n, -s.sign AS sign), s -> s.n)")
