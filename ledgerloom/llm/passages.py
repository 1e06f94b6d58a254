"""Substring deduplication: words go that stand in a passage of ``size`` words which an earlier document holds too.

A sharded, compressed full-text index (``fm``) finds the passages. Shards are made by content, so that the work grows
with the input and not with its square: every window of ``size`` words has an anchor, its word group of ``ANCHOR`` words with the
smallest hash, and goes to the shard of that anchor. Windows next to each other with the same anchor
travel as one segment. Equal windows have equal anchors, so all copies of a window meet in one shard.

1. Anchors. Tasks list the segments of their documents by anchor. Of an anchor that a task sees in several segments only one
   row is sent to meet others, the rest are known to be shared and spread; so no anchor gathers more rows than there are
   tasks. An anchor that turns up twice is shared; all other segments cannot repeat and are left.
2. Segments. Equal segments are pre-aggregated to one, with its smallest doc_id; only that document's words are fetched.
3. Index. Each shard indexes its distinct segments and streams them through backward search; windows whose matching
   statistics reach ``size`` fall into one suffix interval if they are equal, and take the interval's smallest doc_id.
4. Removal. Windows whose smallest doc_id is below the document's own cover the words to remove.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import fm
from ledgerloom.llm.texts import PLAIN, chunks, map_batches, mix, row_of, schema_of, span_hashes, windows, words
from ledgerloom.session import release, settle

#: words of a passage, words of an anchor
SIZE, ANCHOR = 13, 4
#: words that a shard's index is built over at once; an anchor's segments stay together
SHARD_WORDS = 1 << 20
#: rows that a task keeps before it sends them on
KEEP = 1 << 20


def anchors(h: np.ndarray, first: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of windows that share an anchor: first window, one past the last, and the anchor's hash."""
    group = windows(h, anchor)
    n = len(h) - size + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    best, at = group[:n].copy(), np.arange(n)
    for k in range(1, size - anchor + 1):
        other = group[k : k + n]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    row = row_of(first)
    own = row[:n] == row[size - 1 :]
    same = np.zeros(n, bool)
    same[1:] = own[1:] & own[:-1] & (at[1:] == at[:-1])
    begins = np.flatnonzero(own & ~same)
    ends = np.flatnonzero(own & ~np.append(same[1:], False)) + 1
    return begins, ends, best[begins]


def _segment_hashes(h: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for the words from each begin to its end."""
    return span_hashes(mix(h), begins, ends)


def _local(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Rows of a task: one row of each anchor to meet others, the rest known as shared and, by their salt, sent anywhere."""
    doc, text, place, anchor, seg = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(anchor, kind="stable")
    again = np.append(False, anchor[order][1:] == anchor[order][:-1])
    shared = again | np.append(again[1:], False)
    salt = np.where(again, np.arange(1, len(order) + 1), 0).astype(np.int32)
    arrays = [anchor[order].view(np.int64), salt, shared, seg[order].view(np.int64), doc[order], text[order], place[order]]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["anchor", "salt", "shared", "seg", "doc", "txt", "place"])


def _shared(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    """(anchor, seg, doc, txt, place): the segments, with their first words, whose anchor stands in another segment too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch, data, bounds in chunks(batches, "text"):
            h, first = words(data, bounds, PLAIN)
            begins, ends, hashes = anchors(h, first, size, anchor)
            row = np.searchsorted(first, begins, "right") - 1
            doc, text = (np.asarray(batch.column(k)) for k in (0, 1))
            parts.append((doc[row], text[row], (begins - first[row]).astype(np.int32), hashes, _segment_hashes(h, begins, ends + size - 1)))
            n += len(begins)
            if n >= KEEP:
                yield _local(parts)
                parts, n = [], 0
        if n:
            yield _local(parts)

    rows = map_batches(docs, run, "anchor bigint, salt int, shared boolean, seg bigint, doc bigint, txt int, place int")
    met = F.count(F.lit(1)).over(Window.partitionBy("anchor", "salt"))
    return rows.withColumn("met", met).where("shared or met > 1").select("anchor", "seg", "doc", "txt", "place")


def _bodies(listed: DataFrame, size: int, anchor: int) -> DataFrame:
    """(anchor, seg, doc, body) of the listed segments, by their first words, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in chunks(batches, "text"):
            h, first = words(data, bounds, PLAIN)
            begins, ends, hashes = anchors(h, first, size, anchor)
            places = batch.column(1)
            at = np.asarray(places.flatten()).astype(np.int64) + np.repeat(first[:-1], np.diff(np.asarray(places.offsets)))
            pick = np.searchsorted(begins, np.unique(at))
            begins, ends, hashes = begins[pick], ends[pick] + size - 1, hashes[pick]
            long = ends - begins
            total = np.concatenate([[0], np.cumsum(long)])
            body = h[np.repeat(begins - total[:-1], long) + np.arange(total[-1])]
            packed = pa.Array.from_buffers(pa.binary(), len(long), [None, pa.py_buffer((total * 8).astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())])
            doc = np.asarray(batch.column(0))[np.searchsorted(first, begins, "right") - 1]
            arrays = [pa.array(hashes.view(np.int64)), pa.array(_segment_hashes(h, begins, ends).view(np.int64)), pa.array(doc), packed]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor", "seg", "doc", "body"])

    return map_batches(listed, run, "anchor bigint, seg bigint, doc bigint, body binary")


def _indexed(rows: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
    """The smallest doc_id of every window of a shard's distinct segments."""
    table = pa.Table.from_batches(rows).combine_chunks()
    body = table.column("body").combine_chunks()
    _, offsets, data = body.buffers()
    bounds = np.frombuffer(offsets, np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view(np.uint64)
    bounds = (bounds - bounds[0]) // 8
    index = fm.Index(text, bounds, size)
    ends, length, lo = index.statistics(text, bounds, size)
    ends, lo = ends[length >= size], lo[length >= size]
    of = np.repeat(np.arange(len(body)), np.diff(bounds))[ends]
    own = table.column("doc").to_numpy()[of]
    key, place = np.unique(lo, return_inverse=True)
    least = np.full(len(key), np.iinfo(np.int64).max)
    np.minimum.at(least, place, own)
    cut = np.searchsorted(of, np.arange(len(body) + 1))
    each = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(least[place], pa.int64()))
    return pa.RecordBatch.from_arrays([table.column("anchor").combine_chunks(), table.column("seg").combine_chunks(), each], ["anchor", "seg", "least"])


def _windows(distinct: DataFrame, size: int, shard_words: int) -> DataFrame:
    """(anchor, seg, least): for each distinct segment the smallest doc_id of each of its windows. A partition is a row of shards, cut
    between anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, last = [], 0, None
        for batch in batches:
            while batch.num_rows:
                anchor = np.asarray(batch.column(0))
                if n >= shard_words and anchor[0] != last:
                    yield _indexed(held, size)
                    held, n = [], 0
                sums = n + np.cumsum(np.asarray(pc.binary_length(batch.column(3)))) // 8
                full = int(np.searchsorted(sums, shard_words))
                cut = len(anchor) if full >= len(anchor) - 1 else full + 1
                while cut < len(anchor) and anchor[cut] == anchor[cut - 1]:
                    cut += 1
                held.append(batch.slice(0, cut))
                n, last, batch = int(sums[cut - 1]), anchor[cut - 1], batch.slice(cut)
        if held:
            yield _indexed(held, size)

    return map_batches(distinct.repartition("anchor").sortWithinPartitions("anchor"), run, "anchor bigint, seg bigint, least array<bigint>")


def _kept(rows: DataFrame, size: int) -> DataFrame:
    """Words left in each text: (..., n_words, n_removed, kept)."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, starts in zip(batch.column(names.index("text")).to_pylist(), batch.column(names.index("starts")).to_pylist(), strict=True):
                own = (text or "").encode().split()
                counts.append(len(own))
                if starts:
                    gone = np.zeros(len(own) + 1, np.int64)
                    at = np.unique(np.array(starts))
                    gone[at] += 1
                    np.subtract.at(gone, at + size, 1)
                    stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
                    own = [own[i] for i in stay]
                removed.append(counts[-1] - len(own))
                kept.append(b" ".join(own).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], [*names, "n_words", "n_removed", "kept"])

    return map_batches(rows, run, f"{schema_of(rows)}, n_words bigint, n_removed bigint, kept string")


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document's words without those in a window of ``size`` words that also starts in a
    document with a smaller doc_id, joined by one space. Windows are judged on the input.

    Null and empty texts have no words; texts of fewer than ``size`` words stay. Documents without a doc_id are neither
    smaller nor larger than others: they stay as they are and remove nothing. Rows with the same doc_id remove nothing from
    one another; equal rows get equal results, one row each. Other columns are not read.
    """
    if not 0 < anchor < size:
        raise ValueError("an anchor must be shorter than a passage")
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.hash(text).alias("txt"), F.col(text).alias("text"))
    known = rows.where("doc is not null and text is not null")
    segments = settle(_shared(known.select("doc", "txt", "text"), size, anchor), "passages-segments")
    release(spark)
    source = segments.groupBy("anchor", "seg").agg(F.min(F.struct("doc", "txt", "place")).alias("at"))
    listed = source.select("at.*").groupBy("doc", "txt").agg(F.collect_list("place").alias("places"))
    bodies = _bodies(known.join(listed, ["doc", "txt"]).select("doc", "places", "text"), size, anchor)
    least = settle(_windows(bodies, size, shard_words), "passages-least")
    del bodies, listed, source
    release(spark)
    starts = (
        segments.join(least, ["anchor", "seg"])
        .select("doc", "txt", F.expr("filter(transform(least, (m, i) -> if(m < doc, place + i, null)), x -> x is not null)").alias("starts"))
        .where(F.size("starts") > 0).groupBy("doc", "txt").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )
    joined = rows.join(starts, ["doc", "txt"], "left").select("doc", "text", "starts")
    return _kept(joined, size).select(F.col("doc").alias("doc_id"), "n_words", "n_removed", "kept")
