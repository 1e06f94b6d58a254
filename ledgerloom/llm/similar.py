"""Exact Jaccard join of documents on word shingles, by universe partition and the pigeonhole principle.

A document is the set of its distinct shingles. Two sets with a Jaccard similarity of at least ``percent`` differ in at most H
shingles, where H follows from their sizes. Sizes are cut into bands; a pair belongs to the band of its larger set, and
a set takes part in its own band and, if its size allows, in the next one. In a band, shingles are hashed into segments:

* a segment is exact (a pair agrees on it if nothing differs there) or one-deletion (it agrees if at most one shingle
  differs: the subset itself and every subset with one shingle deleted are indexed). With weights 1 and 2, segments
  whose weights sum to H + 1 + spare leave every pair with agreeing segments of weight 1 + spare at least;
* a set therefore leaves out its ``spare`` lightest exact segments, with the fewest shingles: the order is one of contents, so the
  heaviest agreeing segment is among the lightest ``spare`` of neither set. A set that can differ from no partner of the band
  in H shingles, since it is smaller, leaves out as many more. Light segments are those in which texts meet
  that share no more than a common passage;
* how many segments are of either kind, and the spare, minimise a cost: signatures written plus chance meetings, estimated from
  the number of documents that the band has in the whole corpus. With more documents, segments grow longer.

Documents with a signature in common are candidates. Every shingle flips one of ``BITS`` bits of its set: sets in which more bits differ
than shingles may are no longer candidates, before any text moves. Candidates are verified on the shingles of their whole texts. First each set
is verified against one other that it shares a signature with, then against the leaders of its signatures in other components, then all
pairs that share a signature and are still in different components. So links between different texts decide every component, while a group of
thousands of near copies needs one comparison for each member. Equal sets are one node from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.texts import LOWERED, chunks, map_batches, mix, whole, windows, words
from ledgerloom.session import release, settle, settle_last

#: words of a shingle; similarity in percent
SHINGLE, PERCENT = 4, 85
#: a band's largest size over its smallest; what a chance meeting costs in signatures; rows that a task keeps
BAND, MEETING, KEEP = 1.4, 4.0, 1 << 20
#: bytes of a signature within its part; of a node, of which the least are taken that tell all sets apart; signatures of a part; rows in a piece
SIGN, NODE, PART, PIECE = 5, (6, 7, 8), 1 << 19, 1 << 16
#: parity bits of a set
BITS = 512
#: parts that the sets held against one set are dealt into
PARTS = 16
#: spare segments tried, as a share of those needed; for the estimate of chance meetings, how many of all pairs have a passage in
#: common, and what share of their texts it is
SPARES, PASSAGE, COMMON = (0, 0.1, 0.2, 0.35), 0.01, 0.1


def shingle_sets(h: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each row; a row of fewer words is one shingle, a row of none has none."""
    w = windows(h, k)
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        out.append(np.unique(w[a : z - k + 1]) if z - a >= k else whole(h[a:z]))
    return out


def set_hash(s: np.ndarray, seed: int) -> np.uint64:
    return mix(mix(s ^ np.uint64(seed * 2 + 1)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s)))[0]


def parity(s: np.ndarray) -> np.ndarray:
    """The bits of a set as 64-bit numbers: each shingle flips one."""
    flipped = np.bincount((mix(s ^ np.uint64(0xA5A5)) >> np.uint64(40)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(flipped.astype(np.uint8), bitorder="little").view("<i8")


class Bands:
    """Bands of set sizes with their segments."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.low = [1]
        while self.low[-1] < 1 << 40:
            self.low.append(int(self.low[-1] * BAND) + 1)
        self.plan: dict[int, tuple[int, int, int]] = {}
        self.skips: dict[tuple[int, ...], int] = {}

    def of(self, n: int) -> list[int]:
        """The bands that a set of n shingles takes part in: its own, and those of larger sets that it can be similar to."""
        own = int(np.searchsorted(self.low, n, "right")) - 1
        return list(range(own, int(np.searchsorted(self.low, 100 * n // self.percent, "right"))))

    def differ(self, band: int, n: int | None = None) -> int:
        """The most shingles in which a pair of the band differs: for sizes that sum to s, s - 2 * overlap. With ``n``, a pair of a set of that size."""
        top = self.low[band + 1] - 1
        most = 2 * top if n is None else n + min(top, 100 * n // self.percent)
        total = np.arange(max(2, most - 400), most + 1)
        need = -(-self.percent * total // (100 + self.percent))
        return int((total - 2 * need).max())

    def skipped(self, band: int, n: int) -> int:
        """How many exact segments a set of n shingles leaves out."""
        exact, _, spare = self.plan[band]
        key = band, n, exact, spare
        if key not in self.skips:
            self.skips[key] = min(exact, spare + self.differ(band) - self.differ(band, n))
        return self.skips[key]

    def choose(self, counts: dict[int, int]) -> None:
        """For every band (exact segments, one-deletion segments, spare) of least cost."""
        for band, n in counts.items():
            h = self.differ(band)
            if h < 1:
                continue  # only equal sets are similar enough
            size = self.low[band]  # the smallest sets of a band have the lightest segments
            best = None
            for extra in SPARES:
                spare = math.ceil(extra * (h + 1))
                need = h + 1 + spare
                for share in (0, 0.25, 0.5, 0.75, 1):
                    ones = min(need // 2, math.ceil(need * share / 2))
                    exact = need - 2 * ones
                    if exact <= spare and exact + ones > 1:
                        continue
                    fill = size / (exact + ones)
                    # shares of segments by how many shingles they hold; the lightest exact ones are spared
                    held = [math.exp(k * math.log(fill) - fill - math.lgamma(k + 1)) for k in range(60)]
                    skip, meet = float(spare), 0.0
                    for k, p in enumerate(held):
                        left = max(0.0, exact * p - skip)
                        skip = max(0.0, skip - exact * p)
                        meet += PASSAGE * p * (left * COMMON**k + ones * p * (COMMON**k + k * COMMON ** max(0, k - 1)))
                    cost = exact - spare + ones * (1 + fill) + MEETING * n * meet
                    if best is None or cost < best[0]:
                        best = (cost, exact, ones, spare)
            if best:
                self.plan[band] = best[1:]

    def expected(self, n: int) -> float:
        """About how many signatures a set of n shingles has."""
        plans = [(band, *self.plan[band][:2]) for band in self.of(n) if band in self.plan]
        return sum(exact - self.skipped(band, n) + ones + n * ones / (exact + ones) for band, exact, ones in plans)

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """All signatures of a set."""
        out = []
        for band in self.of(len(s)):
            if band not in self.plan:
                continue
            exact, ones, _ = self.plan[band]
            m, skip = exact + ones, self.skipped(band, len(s))
            salted = mix(s ^ np.uint64(0x51ED270B * (band + 1)))
            segment = ((salted >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(segment, kind="stable")
            salted, segment = salted[order], segment[order]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(salted)])
            edge = np.searchsorted(segment, np.arange(m + 1))
            total = sums[edge[1:]] - sums[edge[:-1]]
            place = (np.arange(m) + (band + 1) * (1 << 40)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            sign = total + place
            # the lightest exact segments are left out; among equals, those with the smallest signature
            use = np.ones(m, bool)
            use[np.lexsort((sign[:exact], np.diff(edge)[:exact]))[:skip]] = False
            out.append(sign[use])
            deleted = segment >= exact
            out.append((total[segment] - salted + place[segment])[deleted])
        return mix(np.unique(np.concatenate(out))) if out else np.zeros(0, np.uint64)


def _sets(rows: DataFrame, k: int, seed: int) -> DataFrame:
    """(doc, txt, n, node, proof, bits): the size of each row's set, two hashes of it and its parity bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in chunks(batches, "text"):
            sets = shingle_sets(*words(data, bounds, LOWERED), k)
            node, proof = (np.array([set_hash(s, x) for s in sets], np.uint64).view(np.int64) for x in (seed, seed + 1))
            bits = pa.ListArray.from_arrays(np.arange(0, BITS // 64 * len(sets) + 1, BITS // 64, dtype=np.int32), np.concatenate([parity(s) for s in sets]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(node), pa.array(proof), bits], ["doc", "txt", "n", "node", "proof", "bits"])

    return map_batches(rows, run, "doc bigint, txt bigint, n bigint, node bigint, proof bigint, bits array<bigint>")


def _mask(width: int) -> int:
    """The bits of a node of so many bytes, which is never negative."""
    return (1 << min(8 * width, 63)) - 1


def _placed(sig: np.ndarray, parts: int) -> np.ndarray:
    """Signatures as the number of their part, above ``SIGN`` bytes of their own."""
    low = np.uint64(8 * SIGN)
    return (((sig >> low) * np.uint64(parts) >> np.uint64(64 - 8 * SIGN)) << low) | (sig & np.uint64((1 << 8 * SIGN) - 1))


def _several(x: np.ndarray) -> np.ndarray:
    """Which numbers of a sorted list stand in it more than once."""
    same = x[1:] == x[:-1]
    return np.append(same, False) | np.append(False, same)


def _bytes(x: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(x, "<i8").view(np.uint8).reshape(-1, 8)[:, :width]


def _number(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), 8), np.uint8)
    out[:, : x.shape[1]] = x
    return out.view("<i8")[:, 0]


def _met(met: list[tuple[np.ndarray, int, int]], width: int, parts: int) -> Iterator[pa.RecordBatch]:
    """(part, packed) of a task's signatures: the first node of each, by doc_id, as bytes for the part of the signature; and, for numbers of parts below
    zero, pieces of whole rows (sig, node, lead) of signatures that several nodes of the task have, known to meet, sent anywhere. ``lead`` is -1 for the first."""
    met.sort(key=lambda x: (x[2], x[1]))  # so that a stable sort by signature alone leaves the first node first
    sig = np.concatenate([x[0] for x in met])
    node = np.repeat(np.array([x[1] for x in met], np.int64), [len(x[0]) for x in met])
    order = np.argsort(sig, kind="stable")
    sig, node = sig[order].view(np.int64), node[order]
    new = np.append(True, sig[1:] != sig[:-1])
    distinct = new | np.append(True, node[1:] != node[:-1])
    sig, node, new = sig[distinct], node[distinct], new[distinct]
    first, shared = np.flatnonzero(new), _several(sig)
    packed = np.concatenate([_bytes(sig[first], SIGN), _bytes(node[first], width)], axis=1)
    bounds = np.searchsorted(sig[first] >> 8 * SIGN, np.arange(parts + 1)) * (SIGN + width)
    filled = np.flatnonzero(np.diff(bounds))
    offsets = np.append(bounds[filled], bounds[-1]).astype(np.int64)
    data = pa.Array.from_buffers(pa.large_binary(), len(filled), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), data.cast(pa.binary())], ["part", "packed"])
    known = np.stack([sig, node, np.where(new, -1, node[first][np.cumsum(new) - 1])])[:, shared]
    pieces = [known[:, at : at + PIECE] for at in range(0, known.shape[1], PIECE)]
    if pieces:
        dealt = [-1 - int(mix(x[0, :1].astype(np.uint64) ^ x[1, :1].astype(np.uint64))[0] % np.uint64(parts)) for x in pieces]
        yield pa.RecordBatch.from_arrays([pa.array(dealt, pa.int32()), pa.array([x.tobytes() for x in pieces], pa.binary())], ["part", "packed"])


def _apart(rows: pa.Table, width: int) -> pa.Table:
    """(sig, node, lead) of a part: signatures that several nodes have."""
    part, packed = rows.column("part")[0].as_py(), rows.column("packed").to_pylist()
    if part < 0:
        sig, node, lead = np.concatenate([np.frombuffer(x, np.int64).reshape(3, -1) for x in packed], axis=1)
        return pa.table({"sig": sig, "node": node, "lead": pa.array(lead, mask=lead < 0)})
    data = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, SIGN + width)
    sig = _number(data[:, :SIGN])
    order = np.argsort(sig)
    order = order[_several(sig[order])]
    sig, node = sig[order], _number(data[order, SIGN:])
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    if len(sig):
        distinct = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1]))
        sig, node = sig[distinct], node[distinct]
        met = _several(sig)
        sig, node = sig[met], node[met]
    return pa.table({"sig": sig | part << 8 * SIGN, "node": node, "lead": pa.nulls(len(sig), pa.int64())})


def _meetings(rows: DataFrame, k: int, seed: int, bands: Bands, width: int, parts: int) -> DataFrame:
    """(sig, node, lead): signatures that several sets have; ``lead`` is a set that the task knows to have it too, or null. A task sends one entry of each signature to the
    shuffle, so a signature that very many sets have gives no more there than there are tasks. Signatures that only one set has, nearly all,
    cost the shuffle ``SIGN + width`` bytes each; a part holds about ``PART`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, n, mask = [], 0, _mask(width)
        for batch, data, bounds in chunks(batches, "text"):
            doc = np.asarray(batch.column(0).fill_null(np.iinfo(np.int64).max))
            for i, s in enumerate(shingle_sets(*words(data, bounds, LOWERED), k)):
                if len(s) and len(sig := bands.signatures(s)):
                    met.append((_placed(sig, parts), int(set_hash(s, seed)) & mask, int(doc[i])))
                    n += len(sig)
            if n >= KEEP:
                yield from _met(met, width, parts)
                met, n = [], 0
        if n:
            yield from _met(met, width, parts)

    def apart(table: pa.Table) -> pa.Table:
        return _apart(table, width)

    rows = map_batches(rows.select("doc", "text"), run, "part int, packed binary")
    return rows.groupBy("part").applyInArrow(apart, "sig bigint, node bigint, lead bigint")


def _distinct_rooms(meetings: DataFrame) -> DataFrame:
    """Meetings of one signature of each set of members: near copies have hundreds of signatures in common, and one says as much as all."""
    once = settle(meetings.groupBy("sig", "node").agg(F.min("lead").alias("lead")), "similar-meetings")
    marks = [F.sum(F.xxhash64(F.lit(x), "node").cast("decimal(38,0)")).alias(f"h{x}") for x in (1, 2)]
    rooms = once.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), *marks).groupBy("n", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig")
    return settle(once.join(rooms, "sig", "left_semi"), "similar-meetings")


def _led(members: DataFrame) -> DataFrame:
    """(sig, lead, lead_doc, lead_root): the set of the smallest doc_id of each signature. Copies are often later than what they copy."""
    least = members.groupBy("sig").agg(F.min(F.struct("doc", "node", "root")).alias("m"))
    return least.select("sig", F.col("m.node").alias("led_by"), F.col("m.doc").alias("led_doc"), F.col("m.root").alias("led_root"))


def _rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of signatures whose sets are in several components, with their component."""
    roots = components(links, "a", "b")
    named = settle(members.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "similar-members")
    split = named.groupBy("sig").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p != q").select("sig")
    return settle(named.join(split, "sig"), "similar-members")


def _near(x: str, y: str, percent: int) -> str:
    """Condition on (n, bits) of two sets: sizes are near enough, and no more bits differ than shingles may."""
    apart = " + ".join(f"bit_count({x}bits[{i}] ^ {y}bits[{i}])" for i in range(BITS // 64))
    sized = f"100 * {x}n >= {percent} * {y}n and 100 * {y}n >= {percent} * {x}n"
    return f"{sized} and {100 + percent} * ({apart}) <= {100 - percent} * ({x}n + {y}n)"


def _plausible(pairs: DataFrame, shapes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may be similar by size and bits."""
    both = pairs.join(shapes.toDF("a", "x_n", "x_bits"), "a").join(shapes.toDF("b", "y_n", "y_bits"), "b")
    return settle(both.where(_near("x_", "y_", percent)).select("a", "b"), "similar-pairs")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. The rows of an ``a`` are streamed behind its own, one set is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, None
        for batch, data, bounds in chunks(batches, "text"):
            a, b = (np.asarray(batch.column(i)) for i in (0, 1))
            good = np.zeros(len(a), bool)
            for i, s in enumerate(shingle_sets(*words(data, bounds, LOWERED), k)):
                if a[i] == b[i]:  # its own row comes first in every part
                    held, own = s, a[i]
                    continue
                assert own == a[i]
                small, large = sorted((held, s), key=len)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                good[i] = 100 * both >= percent * (len(small) + len(large) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], ["a", "b"])

    # a set that very many are held against is sent once for each of the parts that these are dealt into
    dealt = pairs.withColumn("part", F.pmod("b", F.lit(PARTS)))
    both = dealt.union(dealt.select("a", F.col("a").alias("b"), "part").distinct())
    sent = both.join(texts, both.b == texts.node).select("a", "b", "part", (F.col("a") != F.col("b")).alias("member"), "text")
    sent = sent.repartition("a", "part").sortWithinPartitions("a", "part", "member").select("a", "b", "text")
    return map_batches(sent, run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, txt): for every row the size of its shingle set, the smallest doc_id reachable over links, its
    own included, and a hash of its text that tells apart rows which share a doc_id.

    Words lie between ASCII white space, A-Z lowered. A text of fewer than ``shingle`` words, but some, is one shingle. Null,
    empty and wordless texts have no shingles and link with nothing: their component is their doc_id. Rows without a
    doc_id link like others, and take a component of null if nothing linked has a doc_id. Equal rows and
    rows that share a doc_id are judged by their texts, one result row each. An empty table gives none.
    """
    return settle_last("similar-found", lambda: _near_duplicates(docs, doc_id, text, shingle, percent))


def _width(sets: DataFrame) -> int | None:
    """The least bytes of a node that tell all sets apart; none if not all bytes do."""
    for width in NODE:
        nodes = sets.where("n > 0").groupBy(F.col("node").bitwiseAND(_mask(width))).agg(F.min("proof").alias("p"), F.max("proof").alias("q"))
        if nodes.where("p != q").limit(1).count() == 0:
            return width
    return None


def _near_duplicates(docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(text).alias("txt"), F.col(text).alias("text"))
    seed = 1
    while True:  # another seed if two sets share a node's hash
        sets = settle(_sets(rows, shingle, seed), "similar-sets")
        if width := _width(sets):
            break
        seed += 2
    sets = sets.withColumn("node", F.col("node").bitwiseAND(_mask(width)))
    bands = Bands(percent)
    sizes = sets.where("n > 0").groupBy(F.floor(F.log(F.col("n")) / math.log(1.01)).alias("step")).agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("docs"))
    counts: dict[int, int] = {}
    steps = sizes.collect()  # of one percent: a few thousand rows for any corpus
    for row in steps:
        for band in bands.of(row["n"]):
            counts[band] = counts.get(band, 0) + row["docs"]
    for band in list(counts):  # sizes of a step may reach one band further
        counts.setdefault(band + 1, counts[band])
    bands.choose(counts)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(sum(row["docs"] * bands.expected(row["n"]) for row in steps) / PART))
    meetings = settle(_meetings(rows, shingle, seed, bands, width, min(parts, 1 << 22)), "similar-meetings")
    release(spark)
    meetings = _distinct_rooms(meetings)
    least = sets.where("n > 0").groupBy("node").agg(F.min(F.struct(F.coalesce("doc", F.lit((1 << 63) - 1)).alias("doc"), "txt")).alias("at"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    holder = least.join(meetings.select("node").distinct(), "node", "left_semi")
    shapes = settle(holder.select("node", "n", "bits"), "similar-shapes")
    rooms = holder.select("node", F.col("at.doc").alias("d"), F.col("at.txt").alias("t"))
    texts = rows.join(rooms, (F.coalesce("doc", F.lit((1 << 63) - 1)) == F.col("d")) & (F.col("txt") == F.col("t"))).select("node", "text").dropDuplicates(["node"])
    texts = settle(texts, "similar-texts")
    release(spark)

    members = settle(meetings.join(holder.select("node", F.col("at.doc").alias("doc")), "node").withColumn("root", F.col("node")), "similar-members")
    # every set with one other: the set of the smallest doc_id that it meets
    pairs = members.join(_led(members), "sig").select("node", F.struct("led_doc", "led_by").alias("x")).union(members.where("lead is not null").select("node", F.struct(F.col("doc"), F.col("lead"))))
    pairs = pairs.where("x.led_by != node").groupBy("node").agg(F.min("x").alias("x")).select(F.col("x.led_by").alias("a"), F.col("node").alias("b"))
    links = settle(_verified(_plausible(pairs, shapes, percent), texts, shingle, percent), "similar-links")
    # then with those that lead its signatures and are in another component
    members = _rooted(members.select("sig", "node", "doc"), links)
    pairs = members.join(_led(members), "sig").where("root != led_root").select(F.col("led_by").alias("a"), F.col("node").alias("b")).distinct()
    links = settle(links.union(_verified(_plausible(pairs, shapes, percent), texts, shingle, percent)), "similar-links")
    # then all that meet and are still apart
    members = _rooted(members, links).join(shapes, "node")
    near = F.expr(f"x.sig = y.sig and x.root < y.root and {_near('x.', 'y.', percent)}")
    pairs = members.alias("x").join(members.alias("y"), near).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    links = settle(links.union(_verified(settle(pairs, "similar-pairs"), texts, shingle, percent)), "similar-links")
    roots = components(links, "a", "b")
    member = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    member = settle(member.select("doc", "txt", "n", "root"), "similar-members")
    smallest = member.where("n > 0").groupBy("root").agg(F.min("doc").alias("least"))
    out = member.join(smallest, "root", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"), "txt")
