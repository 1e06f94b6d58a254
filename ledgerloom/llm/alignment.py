"""Tokens of two tokenizers side by side: groups that cover the same bytes, and links between tokens that end together.

Both vocabularies are read with their public libraries, which encode the texts. Each side has a dictionary from the byte
at which a token ends to the token's place. The ends that are keys of both dictionaries, sorted, cut both id lists into groups; in
each group the tokens that end together are linked.

Texts are cut before blanks and line breaks that follow something else: no token of either side reaches over such a cut, so both sides end there,
and the groups of a text are the groups of its segments, one behind another. A task encodes and aligns each segment once and keeps the result. Texts
with a segment that its tokens do not spell are encoded whole, and so are all texts if a vocabulary has tokens over a cut.

How often a pair of ids is linked in the corpus is counted in Spark. Documents go in blocks of some megabytes of text; a block keeps its
links as places in its list of distinct pairs. Only the distinct pairs of each block are shuffled: once to be summed, once to fetch
the sums. The encoded blocks are written once, so nothing is encoded twice.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.texts import chunks, held, map_batches, schema_of
from ledgerloom.session import settle

#: bytes of text in a block; a longer text is a block of its own
BLOCK = 1 << 19
#: distinct segments, and their characters, kept from one block to the next by a task
MEMO, MEMO_CHARS = 200_000, 8_000_000
SPACE = "▁"
# Characters that are white space in any version of Unicode, and those of them that never begin a segment.
_GAP = "\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
GAPS = frozenset(re.findall(f"[ \n{_GAP}]", "".join(map(chr, range(0x10000)))))
#: a segment: a blank or line break, and all up to the next one that follows something else
SEGMENTS = re.compile(f"[ \n][ \n{_GAP}]*[^ \n{_GAP}]*(?:[{_GAP}][ \n{_GAP}]*[^ \n{_GAP}]*)*")
#: what a document gets besides the sums of its links
OWN = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"


class Tokens:
    """Ids of whole texts, and the bytes that each id stands for."""

    surface: list[bytes]

    def lay_out(self) -> None:
        self.length = np.array([len(s) for s in self.surface], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids behind one another."""
        size = self.length[ids]
        total = int(size.sum())
        wide = np.int32 if total < 1 << 31 else np.int64
        shift = (self.at[ids] - (np.cumsum(size) - size)).astype(wide)
        return self.flat[np.repeat(shift, size) + np.arange(total, dtype=wide)].tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another, and how many each has."""
        raise NotImplementedError


class ByteLevel(Tokens):
    """A byte-level vocabulary of the tokenizers library; strings of special tokens in a text are plain text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_padding()
        self.model.no_truncation()
        # byte-level letters: a printable byte stands for itself, the others take the code points from 256 on
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        names = {i: t for t, i in self.model.get_vocab(with_added_tokens=True).items()}
        parts = json.loads(self.model.to_str())
        added = {t["id"] for t in parts["added_tokens"]}
        self.surface = [names[i].encode() if i in added else bytes(byte_of[c] for c in names[i]) if i in names else b"" for i in range(max(names) + 1)]
        self.lay_out()
        #: whether merges stay inside the words of the byte-level pattern, so that no token reaches over the cut between two segments
        cutter = parts["pre_tokenizer"] or {}
        pattern = (cutter.get("type"), cutter.get("use_regex", True), cutter.get("add_prefix_space")) == ("ByteLevel", True, False)
        self.local = pattern and parts["normalizer"] is None and all(t["special"] for t in parts["added_tokens"])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        done = self.model.encode(texts, is_pretokenized=True, add_special_tokens=False)  # each text by itself
        return np.array(done.ids, np.int64), np.bincount(np.array(done.word_ids, np.int64), minlength=len(texts))

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Segments that do not end in white space, as one text."""
        ids = np.array(self.model.encode_batch_fast(["".join(segments)], add_special_tokens=False)[0].ids, np.int64)
        ends, bounds = np.cumsum(self.length[ids]), np.cumsum([len(s.encode()) for s in segments])
        if not len(ids) or ends[-1] != bounds[-1]:  # bytes that the vocabulary does not have
            return self.encode(segments)
        return ids, np.diff(np.searchsorted(ends, bounds, "right"), prepend=0)


class Pieces(Tokens):
    """A vocabulary of the sentencepiece library, which puts a space before a text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        name, n = self.model.id_to_piece, len(self.model)
        self.surface = [bytes([int(name(i)[3:5], 16)]) if self.model.is_byte(i) else name(i).replace(SPACE, " ").encode() for i in range(n)]
        self.lay_out()

        pieces = [name(i) for i in range(n)]
        over = any(SPACE in p.lstrip(SPACE) or "\n" in p and len(p) > 1 for p in pieces)
        self.lead = self.model.encode("\n")[:1]
        #: whether no piece reaches over the cut between two segments, all blanks are kept, and a blank alone is a piece
        self.local = not over and self.model.decode(self.model.encode(" a  b ")) == " a  b " and [name(i) for i in self.lead] == [SPACE]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._one_run(self.model.encode(texts, num_threads=1))

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As they stand in a text: the library puts a space before each one, which stands for the blank of a segment that begins with one, and is a
        piece of its own before a line break."""
        lists = self.model.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        for i, s in enumerate(segments):
            if s[0] != " ":
                lists[i] = lists[i][1:]
            elif len(s) == 1:
                lists[i] = self.lead
        return self._one_run(lists)

    def _one_run(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int64, sizes.sum()), sizes


def common_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """The places of the tokens on both sides that end at the same byte, in order; ``a`` and ``b`` are rising ends."""
    at_a, at_b = dict(zip(a, range(len(a)))), dict(zip(b, range(len(b))))
    both = sorted(at_a.keys() & at_b.keys())
    return list(map(at_a.__getitem__, both)), list(map(at_b.__getitem__, both))


class Names:
    """Decimal names of ids as flat bytes, each with room for the sign behind it."""

    def __init__(self, n: int) -> None:
        names = [b"%d," % i for i in range(n)]
        self.size = np.array([len(x) for x in names], np.int32)
        self.at = np.cumsum(self.size, dtype=np.int32) - self.size
        self.flat = np.frombuffer(b"".join(names), np.uint8)

    def write(self, ids: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All names behind one another, each followed by its sign, and where each one ends."""
        size = self.size[ids]
        ends = np.cumsum(size, dtype=np.int64)
        shift = self.at[ids] - (ends - size)
        wide = np.int32 if len(ends) and ends[-1] < 1 << 31 else np.int64
        out = self.flat[np.repeat(shift.astype(wide), size) + np.arange(ends[-1] if len(ends) else 0, dtype=wide)]
        out[ends - 1] = signs
        return out, ends


@lru_cache(maxsize=1)
def names(n: int) -> Names:
    return Names(n)


def _groups(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of a run of documents as flat text ``a1,a2|b1;a3|b2,b3`` and where each document ends in it. ``ends`` are the places of the
    last tokens of all groups, ``bounds`` the groups of each document."""
    n = len(ends_a)
    size_a, size_b = np.diff(ends_a, prepend=-1), np.diff(ends_b, prepend=-1)
    done_a, done_b = np.cumsum(size_a), np.cumsum(size_b)
    at_a = np.arange(len(a)) + np.repeat(done_b - size_b, size_a)
    at_b = np.arange(len(b)) + np.repeat(done_a, size_b)
    ids, signs = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[at_a], ids[at_b] = a, b
    signs[done_a + done_b - size_b - 1], signs[done_a + done_b - 1] = ord("|"), ord(";")
    text, ends = names(int(ids.max()) + 1 if len(ids) > 0 and ids.max() >= 60_000 else 60_000).write(ids, signs)
    last = np.concatenate([[0], ends[(done_a + done_b - 1)]]) if n else np.zeros(1, np.int64)
    return text, last[bounds]


class Aligner:
    """Both vocabularies, and the aligned segments that a task keeps."""

    def __init__(self, a: ByteLevel, b: Pieces) -> None:
        self.a, self.b, self.local = a, b, a.local and b.local
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.chars = 0
        self.groups: list[bytes] = []
        self.spelled = np.zeros(0, bool)
        self.used = np.zeros(0, np.int64)
        self.counts = np.zeros((3, 0), np.int64)  # tokens of both sides, groups
        self.links = np.zeros(0, np.int64)

    def _tidy(self) -> None:
        """Keep what was met more than once, if that is not too much."""
        keep = np.flatnonzero(self.used > 1)
        names = list(self.memo)  # in the order of their places
        names = [names[i] for i in keep.tolist()]
        chars, n_links = sum(map(len, names)), self.counts[2]
        if 2 * len(keep) > MEMO or 2 * chars > MEMO_CHARS:
            return self._forget()
        self.links = self.links[np.repeat(self.used > 1, n_links)]
        self.memo, self.chars, self.groups = dict(zip(names, range(len(names)), strict=True)), chars, [self.groups[i] for i in keep.tolist()]
        self.spelled, self.counts, self.used = self.spelled[keep], self.counts[:, keep], np.zeros(len(keep), np.int64)

    def _learn(self, keys: list[str], said: list[str], a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> None:
        """Align strings by the tokens of both sides and keep what comes out under their keys; those that the tokens do not spell get none."""
        want = [s.encode() for s in said]
        size = np.fromiter(map(len, want), np.int64, len(want))
        spelled = np.ones(len(said), bool)
        for side, (ids, n) in ((self.a, a), (self.b, b)):
            spoken, ends = side.joined(ids), np.concatenate([[0], np.cumsum(side.length[ids])])[np.concatenate([[0], np.cumsum(n)])]
            if spoken != b"".join(want) or (np.diff(ends) != size).any():
                spelled &= [spoken[lo:hi] == w for lo, hi, w in zip(ends[:-1].tolist(), ends[1:].tolist(), want, strict=True)]
        (ids_a, n_a), (ids_b, n_b) = ((ids[np.repeat(spelled, n)], np.where(spelled, n, 0)) for ids, n in (a, b))
        run_a, run_b = np.cumsum(self.a.length[ids_a]), np.cumsum(self.b.length[ids_b])
        last_a, last_b = (np.array(x, np.int64) for x in common_ends(run_a.tolist(), run_b.tolist()))
        bounds = np.concatenate([[0], np.searchsorted(run_a[last_a], np.cumsum(np.where(spelled, size, 0)), "right")])
        text, ends = _groups(ids_a, ids_b, last_a, last_b, bounds)
        raw, ends = text.tobytes(), ends.tolist()
        self.memo.update(zip(keys, range(len(self.groups), len(self.groups) + len(keys)), strict=True))
        self.chars += sum(map(len, said))
        self.groups += [raw[lo : hi - 1] if hi > lo else b"" for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        self.spelled = np.concatenate([self.spelled, spelled])
        self.used = np.concatenate([self.used, np.zeros(len(said), np.int64)])
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, np.diff(bounds)])], axis=1)
        self.links = np.concatenate([self.links, ids_a[last_a] << 32 | ids_b[last_b]])

    def _known(self, strings: list[str]) -> np.ndarray:
        return np.fromiter(map(self.memo.__getitem__, strings), np.int64, len(strings))

    def align(self, texts: list[str], digest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """For each text its counts (n_a, n_b, n_groups, n_links); the distinct links of all texts as id pairs (a in the upper half), how many links each has,
        and for every link the place of its pair; the groups as text or as its digest. Texts whose tokens do not spell a space and the text
        have no tokens."""
        if len(self.memo) > MEMO or self.chars > MEMO_CHARS:
            self._tidy()
        parts = [SEGMENTS.findall(" " + t) if t and self.local else [] for t in texts]
        if new := [s for s in dict.fromkeys(chain.from_iterable(parts)) if s not in self.memo]:
            loose = [s for s in new if s[-1] in GAPS]
            for some, encode in (([s for s in new if s[-1] not in GAPS] if loose else new, self.a.encode_segments), (loose, self.a.encode)):
                if some:
                    self._learn(some, some, encode(some), self.b.encode_segments(some))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        which = self._known(list(chain.from_iterable(parts)))
        bad = np.bincount(np.repeat(np.arange(len(texts)), sizes), ~self.spelled[which], len(texts)) > 0
        if odd := [i for i, t in enumerate(texts) if t and (bad[i] or not self.local)]:
            for i in odd:
                parts[i] = ["\0 " + texts[i]]  # no segment begins like this
            if new := [s for s in dict.fromkeys(parts[i][0] for i in odd) if s not in self.memo]:
                self._learn(new, [s[1:] for s in new], self.a.encode([s[1:] for s in new]), self.b.encode([s[2:] for s in new]))
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            which = self._known(list(chain.from_iterable(parts)))
        edges = np.concatenate([[0], np.cumsum(sizes)])
        sums = np.diff(np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(self.counts[:, which], axis=1)], axis=1)[:, edges], axis=1)
        # the links of the block: those of its distinct segments, then of all
        own, at, often = np.unique(which, return_inverse=True, return_counts=True)
        self.used[own] += often
        n_links = self.counts[2]
        first = np.cumsum(n_links) - n_links
        spread = lambda begin, size: np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        size = n_links[own]
        pairs, place = np.unique(self.links[spread(first[own], size)], return_inverse=True)
        n = np.bincount(place, np.repeat(often, size), len(pairs)).astype(np.int64)
        places = place.astype("<u4")[spread((np.cumsum(size) - size)[at], size[at])]
        said, edges = list(map(self.groups.__getitem__, which.tolist())), edges.tolist()
        joined = (b";".join(said[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:], strict=True))
        written = [(sha256(x).hexdigest() if digest else x.decode()) if x else "" for x in joined]
        return np.concatenate([sums, sums[2:]]), pairs, n, places, written


@lru_cache(maxsize=2)
def load(byte_path: str, piece_path: str) -> Aligner:
    """Both vocabularies, once per Python worker."""
    return Aligner(ByteLevel(byte_path), Pieces(piece_path))


def _encoded(docs: DataFrame, text: str, byte_path: str, piece_path: str, digest: bool) -> DataFrame:
    """One row per block: its documents with their own results, the distinct pairs with their counts, and for every link its pair's place."""
    kept = [c for c in docs.columns if c != text]
    given = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    own = [x.split()[0] for x in OWN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(byte_path, piece_path)
        for batch, _, _ in chunks(batches, text, BLOCK):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            counts, pairs, n, places, groups = aligner.align(texts, digest)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            struct = pa.StructArray.from_arrays([*columns, *[pa.array(c) for c in counts], pa.array(groups, pa.string())], names=[*kept, *own])
            one = lambda values, kind: pa.array([values], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct), one(pairs, pa.int64()), one(n, pa.int64()), pa.array([places.tobytes()], pa.binary())],
                ["docs", "pairs", "n", "places"],
            )

    inner = ", ".join([*(f"`{f.name}`: {f.dataType.simpleString()}" for f in given.fields), *(x.replace(" ", ": ") for x in OWN.split(", "))])
    return map_batches(docs, run, f"docs array<struct<{inner}>>, pairs array<bigint>, n array<bigint>, places binary")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Every linked pair of ids (``pair``, a in the upper half) with ``count``, how many links hold it, and ``best``, whether no pair of its b id has more.
    The pairs of one b id are at most as many as the other vocabulary has ids."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "n")).alias("x")).select("x.pairs", "x.n")
    sums = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    return sums.select("pair", "count", (F.col("count") == most).alias("best"))


def aligned(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """The documents, and the linked pairs of ids (see ``pair_counts``).

    The first frame has all columns of ``docs`` but the text, and ``n_a``, ``n_b`` (tokens of the byte-level vocabulary, for a space and the text, and of
    the pieces), ``n_groups``, ``n_links``, ``groups`` (``a1,a2|b1;a3|b2,b3``; with ``digest`` the SHA-256 of it in hex), ``n_best``
    (links whose pair is the most frequent one of its b id, ties included) and ``count_sum`` (of the pair's links, over the links).

    Null and empty texts, and texts that the tokens of either side do not spell, have no tokens: zeros and an empty text for the groups.
    Repeated rows count each for itself. A very long text is a block of its own. An empty table gives no rows. Input
    columns called like the new ones give way to them. Both files are where every executor can read them.
    """
    new = [x.split()[0] for x in f"{OWN}, n_best bigint, count_sum bigint".split(", ")]
    kept = [c for c in docs.columns if c not in (text, *new)]
    said = docs.select(*[F.col(f"`{c}`") for c in [*kept, text]])
    mine = held(said)
    blocks = settle(_encoded(mine, f"_in_{text}", byte_path, piece_path, digest).withColumn("block", F.monotonically_increasing_id()), "aligned")
    counts = settle(pair_counts(blocks), "pair_counts")
    asked = blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("at", "asked"))
    fetched = asked.join(counts, F.col("asked") == F.col("pair")).select("of", "at", "count", "best")
    schema = ", ".join([schema_of(mine.drop(f"_in_{text}")), OWN, "n_best bigint, count_sum bigint"] if kept else [OWN, "n_best bigint, count_sum bigint"])

    def sums(block: pa.Table, scores: pa.Table) -> pa.Table:
        rows = pa.Table.from_struct_array(block.column("docs").combine_chunks().flatten())
        at = scores.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], best[at] = scores.column("count").to_numpy(), scores.column("best").to_numpy(zero_copy_only=False)
        places = np.frombuffer(block.column("places")[0].as_buffer(), "<u4")
        edges = np.concatenate([[0], np.cumsum(rows.column("n_links").to_numpy())])
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[places])])[edges])
        return rows.append_column("n_best", pa.array(total(best))).append_column("count_sum", pa.array(total(count)))

    pairs_of = blocks.select("block", "docs", "places").groupBy("block").cogroup(fetched.groupBy("of"))
    done = pairs_of.applyInArrow(sums, schema)
    return done.select(*[F.col(f"`_in_{c}`").alias(c) for c in kept], *new), counts
