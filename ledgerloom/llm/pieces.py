"""SentencePiece encoding and decoding by vectorised merge rounds.

A vocabulary is read with the public library; the merges are done here. Text is cut where no piece can reach:
before a space that follows something else, and around line breaks. Every distinct segment of a chunk is
encoded once, all of them side by side, as one flat numpy array of symbols:

* in each round every segment finds its best pair (a segmented minimum of pair ranks);
* all occurrences of that pair, leftmost first and without overlap, merge at once. A merge that makes a pair as
  good as the present one or better must be followed by that pair, so the occurrences behind the first such
  merge wait for the next round. The order is therefore the one of the library: best score, then leftmost;
* segments without a pair leave the array, until none is left.

Runs of spaces are cut into the longest space piece, leaving one to that many at the end: space pieces have equal
scores and so grow from the left, and only the last space can join what follows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.texts import chunks, map_batches, schema_of, without

SPACE = "▁"
#: distinct segments kept from one chunk to the next by a task
MEMO = 150_000
_NONE = np.int32(2**31 - 1)


class Pieces:
    """A BPE vocabulary with byte fallback and no text normalisation but for spaces."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.bos, self.eos, self.unk = len(model), model.bos_id(), model.eos_id(), model.unk_id()
        names = [model.id_to_piece(i) for i in range(self.size)]
        special = {i for i in range(self.size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        normal = {p: i for i, p in enumerate(names) if i not in special}
        if any(SPACE in p.lstrip(SPACE) for p in normal) or any("\n" in p and len(p) > 1 for p in normal):
            raise ValueError("pieces that hold a space behind other characters, or a line break, are not supported")
        if model.encode("a  b ") != model.encode("a  b ", add_bos=False) or model.decode(model.encode(" a  b ")) != " a  b ":
            raise ValueError("only vocabularies that keep all spaces are supported")
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)

        # characters: a piece, or a symbol of its own beyond the vocabulary, to be written as bytes
        self.chars = (np.arange(0x110000) + self.size).astype(np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        self.chars[0x20] = self.chars[ord(SPACE)]

        # pairs: ranks by score, equal scores share a rank
        scores = np.array([model.get_score(i) for i in range(self.size)])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        pairs = [(normal[p[:k]], normal[p[k:]], i) for p, i in normal.items() for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
        left, right, made = np.array(pairs, np.int64).reshape(-1, 3).T
        self._hash(left << 21 | right, rank[made], made.astype(np.int32))
        self.spaces = max([len(p) for p in normal if not p.strip(SPACE)], default=1)
        self.cut = re.compile(rf"\n|{SPACE}{{{self.spaces}}}(?={SPACE})|{SPACE}{{0,{self.spaces}}}[^{SPACE}\n]+|{SPACE}{{1,{self.spaces}}}")

        # decoding: the bytes of each piece
        surface = [b"" if model.is_control(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        surface[self.unk] = model.decode([self.unk]).encode()
        for b, i in enumerate(self.bytes):
            surface[i] = bytes([b])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_len = np.array([len(s) for s in surface])
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.silent = np.array([model.is_control(i) for i in range(self.size)])
        self.spaced = np.array([p.startswith(SPACE) and i not in special for i, p in enumerate(names)])
        self.memo: dict[str, int] = {}
        self._reset()

    # pair table: open addressing, probed for all pairs at once

    def _hash(self, keys: np.ndarray, rank: np.ndarray, made: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 8).bit_length())
        size = 1 << self.bits
        self.keys, self.ranks, self.made = np.full(size, -1), np.full(size, _NONE), np.zeros(size, np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] < 0
            first = todo[free][np.unique(slot[todo[free]], return_index=True)[1]]
            self.keys[slot[first]], self.ranks[slot[first]], self.made[slot[first]] = keys[first], rank[first], made[first]
            todo = np.setdiff1d(todo, first)
            todo_taken = self.keys[slot[todo]] >= 0
            slot[todo[todo_taken]] = (slot[todo[todo_taken]] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, -1 where the pair makes no piece."""
        keys = left.astype(np.int64) << 21 | right
        slot = self._slot(keys)
        found = self.keys[slot]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        slot[found < 0] = -1
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            slot[open_[found < 0]] = -1
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        return slot

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        slot = self._pairs(left, right)
        return np.where(slot < 0, _NONE, self.ranks[slot])

    # encoding

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments behind one another, and how many each has."""
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        sym = self.chars[points]
        seg = np.repeat(np.arange(len(segments)), np.fromiter(map(len, segments), np.int64, len(segments)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            last = np.append(seg[1:] != seg[:-1], True)
            slot = np.full(len(sym), -1)
            inner = np.flatnonzero(~last)
            slot[inner] = self._pairs(sym[inner], sym[inner + 1])
            rank = np.where(slot < 0, _NONE, self.ranks[slot])
            begin = np.flatnonzero(np.append(True, last[:-1]))
            size = np.diff(np.append(begin, len(sym)))
            best = np.minimum.reduceat(rank, begin)
            more = np.repeat(best != _NONE, size)
            if not more.all():  # compaction: finished segments leave
                done.append((seg[~more], sym[~more]))
                sym, seg, slot, rank, last = sym[more], seg[more], slot[more], rank[more], last[more]
                if not len(sym):
                    break
                open_ = best != _NONE
                best, size = best[open_], size[open_]
                begin = np.cumsum(size) - size
            least = np.repeat(best, size)
            at = np.flatnonzero(rank == least)
            run = np.append(True, np.diff(at) != 1)  # in a run of overlapping pairs every other one, from the left
            offset = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            at = at[offset % 2 == 0]
            made = self.made[slot[at]]
            # what each merge would put beside it: left as merged already, right as it stands
            changed = sym.copy()
            changed[at + 1] = made
            has_left = at > 0
            has_left[has_left] = seg[at[has_left] - 1] == seg[at[has_left]]
            has_right = ~last[at + 1]
            clash = np.zeros(len(at), bool)
            clash[has_left] = self._rank(changed[at[has_left] - 1], made[has_left]) <= least[at[has_left]]
            clash[has_right] |= self._rank(made[has_right], sym[at[has_right] + 2]) <= least[at[has_right]]
            if clash.any():
                group = np.repeat(np.arange(len(begin)), size)[at]
                stop = np.full(len(begin), len(sym))
                np.minimum.at(stop, group[clash], at[clash])
                keep = at <= stop[group]
                at, made = at[keep], made[keep]
            sym[at] = made
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, seg = sym[stay], seg[stay]
        if not done:
            return np.zeros(0, np.uint32), np.zeros(len(segments), np.int64)
        seg, sym = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(seg, kind="stable")
        return self._bytes(seg[order], sym[order], len(segments))

    def _bytes(self, seg: np.ndarray, sym: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols beyond the vocabulary are written as the ids of their UTF-8 bytes."""
        point = np.maximum(sym - self.size, 0)
        plain = sym < self.size
        width = np.where(plain, 1, 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF))
        ids = np.repeat(sym, width)
        at = np.cumsum(width) - width
        for w in (1, 2, 3, 4):
            some = np.flatnonzero(~plain & (width == w))
            for k in range(w):
                rest = point[some] >> 6 * (w - 1 - k)
                lead = {1: 0, 2: 0xC0, 3: 0xE0, 4: 0xF0}[w]
                ids[at[some] + k] = self.bytes[rest | lead if k == 0 else rest & 0x3F | 0x80]
        return ids.astype(np.uint32), np.bincount(seg, width, n).astype(np.int64)

    def _reset(self) -> None:
        self.memo.clear()
        self.ids, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, with begin and end ids, and the bounds of each text."""
        segments: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                found = self.cut.findall(SPACE + text.replace(" ", SPACE))
                segments += found
                counts[i] = len(found)
        if len(self.memo) > MEMO:
            self._reset()
        new = [s for s in dict.fromkeys(segments) if s not in self.memo]
        if new:
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
            ids, count = self.merge(new)
            self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        which = np.fromiter(map(self.memo.__getitem__, segments), np.int64, len(segments))
        begin = np.cumsum(self.count) - self.count
        size = self.count[which]
        text_of = np.repeat(np.arange(len(texts)), counts)
        per_text = np.bincount(text_of, size, len(texts)).astype(np.int64) + 2
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        out = np.empty(bounds[-1], np.uint32)
        out[bounds[:-1]], out[bounds[1:] - 1] = self.bos, self.eos
        body = np.ones(len(out), bool)
        body[bounds[:-1]] = body[bounds[1:] - 1] = False
        out[body] = self.ids[np.repeat(begin[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        return out, bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each run of ids; the space before the first piece is not part of it."""
        size = self.surface_len[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        out = self.surface[np.repeat(self.surface_at[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
        loud = np.flatnonzero(~self.silent[ids])
        first = np.searchsorted(loud, bounds[:-1])
        lead = np.zeros(len(bounds) - 1, np.int64)
        some = first < len(loud)
        where = loud[first[some]]
        lead[some] = self.spaced[ids[where]] & (where < bounds[1:][some])
        edges = total[bounds]
        return [out[a + k : b].decode("utf-8", "replace") for a, b, k in zip(edges[:-1], edges[1:], lead, strict=True)]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """A vocabulary, once per Python worker."""
    return Pieces(path)


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns of ``docs`` with two more: ``ids``, the ids of the whole text as little-endian 32-bit integers with begin and
    end ids, and ``decoded``, the text read back from those ids.

    ``path`` names the vocabulary file, which every executor has. Null and empty texts give the begin and end ids and an
    empty decoded text. Repeated rows give equal results, an empty table gives no rows. An input column called
    like a new one gives way to it.
    """
    docs = without(docs, ids, decoded)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch, _, _ in chunks(batches, text):
            texts = [t or "" for t in batch.column(names.index(text)).to_pylist()]
            flat, bounds = pieces.encode(texts)
            raw = flat.astype("<u4").tobytes()
            packed = pa.array([raw[4 * a : 4 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed, pa.array(pieces.decode(flat, bounds), pa.string())], [*names, ids, decoded])

    return map_batches(docs, run, f"{schema_of(docs)}, `{ids}` binary, `{decoded}` string")
