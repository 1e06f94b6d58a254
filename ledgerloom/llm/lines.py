"""Quality rules, line first: rules judge each line, failing lines go, and a document that loses too much of its text is rejected."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.texts import PLAIN, byte_table, chunks, hashes, map_batches, mix, row_of, schema_of, spans, windows, without

#: fixed values of the base rules
SYMBOLS, MIN_WORDS, REPEAT_PERCENT = b"#*$%&|<>", 50, 50
#: fixed values of the line rules: ends of a sentence, menu marks, phrases of page furniture
SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？", ":", ";", '"', "'", "”", "’", "»", ")", "]", "}")
MENU_MARKS = re.compile(r"[|»›·•]|(?<=\s)>(?=\s)|(?<=\s)/(?=\s)")
FURNITURE = re.compile(
    r"all rights reserved|cookie (?:policy|settings|consent)|accept (?:all )?cookies|privacy policy|terms of (?:use|service)|enable javascript|skip to (?:main )?content|"
    r"back to top|log ?in to (?:continue|comment)|sign up for our newsletter|subscribe to our|share (?:this )?on (?:facebook|twitter)|click here to|page not found|lorem ipsum",
    re.I,
)
#: a line of fewer words without an end of sentence is a menu entry; shares of marks; share of text that may go
MENU_WORDS, MIN_MARKS, MARK_SHARE, MENU_SHARE, LOST_SHARE = 4, 4, 0.25, 0.2, 0.5

_ANY = byte_table(b"\n")
_INSIDE = (PLAIN != 0).astype(np.int64)
_POINT = (np.arange(256) & 0xC0) != 0x80
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8)).astype(np.int64)


def line_fails(line: str) -> str:
    """The rule that a line breaks, or "". A line without words breaks none.

    punctuation: four or more of its characters besides white space, and over a quarter, are neither letters nor digits.
    navigation: menu marks between few words, or under four words and no end of sentence.
    boilerplate: a phrase of page furniture in a line of at most thirty words.
    """
    parts = line.split()
    if not parts:
        return ""
    body = "".join(parts)
    marks = len(body) - sum(map(str.isalnum, body))
    if marks >= MIN_MARKS and marks > MARK_SHARE * len(body):
        return "punctuation"
    if len(MENU_MARKS.findall(line)) >= max(2, MENU_SHARE * len(parts)) or len(parts) < MENU_WORDS and not body.endswith(SENTENCE_ENDS):
        return "navigation"
    if len(parts) <= 30 and FURNITURE.search(line):
        return "boilerplate"
    return ""


def clean(text: str) -> tuple[str, int, int]:
    """A text without its failing lines, how many went, and the word characters that went with them."""
    lines = text.split("\n")
    fails = [bool(line_fails(line)) for line in lines]
    if not any(fails):
        return text, 0, 0
    gone = sum(len("".join(line.split())) for line, bad in zip(lines, fails, strict=True) if bad)
    return "\n".join(line for line, bad in zip(lines, fails, strict=True) if not bad), sum(fails), gone


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys stand twice or more, and which repeat one before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, later


def _measures(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    starts, ends, first = spans(data, bounds, PLAIN)
    n_rows, n_words = len(bounds) - 1, np.diff(first)

    def per_row(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])

    inside = _INSIDE[data]
    out = {"n_words": n_words, "word_chars": per_row(inside * _POINT[data]), "n_symbols": per_row(_SYMBOL[data])}

    # lines: between line breaks and row bounds
    seen = np.concatenate([[0], np.cumsum(inside)])
    begins, stops, line_first = spans(data, bounds, _ANY)
    wordy = seen[stops] > seen[begins]
    row = row_of(line_first)[wordy]
    _, later = _twice(mix(hashes(data, begins[wordy], stops[wordy], _ANY) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    out["n_dup_lines"] = np.bincount(row, later, n_rows).astype(np.int64)

    h = hashes(data, starts, ends, PLAIN)
    w, of = windows(h, 3), row_of(first)
    covered = np.zeros(len(h), bool)
    if len(w):
        own = np.flatnonzero(of[: len(w)] == of[2:])
        twice, _ = _twice(mix(w[own] + of[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        for k in range(3):
            covered[own[twice] + k] = True
    out["n_repeat_words"] = np.bincount(of, covered, n_rows).astype(np.int64)
    return out


MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def quality(docs: DataFrame, text: str = "text", cleaned: str = "cleaned") -> DataFrame:
    """All columns of ``docs`` with more: the measures; ``base_failed`` (fewer than 50 words, or over half of the words in three-word
    windows that repeat); ``n_lines_removed`` and ``cleaned``, the text without its failing lines; and ``kept``, false
    if the base rules fail or over half of the word characters go with the lines.

    Each row is judged by itself, so nothing shuffles. A null or empty text has no words and fails; its cleaned text is null or
    empty. Repeated rows are judged alike. An input column called like a new one gives way to it.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines_removed", cleaned, "kept"]
    docs = without(docs, *new)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in chunks(batches, text):
            m = _measures(data, bounds)
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
            texts = batch.column(names.index(text)).to_pylist()
            done = [clean(t) if t else (t, 0, 0) for t in texts]
            lost = np.fromiter((d[2] for d in done), np.int64, len(done))
            kept = ~failed & (lost <= LOST_SHARE * m["word_chars"])
            columns = [*batch.columns, *(pa.array(m[k], pa.int64()) for k in new[:5]), pa.array(failed), pa.array([d[1] for d in done], pa.int64()), pa.array([d[0] for d in done], pa.string()), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, [*names, *new])

    return map_batches(docs, run, f"{schema_of(docs)}, {MEASURES}, base_failed boolean, n_lines_removed bigint, `{cleaned}` string, kept boolean")
