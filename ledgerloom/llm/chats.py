"""Chat formatting by schema fingerprints.

A record is a JSON object in any layout. The set of its nested field paths with their types is hashed; the hash selects a
declarative mapping, which says where turns, roles and texts stand. The result is a canonical list of turns, written in one template and
read back from it. Paths of fields that no mapping names are ignored if a mapping's own paths are there.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.texts import map_batches, schema_of, without


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout stand: a list of turn objects with role and text fields, or single fields with a given role each."""

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    singles: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()
    paths: frozenset[str] = field(default=frozenset())

    def needed(self) -> frozenset[str]:
        if self.turns:
            return frozenset({f"{self.turns}[].{self.role}:text", f"{self.turns}[].{self.text}:text"})
        return frozenset(f"{p}:text" for p, _ in self.singles)


#: fixed values: layouts in common use
MAPPINGS = (
    Mapping("messages", "messages", "role", "content"),
    Mapping("conversations", "conversations", "from", "value", roles=(("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))),
    Mapping("turns", "turns", "speaker", "text", roles=(("human", "user"), ("bot", "assistant"))),
    Mapping("instruction_input", singles=(("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    Mapping("instruction", singles=(("instruction", "user"), ("output", "assistant"))),
    Mapping("prompt_response", singles=(("prompt", "user"), ("response", "assistant"))),
    Mapping("prompt_completion", singles=(("prompt", "user"), ("completion", "assistant"))),
    Mapping("question_answer", singles=(("question", "user"), ("answer", "assistant"))),
    Mapping("system_question", singles=(("system_prompt", "system"), ("question", "user"), ("response", "assistant"))),
)


def paths(value, at: str = "") -> set[str]:
    """Field paths with kinds of values; list items share a path."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, f"{at}[]")} or {f"{at}[]:none"}
    kind = "text" if isinstance(value, str) else "none" if value is None else "flag" if isinstance(value, bool) else "number"
    return {f"{at}:{kind}"}


def fingerprint(found: set[str] | frozenset[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


class Layouts:
    """Mappings by fingerprint. A fingerprint seen for the first time is resolved by the mapping whose paths it holds, most of them first, and remembered."""

    def __init__(self, mappings: tuple[Mapping, ...] = MAPPINGS) -> None:
        self.mappings = sorted(mappings, key=lambda m: (-len(m.needed()), m.name))
        self.known: dict[str, Mapping | None] = {fingerprint(m.needed()): m for m in mappings}

    def select(self, record: object) -> tuple[str, Mapping | None]:
        found = paths(record) if isinstance(record, dict) else set()
        if isinstance(record, dict) and not found:
            found = {":empty"}
        mark = fingerprint(found)
        if mark not in self.known:
            if len(self.known) > 10_000:
                self.known = {fingerprint(m.needed()): m for m in self.mappings}
            texts = {p.removesuffix(":none") + ":text" if p.endswith(":none") else p for p in found}  # a null text is an empty one
            fits = [m for m in self.mappings if m.needed() <= texts or m.turns and f"{m.turns}[]:none" in found]
            self.known[mark] = fits[0] if fits else None
        return mark, self.known[mark]

    def turns(self, record: object) -> tuple[str, str | None, list[tuple[str, str]]]:
        """Fingerprint, name of the layout, and (role, text) of each turn. Single fields that are empty and not the last give no turn."""
        mark, mapping = self.select(record)
        if mapping is None:
            return mark, None, []
        if mapping.turns:
            names = dict(mapping.roles)
            rows = [x for x in record[mapping.turns] if isinstance(x, dict)]
            return mark, mapping.name, [(names.get(r := x.get(mapping.role) or "", r), x.get(mapping.text) or "") for x in rows]
        own = [(role, record.get(p) or "") for p, role in mapping.singles]
        return mark, mapping.name, [x for x in own[:-1] if x[1]] + own[-1:]


_OUT = str.maketrans({"\\": "\\\\", "<": "\\(", ">": "\\)"})
_BACK = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ([^<>]*)>([^<>]*)</turn>\n")


def escape(text: str) -> str:
    """Text in which no mark of the template can stand."""
    return text.translate(_OUT)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: {"(": "<", ")": ">"}.get(m[1], m[1]), text)


def write(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The template, and the ranges of code points under the loss mask, as starts and ends in turn: the texts of the assistant."""
    out, mask, at = [], [], 0
    for role, text in turns:
        lead, body = f"<turn {escape(role)}>", escape(text)
        if role == "assistant" and body:
            mask += [at + len(lead), at + len(lead) + len(body)]
        out.append(f"{lead}{body}</turn>\n")
        at += len(out[-1])
    return "".join(out), mask


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def masked(formatted: str, mask: list[int]) -> str:
    """The text under the loss mask, as it was."""
    return "".join(unescape(formatted[a:z]) for a, z in zip(mask[::2], mask[1::2], strict=True))


def format_records(records: DataFrame, record: str = "record") -> DataFrame:
    """All columns of ``records`` with four more: ``fingerprint``, ``layout``, ``formatted`` and ``loss_mask``. ``record`` holds JSON text.

    A null, empty, broken or unknown record has a null layout and an empty formatted text. Missing roles and texts are empty. Each
    row stands alone, equal rows get equal results. An input column called like a new one gives way to it.
    """
    records = without(records, "fingerprint", "layout", "formatted", "loss_mask")
    names = records.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts = Layouts()
        for batch in batches:
            marks, kinds, texts, masks = [], [], [], []
            for raw in batch.column(names.index(record)).to_pylist():
                try:
                    value = json.loads(raw or "null")
                except ValueError:
                    value = None
                mark, kind, turns = layouts.turns(value)
                text, mask = write(turns)
                for to, x in ((marks, mark), (kinds, kind), (texts, text), (masks, mask)):
                    to.append(x)
            new = [pa.array(marks, pa.string()), pa.array(kinds, pa.string()), pa.array(texts, pa.string()), pa.array(masks, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*names, "fingerprint", "layout", "formatted", "loss_mask"])

    return map_batches(records, run, f"{schema_of(records)}, fingerprint string, layout string, formatted string, loss_mask array<int>")


def read_back(formatted: DataFrame) -> DataFrame:
    """All columns with ``turns``, as (role, text), and ``loss_text``, both read from ``formatted`` and ``loss_mask``."""
    formatted = without(formatted, "turns", "loss_text")
    names = formatted.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            texts, masks = (batch.column(names.index(c)).to_pylist() for c in ("formatted", "loss_mask"))
            turns = [[{"role": r, "text": t} for r, t in read(x or "")] for x in texts]
            loss = [masked(x or "", m or []) for x, m in zip(texts, masks, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(turns, kind), pa.array(loss, pa.string())], [*names, "turns", "loss_text"])

    return map_batches(formatted, run, f"{schema_of(formatted)}, turns array<struct<role: string, text: string>>, loss_text string")
