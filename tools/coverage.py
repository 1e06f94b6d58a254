"""Operators of the survey and the registered queries that check them: ``python tools/coverage.py``."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.registry.queries import REGISTRY  # noqa: E402


def coverage() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for name, entry in REGISTRY.items():
        for op in entry.covers:
            out.setdefault(op, []).append(name)
    return dict(sorted(out.items(), key=lambda kv: (kv[0][0], int(kv[0][1:]))))


if __name__ == "__main__":
    for op, names in coverage().items():
        print(f"{op:5} {', '.join(names)}")
