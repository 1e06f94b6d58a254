"""Plain, slow versions of the operators that the tests hold them against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def pieces(docs, path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for d, t in docs:
        ids = model.encode(t or "", add_bos=True, add_eos=True)
        out.append((d, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(model.decode(ids))))
    return out


def _digest(spans, kinds):
    return sha(",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda x: (x[1], kinds.index(x[0])))))


SECRET_WORD = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN = re.compile(rf"""({SECRET_WORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(docs):
    kinds, out = ("assign", "access", "hex"), []
    for d, t in docs:
        t = t or ""
        s = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
        s += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        s += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        out.append((d, *(sum(x[0] == k for x in s) for k in kinds), _digest(s, kinds)))
    return out


def _luhn(digits: str) -> bool:
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(digits)))) % 10 == 0


def persons(docs):
    kinds, out = ("email", "ip", "card", "phone"), []
    digits = lambda x: re.sub("[^0-9]", "", x)
    for d, t in docs:
        t = t or ""
        s = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        s += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
        s += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and _luhn(digits(m[0]))]
        s += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
        out.append((d, *(sum(x[0] == k for x in s) for k in kinds), _digest(s, kinds)))
    return out


def similar(docs, k=4, percent=85):
    sets = []
    for _, t in docs:
        w = WORDS.findall(lower(t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def repeated_lines(docs, percent=80, min_words=5):
    """{position of the document: places of lines that go}; documents by doc_id."""
    gaps, lines = re.compile(r"[ \t\r\f\x0b]+"), []
    for n, (d, t) in enumerate(docs):
        for i, line in enumerate((t or "").split("\n")):
            s = frozenset(x for x in gaps.split(line.lower()) if x)
            if len(s) >= min_words:
                lines.append(((d, i), n, s))
    first = {}
    for at, _, s in lines:
        first[s] = min(first.get(s, at), at)
    distinct = list(first)
    near = {s: min(first[u] for u in distinct if 100 * len(s & u) >= percent * len(s | u)) for s in distinct}
    out = defaultdict(list)
    for at, n, s in lines:
        if near[s] < at:
            out[n].append(at[1])
    return out


def leaks(docs, items, size=10):
    known = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t or ""))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            known[tuple(w[k : k + size])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = ALNUM.findall(lower(t or "")), set(), set()
        for n in {len(x) for x in known}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    found |= known[tuple(w[k : k + n])]
                    hit |= set(range(k, k + n))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def quality(docs):
    out = []
    for d, t in docs:
        t = t or ""
        w = WORDS.findall(t)
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        c = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(covered), failed))
    return out


def passages(docs, size=13):
    words = [WORDS.findall(t or "") for _, t in docs]
    least = {}
    for (d, _), w in zip(docs, words, strict=True):
        for k in range(len(w) - size + 1 if d is not None else 0):
            x = tuple(w[k : k + size])
            least[x] = min(least.get(x, d), d)
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = {j for k in range(len(w) - size + 1 if d is not None else 0) if least[tuple(w[k : k + size])] < d for j in range(k, k + size)}
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out
