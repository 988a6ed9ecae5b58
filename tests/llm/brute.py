"""Plain versions of the operators for small inputs, and inputs full of repeats."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def texts(rng, count: int = 60, vocabulary: int = 30) -> list[tuple[int | None, str | None]]:
    """Documents made of shared passages, edits and noise, with equal, null and empty ones."""
    words = [f"w{i}" for i in range(vocabulary)] + ["é", "Ünï"]
    passages = [[rng.choice(words) for _ in range(rng.randint(15, 80))] for _ in range(6)]
    docs: list[tuple[int | None, str | None]] = []
    for i in range(count):
        parts: list[str] = []
        for _ in range(rng.randint(0, 6)):
            part = list(rng.choice(passages)) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(1, 40))]
            if rng.random() < 0.3:
                part[rng.randrange(len(part))] = f"x{rng.randrange(9)}"
            parts += part[rng.randrange(len(part)) :] if rng.random() < 0.3 else part
        docs.append((i * 3, rng.choice([" ", "\n "]).join(parts)))
    return [*docs, (1000, "du " * 300), (1001, None), (1002, ""), (1003, docs[5][1]), (1004, docs[5][1])]


def lines(docs, min_chars: int = 40, min_documents: int = 5):
    def key(line):
        stripped = line.strip(" \t\n\x0b\x0c\r")
        return stripped.translate(LOWER) if len(stripped) >= min_chars else None

    split = [(d, (t or "").split("\n")) for d, t in docs]
    holders: dict[str, list] = {}
    for d, own in split:
        for k in {key(x) for x in own} - {None}:
            holders.setdefault(k, []).append(d)
    documents = {k: len({d for d in ds if d is not None}) + ds.count(None) for k, ds in holders.items()}
    gone = {k: max((d for d in ds if d is not None), default=None) for k, ds in holders.items() if documents[k] >= min_documents}
    out = []
    for d, own in split:
        kept = [x for x in own if key(x) not in gone or gone[key(x)] == d]
        out.append((d, len(own), len(own) - len(kept), sha("\n".join(kept).encode())))
    return out


def word_windows(docs, length: int):
    """Rows of the substring operator: (doc_id, words, removed, digest of the rest)."""
    split = [((d is None, d or 0), d, (t or "").encode().split()) for d, t in docs]
    first: dict[tuple, tuple] = {}
    for order, _, own in sorted(split, key=lambda x: x[0]):
        for i in range(len(own) - length + 1):
            first.setdefault(tuple(own[i : i + length]), (order, i))
    out = []
    for order, d, own in split:
        gone: set[int] = set()
        for i in range(len(own) - length + 1):
            if first[tuple(own[i : i + length])] != (order, i):
                gone.update(range(i, i + length))
        out.append((d, len(own), len(gone), sha(b" ".join(w for i, w in enumerate(own) if i not in gone))))
    return out


def byte_windows(docs, length: int):
    raws = [(d, (t or "").encode()) for d, t in docs]
    counts = Counter(r[i : i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for d, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, sha(bytes(x for x, g in zip(raw, gone, strict=True) if not g))))
    return out


def shingle_set(text: str | None, size: int) -> set[tuple]:
    own = (text or "").encode().lower().split()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} or ({tuple(own)} if own else set())


def components(docs, size: int, percent: int):
    sets = [(d, shingle_set(t, size)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, two in sets[:i]:
            both = len(one & two)
            if both and 100 * both >= percent * (len(one) + len(two) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((d, len(s), root(d)) for d, s in sets)


def contamination(docs, items, window: int = 13):
    split = [(str(i), WORD.findall((t or "").translate(LOWER))) for i, t in items]
    windows: dict[tuple, set[str]] = {}
    for i, own in split:
        for k in range(max(1, len(own) - window + 1) if own else 0):
            windows.setdefault(tuple(own[k : k + window]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        own = WORD.findall((t or "").translate(LOWER))
        hit: set[int] = set()
        found: set[str] = set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                if (names := windows.get(tuple(own[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= names
        out.append((d, len(own), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit) and 20 * len(hit) >= len(own)))
    return out
