"""The operators' results by plain loops over small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
VISIBLE = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LAST = (1 << 63) - 1


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def utf8(text: str | None) -> bytes:
    return (text or "").encode()


def order(doc_id: int | None) -> int:
    return LAST if doc_id is None else doc_id


def key_of(line: bytes) -> bytes:
    return line.strip(b" \t\n\x0b\x0c\r").translate(LOWER)


def lines(docs: list[tuple]) -> list[tuple]:
    """``(id, lines, dropped, kept)`` per row."""
    holders = defaultdict(set)
    for i, t in docs:
        for line in utf8(t).split(b"\n"):
            if len(key_of(line).decode()) >= 10:
                holders[key_of(line)].add(order(i))
    out = []
    for i, t in docs:
        own = utf8(t).split(b"\n")
        keep = [x for x in own if len(holders[key_of(x)]) < 2 or order(i) == min(holders[key_of(x)])]
        out.append((i, len(own), len(own) - len(keep), sha(b"\n".join(keep))))
    return out


def windows(docs: list[tuple], width: int) -> list[tuple]:
    count = Counter()
    words = [(i, VISIBLE.findall(utf8(t))) for i, t in docs]
    for _, w in words:
        count.update(tuple(w[a : a + width]) for a in range(len(w) - width + 1))
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - width + 1):
            if count[tuple(w[a : a + width])] > 1:
                gone.update(range(a, a + width))
        out.append((i, len(w), len(gone), sha(b" ".join(x for n, x in enumerate(w) if n not in gone))))
    return out


def strings(docs: list[tuple], length: int) -> list[tuple]:
    first: dict[bytes, int] = {}
    for i, t in docs:
        b = utf8(t)
        for a in range(len(b) - length + 1):
            s = b[a : a + length]
            first[s] = min(first.get(s, LAST), order(i))
    out = []
    for i, t in docs:
        b = utf8(t)
        gone = set()
        for a in range(len(b) - length + 1):
            if first[b[a : a + length]] < order(i):
                gone.update(range(a, a + length))
        runs = sum(1 for a in gone if a - 1 not in gone)
        out.append((i, len(b), len(gone), runs, sha(bytes(x for n, x in enumerate(b) if n not in gone))))
    return out


def contamination(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    owners = defaultdict(set)
    for item, t in items:
        w = ALNUM.findall(utf8(t).translate(LOWER))
        for a in range(max(1, len(w) - window + 1) if w else 0):
            owners[tuple(w[a : a + window])].add(str(item))
    sizes = {len(k) for k in owners}
    out = []
    for i, t in docs:
        w = ALNUM.findall(utf8(t).translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in owners:
                    hit.update(range(a, a + n))
                    found |= owners[tuple(w[a : a + n])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def shingles(text: str | None, size: int = 5) -> frozenset:
    w = VISIBLE.findall(utf8(text).translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[a : a + size]) for a in range(max(1, len(w) - size + 1)))


def classes(docs: list[tuple], similarity: float = 0.8) -> list[int]:
    """The smallest id reached from each row through similar rows."""
    sets = [shingles(t) for _, t in docs]
    name = list(range(len(docs)))

    def find(x: int) -> int:
        while name[x] != x:
            x = name[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                name[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(docs):
        least[find(a)] = min(least.get(find(a), LAST), order(i))
    return [least[find(a)] for a in range(len(docs))]
