"""Plain Python forms of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text: str | None) -> set[tuple]:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near_components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id: (size of its set, smallest doc_id in reach), comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lists = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            lists[g].append(d)
    common = defaultdict(int)
    for owners in lists.values():
        for i, a in enumerate(owners):
            for b in owners[i + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def without_repeats(rows: list[tuple[int, str | None]], length: int = 50) -> dict[int, tuple]:
    """doc_id: (bytes, removed, spans, SHA-256 of the rest), by the least document of every string."""
    raw = {d: (t or "").encode() for d, t in rows}
    least: dict[bytes, int] = {}
    for d, b in raw.items():
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            least[s] = min(least.get(s, d), d)
    found = {}
    for d, b in raw.items():
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


def chunk_repeats(rows: list[tuple[int, str | None]], chunks_of, least_lines: int = 2) -> dict[int, bytes]:
    """doc_id: the bytes left after all chunks of several lines that an earlier place has are gone."""
    seen, left = set(), {}
    for d, text in sorted(rows):
        out = []
        for n, chunk in chunks_of(text):
            key = chunk.rstrip(b"\n")
            if n >= least_lines and key in seen:
                continue
            if n >= least_lines:
                seen.add(key)
            out.append(chunk)
        left[d] = b"".join(out)
    return left
