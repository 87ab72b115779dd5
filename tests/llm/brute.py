"""Plain versions of the operators, for small inputs, and a table of awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

SPACES = r"[\x20\x09-\x0D]+"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def awkward_texts() -> list[str | None]:
    """Nulls, empty and very long texts, ties, repeats, near copies, all within a few kilobytes but for one."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(60)]

    def prose(n: int) -> list[str]:
        return [rng.choice(words) for _ in range(n)]

    base = prose(120)
    near = []
    for _ in range(12):
        copy = base[:]
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        near.append(" ".join(copy))
    passage = " ".join(prose(60))
    sharing = [" ".join(prose(20)) + passage + " ".join(prose(20)) for _ in range(3)]
    spaced = " ".join(base).replace(" ", " \t\n", 5)
    lines = ["\n".join([" ".join(prose(8)), passage, " ".join(prose(3))]) for _ in range(3)]
    return [None, "", " ", "\n\t", "one two three", "One TWO three", "a b c d", " ".join(base), " ".join(base), spaced, *near, *sharing, *lines, " ".join(prose(40_000)), "x" * 199, "x" * 200, "y" * 201, "é" * 150]


def component_of(nodes: list, links: list[tuple]) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def suffix_dedup(rows: list[tuple], span: int = 200) -> list[tuple]:
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[k : k + span] for _, r in raws for k in range(len(r) - span + 1))
    out = []
    for i, r in raws:
        gone, reach = bytearray(len(r)), 0
        for k in range(len(r) - span + 1):
            if seen[r[k : k + span]] > 1:
                for z in range(max(k, reach), k + span):
                    gone[z] = 1
                reach = k + span
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def jaccard(rows: list[tuple], words: int = 4, percent: int = 85) -> list[tuple]:
    sets = []
    for i, t in rows:
        w = [x for x in re.split(SPACES, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets.append((i, frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])))
    known = sorted({s for i, s in sets if i is not None and s}, key=lambda s: sorted(s))
    links = [(m, n) for n, s in enumerate(known) for m, u in enumerate(known[:n]) if 100 * len(s & u) >= percent * len(s | u)]
    named = component_of(list(range(len(known))), links)
    number = {s: named[n] for n, s in enumerate(known)}
    smallest: dict[int, int] = {}
    for i, s in sets:
        if i is not None and s:
            smallest[number[s]] = min(i, smallest.get(number[s], i))
    return [(i, len(s), None if i is None else smallest[number[s]] if s else i) for i, s in sets]


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def line_dedup(rows: list[tuple], most: int = 2, blank: int = 20) -> list[tuple]:
    """Rows must have different identifiers. Blank lines are compared from ``blank`` characters on."""
    first: dict[str, tuple] = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate((t or "").split("\n")):
            if line.strip() or len(line) >= blank:
                first.setdefault(line, (i is None, i or 0, k))
    by_size = defaultdict(list)
    for line in first:
        by_size[len(line)].append(line)
    links = []
    for line in (x for x in first if len(x) > most):
        for more in range(most + 1):
            for other in by_size.get(len(line) + more, ()):
                if other != line and sum((Counter(line) - Counter(other)).values()) <= most and edits(line, other) <= most:
                    links.append((line, other))
    named = component_of(list(first), links)
    best: dict[str, tuple] = {}
    for line, c in named.items():
        best[c] = min(best.get(c, (first[line], line)), (first[line], line))
    out = []
    for i, t in rows:
        lines, equal, near, kept = (t or "").split("\n"), 0, 0, []
        for k, line in enumerate(lines):
            if line in first and first[line] != (i is None, i or 0, k):
                equal += 1
            elif line in first and best[named[line]][1] != line:
                near += 1
            else:
                kept.append(line)
        out.append((i, len(lines), equal, near, sha("\n".join(kept))))
    return out


def ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=repr)
