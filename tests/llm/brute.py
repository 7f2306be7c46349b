"""Plain versions of the operators, for comparison. Rows are (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def without_repeats(rows: list[tuple], span: int = 20) -> dict:
    """doc_id -> (n_words, n_removed, kept_sha256); ids are unique."""
    first = {}
    split = {doc_id: (text or "").encode().split() for doc_id, text in rows}
    for doc_id in sorted(split):
        words = split[doc_id]
        for i in range(len(words) - span + 1):
            first.setdefault(b" ".join(words[i : i + span]), (doc_id, i))
    out = {}
    for doc_id, words in split.items():
        gone = set()
        for i in range(len(words) - span + 1):
            if first[b" ".join(words[i : i + span])] < (doc_id, i):
                gone.update(range(i, i + span))
        left = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out[doc_id] = (len(words), len(gone), sha(left))
    return out


def shingles(text: str | None, size: int = 5) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(b" ".join(words[i : i + size]) for i in range(len(words) - size + 1))


def near_groups(rows: list[tuple], percent: int = 75) -> dict:
    """doc_id -> (n_shingles, component_id), by an index of the rarest shingles of each set: sets
    this similar share one of the first (1 - percent) of them and one more, in any fixed order."""
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    classes = {}
    for doc_id in sorted(sets):
        classes.setdefault(sets[doc_id], doc_id)
    parent = {doc_id: classes[s] if s else doc_id for doc_id, s in sets.items()}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    often = defaultdict(int)
    for s in classes:
        for x in s:
            often[x] += 1
    index = defaultdict(list)
    for s, doc_id in classes.items():
        ordered = sorted(s, key=lambda x: (often[x], x))
        prefix = ordered[: len(s) - -(-percent * len(s) // 100) + 1]
        near = {other for x in prefix for other in index[x]}
        for other in near:
            both = len(s & sets[other])
            if 100 * both >= percent * (len(s) + len(sets[other]) - both):
                a, b = root(doc_id), root(other)
                parent[max(a, b)] = min(a, b)
        for x in prefix:
            index[x].append(doc_id)
    return {doc_id: (len(s), root(doc_id)) for doc_id, s in sets.items()}


def luhn(value: str) -> bool:
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return sum(2 * d - 9 * (d > 4) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0


# The patterns of the base kinds as they are defined.
BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text: str | None) -> list[tuple]:
    out = []
    for kind, pattern in BASE_PATTERNS.items():
        for match in re.finditer(pattern, text or ""):
            value = match[0]
            digits = sum(c.isdigit() for c in value)
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in value.split(".")),
                "card": 16 <= digits <= 19 and luhn(value),
                "phone": 8 <= digits <= 15,
            }[kind]
            if good:
                out.append((kind, match.start(), match.end()))
    return out


def quality_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    text = text or ""
    words = word.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if word.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def contained(rows: list[tuple], items: list[tuple], percent: int = 75) -> set:
    sets = [(i, shingles(t)) for i, t in items if t and len(t.encode().split()) >= 5]
    out = set()
    for doc_id, text in rows:
        own = shingles(text)
        out |= {(doc_id, i) for i, s in sets if 100 * len(s & own) >= percent * len(s)}
    return out
