"""Words of a text, their hashes and windows of them; what several operators here share.

A word is a run of characters other than space and U+0009 to U+000D. ``bytes.split`` cuts
UTF-8 at exactly those.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd

_CHARACTERS = 8_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The words as UTF-8; ``lower`` folds A-Z only. No text has no words."""
    if not text:
        return []
    raw = text.encode()
    return (raw.lower() if lower else raw).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits can be used."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def windows_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each ``size`` consecutive words, in order; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, np.uint64(size))
    for j in range(size):
        total = total * _STEP + hashes[j : j + n]
    return mixed(total)


_SEGMENT = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_POWERS = {name: np.ones(1, np.uint64) for name in ("up", "down")}


def _powers(name: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the odd number ``_STEP``, or of its inverse modulo 2 ** 64."""
    if len(_POWERS[name]) < n:
        base = int(_STEP) if name == "up" else pow(int(_STEP), -1, 1 << 64)
        steps = np.full(max(n, 1 << 16), np.uint64(base))
        steps[0] = 1
        _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS[name][:n]


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words of a text, in order; no text has none.

    A word's hash is a polynomial of its bytes, taken from sums over the whole text, so no word is
    touched by itself. Long texts go in segments that end at white space.
    """
    raw = (text or "").encode()
    raw = raw.lower() if lower else raw
    parts, at = [], 0
    while len(raw) - at > _SEGMENT:
        space = _SPACE.search(raw, at + _SEGMENT)
        end = space.end() if space else len(raw)
        parts.append(_hashes(raw[at:end]))
        at = end
    parts.append(_hashes(raw[at:]))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _hashes(raw: bytes) -> np.ndarray:
    letters = np.frombuffer(raw, np.uint8)
    edge = np.zeros(len(letters) + 2, bool)
    edge[1:-1] = (letters != 32) & ((letters < 9) | (letters > 13))
    edge = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters * _powers("up", len(letters)), out=sums[1:])
    total = (sums[ends] - sums[starts]) * _powers("down", len(letters))[starts]
    return mixed(total + (ends - starts).astype(np.uint64) * _MIX_1)


def shingles_of(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a lower-cased text. A text with
    fewer words is one shingle, a text without words has none."""
    ids = word_hashes(text, lower=True)
    return np.unique(windows_of(ids, min(size, len(ids)))) if len(ids) else ids


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return x.view(np.int64)


def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in batches of about ``_CHARACTERS``, in which more texts share their words."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += sum(len(text) for text in batch["text"] if text)
        if size >= _CHARACTERS:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)
