"""Cutting texts into the pieces that a public tokenizer encodes one by one."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

# The pattern of byte-level vocabularies, \s spelt out as the Unicode property.
BYTE_LEVEL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The pattern of the lower-case vocabulary with word ends.
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"

# The bytes that byte-level vocabularies write as themselves. The others follow from
# U+0100 in ascending order.
_AS_ITSELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _AS_ITSELF]
BYTE_LETTERS = {b: b for b in _AS_ITSELF} | {b: 256 + i for i, b in enumerate(_OTHERS)}

_LATIN = "A-Za-zÀ-ÖØ-öø-ſ"
_SIMPLE = re.compile(f"[\t-\r\x20-\x7e{_LATIN[6:]}]*")


def finder(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text. Texts of ASCII and Latin letters, where the classes
    are short lists, go through the faster of two regular expression libraries."""
    classes = {r"\p{L}": _LATIN, r"\p{N}": "0-9", r"\p{White_Space}": "\t-\r\x20"}
    simple = pattern.replace(r"\P{White_Space}", f"[^{classes[r'\p{White_Space}']}]")
    for name, members in classes.items():
        simple = re.sub(
            r"(\[[^\]]*)?" + re.escape(name),
            lambda m: f"{m[1]}{members}" if m[1] else f"[{members}]",
            simple,
        )
        while re.search(r"\[[^\]]*" + re.escape(name), simple):
            simple = re.sub(r"(\[[^\]]*)" + re.escape(name), lambda m: m[1] + members, simple)
    whole, plain = regex.compile(pattern).findall, re.compile(simple).findall
    return lambda text: plain(text) if _SIMPLE.fullmatch(text) else whole(text)
